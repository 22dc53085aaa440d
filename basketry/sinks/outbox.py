"""Delivery of messages."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from basketry.sources.tables import table_exists
from basketry.workspace import Workspace

log = logging.getLogger(__name__)

SENT, FAILED = "sent", "failed"
LEDGER = "key string, state string, attempts int, error string"

Sender = Callable[[str, dict[str, str]], None]


def write_outbox(messages: DataFrame, path: str) -> None:
    """Replace the outbox: JSON lines, a folder per event type."""
    messages.write.mode("overwrite").partitionBy("event_type").json(path)


def read_outbox(spark: SparkSession, path: str) -> DataFrame:
    """The messages of the outbox, as ``publish`` takes them."""
    return spark.read.schema("message string, event_type string").json(path)


def publish(messages: DataFrame, open_sender: Callable[[], Sender], senders: int | None = None) -> int:
    """Send every message and return how many were sent.

    Each task opens one sender and calls it with the message text and the attributes; ``senders`` is
    the number of tasks (None: as the messages are partitioned). What a sender raises fails the job.
    A task that is run again sends its messages again: at least once. ``publish_once`` remembers.
    """
    if senders is not None:
        messages = messages.repartition(senders)
    sent = messages.sparkSession.sparkContext.accumulator(0)

    def send_all(rows: Iterable[Row]) -> None:
        send = open_sender()
        for row in rows:
            send(row.message, {"event_type": row.event_type})
            sent.add(1)

    messages.select("message", "event_type").foreachPartition(send_all)
    log.info("%d messages were sent", sent.value)
    return sent.value


@dataclass(frozen=True)
class Retries:
    """How often a message is tried, and how long to wait before the second time; the wait doubles each time."""

    attempts: int = 4
    first_wait: float = 0.5
    longest_wait: float = 30.0

    def wait(self, failures: int) -> float:
        return min(self.longest_wait, self.first_wait * 2 ** (failures - 1))


@dataclass(frozen=True)
class Delivery:
    """What a call of ``publish_once`` did: messages sent by it, left out as sent before, and not taken by the sender."""

    sent: int
    known: int
    failed: int


class NotSent(RuntimeError):
    """Some messages were not taken; ``delivery`` counts them. The others are in the ledger."""

    def __init__(self, delivery: Delivery, ledger: str, error: str) -> None:
        super().__init__(f"{delivery.failed} messages were not sent, the others are in {ledger}; the first error: {error}")
        self.delivery = delivery


def message_key() -> Column:
    """What tells messages apart: equal text and event type are one message."""
    return F.sha2(F.concat(F.coalesce("event_type", F.lit("")), F.lit("\x00"), F.col("message")), 256)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """(key, state, attempts, error): a row each time a message was sent or given up."""
    if not table_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def publish_once(
    messages: DataFrame, open_sender: Callable[[], Sender], ledger: str, batch: int = 500, retries: Retries = Retries()
) -> Delivery:
    """Send the messages that the ledger does not have as sent, and write down each one.

    ``ledger`` is a folder for one delivery, such as a day's outbox: a run that is repeated with it goes on where the
    earlier one ended. A message that the sender refuses is tried again, and then given up without holding up the
    others; if any was, ``NotSent`` is raised at the end. A task takes about ``batch`` messages and its rows join the ledger
    when it ends, whatever becomes of the job, so that an executor that is lost repeats one batch per core at most.
    """
    spark = messages.sparkSession
    keyed = messages.select(message_key().alias("key"), "message", "event_type").dropDuplicates(["key"])
    earlier = read_ledger(spark, ledger).filter(F.col("state") == SENT).select("key").distinct()
    with Workspace(spark) as ws:
        due, seen = ws.save_measured(keyed.join(earlier, "key", "left_anti"), "due", rows=F.count(F.lit(1)))
        if seen["rows"]:
            dealt = due.repartition(-(-seen["rows"] // batch))
            rows = dealt.mapInPandas(_sending(open_sender, retries), LEDGER)
            # Version 2 moves a task's file into the ledger when the task ends, not when the job does.
            rows.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(ledger)
        states = read_ledger(spark, ledger).join(due.select("key"), "key")
        states = states.groupBy("key").agg(F.max(F.col("state") == SENT).alias("sent"), F.max("error").alias("error"))
        counts = states.agg(F.count_if("sent").alias("sent"), F.count_if(~F.col("sent")).alias("failed"), F.min(F.when(~F.col("sent"), F.col("error"))).alias("error")).first()
        known = keyed.count() - seen["rows"]
    done = Delivery(counts["sent"], known, counts["failed"])
    log.info("%d messages were sent, %d had been before, %d were not taken", done.sent, done.known, done.failed)
    if done.failed:
        raise NotSent(done, ledger, counts["error"])
    return done


def _sending(open_sender: Callable[[], Sender], retries: Retries) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = open_sender()
        for frame in frames:
            rows = [(key, *_sent(send, message, kind, retries)) for key, message, kind in frame.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["key", "state", "attempts", "error"])

    return run


def _sent(send: Sender, message: str, event_type: str, retries: Retries) -> tuple[str, int, str | None]:
    for attempt in range(1, retries.attempts + 1):
        try:
            send(message, {"event_type": event_type})
            return SENT, attempt, None
        except Exception as refused:  # whatever a sender raises is a refusal of this message
            error = f"{type(refused).__name__}: {refused}"
            if attempt < retries.attempts:
                time.sleep(retries.wait(attempt))
    return FAILED, retries.attempts, error
