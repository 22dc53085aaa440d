from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest

from basketry import Workspace
from basketry.sinks import publish, read_history, read_outbox, replace_table, upsert_history, write_if_nonempty, write_outbox
from basketry.sinks import NotSent, Retries, publish_once, read_ledger, tables
from basketry.sources import read_table, table_folder
from basketry.workspace import checkpoint_root

PAIRS = "country_id int, antecedents string, consequents string, support double, confidence double, lift double"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def pairs(spark, n, start=0):
    return spark.createDataFrame([(1, f"a{i}", "b", 0.1, 0.2, 1.5) for i in range(start, start + n)], PAIRS)


def per_day(spark, path):
    return {r.audit_date: r["count"] for r in spark.read.parquet(path).groupBy("audit_date").count().collect()}


def test_history_replaces_only_its_own_day(spark, tmp_path):
    path = str(tmp_path / "history")
    upsert_history(pairs(spark, 3), path, D1)
    upsert_history(pairs(spark, 2), path, D2)
    upsert_history(pairs(spark, 7), path, D2)
    upsert_history(pairs(spark, 7), path, D2)
    assert per_day(spark, path) == {D1: 3, D2: 7}


def test_history_goes_by_name_and_an_empty_run_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "history")
    df = pairs(spark, 2)
    upsert_history(df.select(*reversed(df.columns)), path, D1)
    upsert_history(df.limit(0), path, D1)
    upsert_history(df.limit(0), path, D2)
    assert per_day(spark, path) == {D1: 2}
    assert {r.consequents for r in spark.read.parquet(path).collect()} == {"b"}


def test_history_of_one_day_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "history")
    upsert_history(pairs(spark, 2), path, D1)
    plan = spark.read.parquet(path).filter(f"audit_date = date '{D1}'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(audit_date" in plan


def test_history_without_a_row_is_read(spark, tmp_path):
    path, columns = str(tmp_path / "history"), [*pairs(spark, 1).columns, "audit_date"]
    assert read_history(spark, path, pairs(spark, 1).schema).columns == columns
    upsert_history(pairs(spark, 0), path, D1)
    upsert_history(pairs(spark, 0), path, D2)
    found = read_history(spark, path, pairs(spark, 1).schema)
    assert (found.columns, found.count()) == (columns, 0)
    upsert_history(pairs(spark, 2), path, D2)
    found = read_history(spark, path, pairs(spark, 1).schema)
    assert (found.columns, [r.audit_date for r in found.collect()]) == (columns, [D2, D2])


def test_write_if_nonempty(spark, tmp_path):
    path = str(tmp_path / "table")
    assert write_if_nonempty(pairs(spark, 3), path)
    assert not write_if_nonempty(pairs(spark, 3).limit(0), path)
    assert read_table(spark, path).count() == 3


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "table")
    replace_table(pairs(spark, 3), path)
    replace_table(pairs(spark, 2, start=5), path, sort=("antecedents",))
    assert sorted(r.antecedents for r in read_table(spark, path).collect()) == ["a5", "a6"]


def messages(spark, n):
    return spark.createDataFrame(
        [(json.dumps({"default": str(i)}), "mba" if i % 2 else "ranking") for i in range(n)],
        "message string, event_type string",
    )


def test_outbox(spark, tmp_path):
    path = str(tmp_path / "outbox")
    write_outbox(messages(spark, 9), path)
    write_outbox(messages(spark, 5), path)
    found = read_outbox(spark, path)
    assert {r.event_type: r["count"] for r in found.groupBy("event_type").count().collect()} == {"mba": 2, "ranking": 3}
    assert {json.loads(r.message)["default"] for r in found.collect()} == set("01234")


def file_sender(folder):
    def open_sender():
        def send(message, attributes):
            name = json.loads(message)["default"]
            (Path(folder) / name).write_text(json.dumps(attributes))
        return send
    return open_sender


def failing_sender():
    def send(message, attributes):
        raise ConnectionError("refused")
    return send


def test_publish_sends_each_message_of_the_outbox_once(spark, tmp_path_factory, tmp_path):
    outbox = str(tmp_path_factory.mktemp("messages") / "outbox")
    write_outbox(messages(spark, 11), outbox)
    assert publish(read_outbox(spark, outbox), file_sender(str(tmp_path))) == 11
    sent = {p.name: json.loads(p.read_text()) for p in tmp_path.iterdir()}
    assert len(sent) == 11
    assert sent["1"] == {"event_type": "mba"}
    assert sent["2"] == {"event_type": "ranking"}


def test_publish_runs_as_many_senders_as_asked(spark, tmp_path):
    opened = spark.sparkContext.accumulator(0)

    def open_sender():
        opened.add(1)
        return lambda message, attributes: None

    assert publish(messages(spark, 40), open_sender, senders=3) == 40
    assert opened.value == 3


def test_a_failing_sender_fails_the_job(spark):
    with pytest.raises(Exception, match="refused"):
        publish(messages(spark, 2), failing_sender)


def test_workspace(spark):
    df = pairs(spark, 3)
    with Workspace(spark) as workspace:
        assert workspace.path.startswith(checkpoint_root(spark))
        saved = workspace.save(df, "x")
        assert saved.schema == df.schema
        assert sorted(saved.collect()) == sorted(df.collect())
        folder = Path(workspace.path.removeprefix("file:"))
        assert folder.exists()
    assert not folder.exists()


class Stop(Exception):
    """The process ends here."""


@pytest.mark.parametrize("step", ["data", "pointer", "old pointer", "old rows", None])
def test_readers_between_any_two_steps_see_the_old_or_the_new_table(spark, tmp_path, step):
    """Replacing stops after a step: what is read is whole, and the next replacement works."""
    path = str(tmp_path / "table")
    for n in (1, 2, 3):
        replace_table(pairs(spark, n), path)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    before = tables.pointers(spark, path)
    reading = read_table(spark, path)
    # What replace_table does, step by step, up to the one it stops after.
    pairs(spark, 5).write.parquet(f"{path}/_rows-new")
    if step != "data":
        assert files.createNewFile(hadoop(f"{path}/{tables.POINTERS}/{before[-1][0] + 1:012d}._rows-new"))
    if step not in ("data", "pointer"):
        at, old = before[0]
        files.delete(hadoop(f"{path}/{tables.POINTERS}/{at:012d}.{old}"), False)
        if step != "old pointer":
            files.delete(hadoop(f"{path}/{old}"), True)
    assert read_table(spark, path).count() == (3 if step == "data" else 5)
    assert reading.count() == 3
    replace_table(pairs(spark, 6), path)
    assert read_table(spark, path).count() == 6


@pytest.mark.parametrize("method", ["mkdirs", "createNewFile"])
def test_a_replacement_that_breaks_off_leaves_the_old_table(spark, tmp_path, monkeypatch, method):
    path = str(tmp_path / "table")
    replace_table(pairs(spark, 2), path)
    monkeypatch.setattr(tables, "pointers", lambda *_: (_ for _ in ()).throw(Stop()))
    with pytest.raises(Stop):
        replace_table(pairs(spark, 4), path)
    monkeypatch.undo()
    assert read_table(spark, path).count() == 2


def test_versions_are_written_once_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "table")
    seen = []
    for n in range(1, 5):
        replace_table(pairs(spark, n), path, keep=1)
        folder = Path(table_folder(spark, path))
        seen.append((folder.name, {f.name: f.stat().st_mtime_ns for f in folder.iterdir()}))
    left = sorted(p.name for p in Path(path).iterdir() if p.name.startswith("_rows"))
    assert left == sorted(name for name, _ in seen[-2:])
    last = Path(path) / seen[-2][0]
    assert {f.name: f.stat().st_mtime_ns for f in last.iterdir()} == seen[-2][1]
    assert read_table(spark, path).count() == 4


def test_a_plain_folder_is_read_and_replaced(spark, tmp_path):
    path = str(tmp_path / "table")
    pairs(spark, 3).write.parquet(path)
    assert read_table(spark, path).count() == 3
    replace_table(pairs(spark, 1), path)
    assert read_table(spark, path).count() == 1


def noting_sender(folder, refuse=(), times=10**9):
    """Writes a line per message taken; refuses some messages a number of times."""

    def open_sender():
        def send(message, attributes):
            name = json.loads(message)["default"]
            with (Path(folder) / f"tried-{name}").open("a") as f:
                f.write("x")
            if name in refuse and len((Path(folder) / f"tried-{name}").read_text()) <= times:
                raise ConnectionError("refused")
            with (Path(folder) / f"sent-{name}").open("a") as f:
                f.write("x")
        return send
    return open_sender


def sent(folder):
    return {p.name.removeprefix("sent-"): len(p.read_text()) for p in Path(folder).glob("sent-*")}


QUICK = Retries(attempts=3, first_wait=0.01)


def test_a_sender_that_fails_half_way_sends_every_message_and_the_first_ones_once(spark, tmp_path):
    ledger, folder = str(tmp_path / "ledger"), tmp_path / "sent"
    folder.mkdir()
    half = {str(i) for i in range(10, 20)}
    with pytest.raises(NotSent, match="refused") as stopped:
        publish_once(messages(spark, 20), noting_sender(folder, half), ledger, batch=4, retries=QUICK)
    assert (stopped.value.delivery.sent, stopped.value.delivery.failed) == (10, 10)
    assert sent(folder) == {str(i): 1 for i in range(10)}
    done = publish_once(messages(spark, 20), noting_sender(folder), ledger, batch=4, retries=QUICK)
    assert (done.sent, done.known, done.failed) == (10, 10, 0)
    assert sent(folder) == {str(i): 1 for i in range(20)}
    again = publish_once(messages(spark, 20), noting_sender(folder), ledger, retries=QUICK)
    assert (again.sent, again.known) == (0, 20) and sent(folder) == {str(i): 1 for i in range(20)}


def test_a_refused_message_is_tried_again_with_longer_waits(spark, tmp_path):
    assert [Retries(first_wait=1.0, longest_wait=5.0).wait(k) for k in (1, 2, 3, 4)] == [1.0, 2.0, 4.0, 5.0]
    done = publish_once(messages(spark, 5), noting_sender(tmp_path, {"3"}, times=2), str(tmp_path / "ledger"), retries=QUICK)
    assert done.sent == 5 and sent(tmp_path) == {str(i): 1 for i in range(5)}
    states = {r.attempts for r in read_ledger(spark, str(tmp_path / "ledger")).collect()}
    assert states == {1, 3}


def test_a_task_that_breaks_loses_its_own_batch_only(spark, tmp_path):
    """The sender cannot be opened in one task: batches of the tasks that ended are in the ledger."""
    ledger, folder = str(tmp_path / "ledger"), tmp_path / "sent"
    folder.mkdir()

    def breaking():
        send = noting_sender(folder)()

        def once(message, attributes):
            if json.loads(message)["default"] == "7":
                import time

                time.sleep(3)  # the other tasks end meanwhile
                raise SystemExit(1)
            send(message, attributes)
        return once

    with pytest.raises(Exception):
        publish_once(messages(spark, 16), breaking, ledger, batch=2, retries=QUICK)
    known = read_ledger(spark, ledger).filter("state = 'sent'").count()
    assert known >= 8
    done = publish_once(messages(spark, 16), noting_sender(folder), ledger, batch=2, retries=QUICK)
    assert (done.sent, done.known) == (16 - known, known)
    assert sent(folder).keys() == {str(i) for i in range(16)} and sum(v > 1 for v in sent(folder).values()) <= 2


def test_equal_messages_are_one_and_none_are_none(spark, tmp_path):
    twice = messages(spark, 3).unionAll(messages(spark, 3))
    assert publish_once(twice, noting_sender(tmp_path), str(tmp_path / "ledger")).sent == 3
    assert publish_once(twice.limit(0), noting_sender(tmp_path), str(tmp_path / "other")).sent == 0
