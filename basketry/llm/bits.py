"""A bitmap of fixed size over 64-bit keys: a first filter that may let others pass, but loses none.

Its size is a parameter, never a function of the data, so it is safe to send to every task. With more
keys than bits it only filters less; what passes is always joined exactly afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_BITS = 25


def bitmap(keys: DataFrame, column: str, log_bits: int = LOG_BITS) -> np.ndarray:
    """One bit per key, from its upper bits; at most 2^(log_bits - 6) words reach the driver."""
    bit = F.shiftrightunsigned(F.col(column), 64 - log_bits)
    words = keys.select(
        F.shiftright(bit, 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int")).alias("bit"),
    )
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (log_bits - 6), np.uint64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return out


def present(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key (unsigned) has its bit."""
    log_bits = len(bits).bit_length() - 1 + 6
    bit = keys >> np.uint64(64 - log_bits)
    return (bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def passes(docs: DataFrame, bits: np.ndarray) -> Callable:
    """Whether a key of a column passes the bitmap."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def passed(keys: pd.Series) -> pd.Series:
        return pd.Series(present(sent.value, keys.to_numpy().view(np.uint64)))

    return passed
