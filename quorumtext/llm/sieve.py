"""Fixed-size sieves: rows that cannot meet any wanted key leave before a shuffle, nothing else changes.

A sieve has 2**24 bits whatever the number of keys. Each wanted key's hash sets one; the
words are merged by a grouped bit-or, combined before its shuffle, and at most 2**18 of them
(2 MB) reach the driver and the executors. Rows whose bit is not set have no partner. Others
pass, some of them by chance, and the join behind the sieve decides. Once more than a
quarter of the bits are set a sieve is not worth its cost, and all rows pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 18


def sieve_of(hashes: DataFrame) -> Broadcast | None:
    """The broadcast bits of ``hashes``, a column h of well mixed longs; None where they would let most rows pass."""
    words = hashes.select(F.shiftrightunsigned("h", 64 - WORD_BITS).cast("int").alias("w"), F.expr("shiftleft(1L, cast(h & 63 AS int))").alias("b"))
    got = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    bits = np.zeros(1 << WORD_BITS, np.uint64)
    bits[got.w.to_numpy(np.int64)] = got.b.to_numpy(np.int64).view(np.uint64)
    if np.bitwise_count(bits).sum() > 16 << WORD_BITS:
        return None
    return hashes.sparkSession.sparkContext.broadcast(bits)


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the longs may be among those that ``bits`` were made of."""
    x = h.view(np.uint64)
    return bits[x >> np.uint64(64 - WORD_BITS)] >> (x & np.uint64(63)) & np.uint64(1) == 1


def sieved(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """``rows`` without (most of) those whose key is not among the wanted ones; a null key never passes a used sieve."""
    sent = sieve_of(wanted.where(wanted_key.isNotNull()).select(F.xxhash64(wanted_key).alias("h")))
    if sent is None:
        return rows

    def may(hashes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in hashes:
            yield pd.Series(passes(sent.value, s.to_numpy(np.int64)))

    return rows.where(F.pandas_udf(may, "boolean")(F.xxhash64(key)) & key.isNotNull())
