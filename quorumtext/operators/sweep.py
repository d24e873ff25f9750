"""Intervals that hold points, by one ordered sweep.

Starts, ends and points of a recording become one stream ordered in time; a set of the
intervals that have begun and not ended is held while it passes, so each point sees all of
them: one shuffle, no pairs, and memory for what is concurrent only. A recording is cut in
stretches of time no shorter than the longest interval, so that one with a third of all rows is
many tasks, and an interval stands in two stretches at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.runtime import ship_package, unused

STRETCH = 64  # a stretch in widths, at least


def _changes(columns: list[pa.Array], last: list | None) -> np.ndarray:
    """Which rows begin another group than the row before; ``last``: the row before the first."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    for k, c in enumerate(columns):
        code = pc.fill_null(c.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        out[1:] |= code[1:] != code[:-1]
        out[0] |= last is None or c[0].as_py() != last[k]
    return out


def active_at(points: DataFrame, intervals: DataFrame, key: list[str], at: str, start: str, end: str, keep: list[str], width: float = 60.0, to: str = "active") -> DataFrame:
    """``points`` with ``to``: all intervals, start <= at < end, that hold them, as an array of (start, end, keep).

    The array's order is not defined. A point with a null place or key is in no interval; an interval
    with a null end or key, or none that is after its start, holds nothing; places are compared as doubles.
    """
    ship_package(points.sparkSession)
    held = intervals.where(F.col(start) < F.col(end)).where(" AND ".join(f"`{c}` IS NOT NULL" for c in key))
    longest = held.agg(F.max(F.col(end).cast("double") - F.col(start).cast("double"))).first()[0] or 0.0
    stretch = max(STRETCH * width, longest)
    item = F.struct(F.col(start).alias("start"), F.col(end).alias("end"), *[F.col(c) for c in keep])
    row = F.struct(*[F.col(f"`{c}`") for c in points.columns])
    sample = points.select(row.alias("r")).schema["r"].dataType
    kind = held.select(item.alias("i")).schema["i"].dataType
    number = lambda c: F.floor(c / stretch).cast("long")
    s, e = F.col(start).cast("double"), F.col(end).cast("double")
    own = held.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key)], s.alias("s"), e.alias("e"), item.alias("item"), F.lit(None).cast(sample).alias("row"))
    own = own.withColumn("part", F.explode(F.array_distinct(F.array(number(F.col("s")), number(F.col("e")))))).withColumn("t", F.greatest("s", F.col("part") * F.lit(stretch)))
    spots = points.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key)], F.lit(None).cast("double").alias("s"), F.lit(None).cast("double").alias("e"), F.lit(None).cast(kind).alias("item"), row.alias("row"), F.col(at).cast("double").alias("t"))
    spots = spots.withColumn("part", number(F.col("t")))
    names = [f"k{i}" for i in range(len(key))] + ["part"]
    both = own.select(*names, "t", "e", "item", "row").unionByName(spots.select(*names, "t", "e", "item", "row"))

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, open_ = None, []
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i) for i in range(len(names))]
            fresh = _changes(cols, group)
            t, e = (b.column(i).to_numpy(zero_copy_only=False) for i in (len(names), len(names) + 1))
            items, spot = b.column(len(names) + 2), b.column(len(names) + 3).is_valid().to_numpy(zero_copy_only=False)
            rows, found = np.flatnonzero(spot), []
            for i in range(b.num_rows):
                if fresh[i]:
                    open_ = []
                if spot[i]:
                    if open_:
                        open_ = [x for x in open_ if x[0] > t[i]]
                    found.append([x[1] for x in open_] if t[i] == t[i] else [])
                else:
                    open_.append((e[i], items[i].as_py()))
            group = [c[b.num_rows - 1].as_py() for c in cols]
            yield pa.record_batch([b.column(len(names) + 3).take(pa.array(rows)), pa.array(found, pa.list_(items.type))], names=["row", "found"])

    # intervals that begin where a point lies come before it
    ordered = both.repartition(*names).sortWithinPartitions(*names, "t", F.col("row").isNotNull())
    got = ordered.mapInArrow(swept, f"row {sample.simpleString()}, found array<{kind.simpleString()}>")
    name = unused(points.columns, to) if to in points.columns else to
    return got.select("row.*", F.col("found").alias(name))
