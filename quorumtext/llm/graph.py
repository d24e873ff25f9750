"""Connected components of an edge table by alternating large-star and small-star rounds.

Nothing is gathered: each round is a grouped minimum (combined before its shuffle) and a
sort-merge join, which adaptive execution splits where one vertex holds many edges. Each
round's edges are a table in the shared checkpoint folder, so a lost executor costs one
round at most, and the driver plans the last round as fast as the first; the tables go at
the end. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.runtime import Tables, cut


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return r.n, r.x


def _large_star(edges: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each vertex hands its larger neighbours its smallest one."""
    both = edges.select(F.col("hi").alias("v"), F.col("lo").alias("w")).unionByName(edges.select(F.col("lo").alias("v"), F.col("hi").alias("w")))
    least = keep(both.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("m")))  # so both sides of the join can be split
    out = both.where("w > v").join(least.hint("merge"), "v")
    return out.select(F.col("w").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each vertex hands its smaller neighbours, and itself, its smallest one."""
    least = keep(edges.groupBy("hi").agg(F.min("lo").alias("m")))
    out = edges.join(least.hint("merge"), "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return out.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) of every vertex with an edge to another; component is the smallest vertex reachable.

    Null ends, self loops and repeated edges are allowed and add nothing; without edges
    the result is empty.
    """
    e = edges.where(F.col(u) != F.col(v)).select(F.greatest(u, v).alias("hi"), F.least(u, v).alias("lo")).distinct()
    with Tables(edges.sparkSession, "components") as keep:
        e = keep(e)
        state = _state(e)
        while state[0]:
            e = keep(_small_star(keep(_large_star(e, keep)), keep))
            now = _state(e)
            if now == state:
                break
            state = now
        e = cut(e)
    roots = e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
