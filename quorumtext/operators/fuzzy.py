"""Strings within a number of edits of each other, by segments.

A string of n characters is divided into ``edits + 1`` segments of like length. ``edits`` edits
leave one of them whole, so a string within them holds that segment, at most so many places away as
edits lie before it and behind it. Counting these leaves few places: of a string that asks, some
(edits + 1) ** 2 (edits + 2) / 2 substrings at most are looked up, for all lengths that a near string may have.

Segments meet by a hash of length, number and characters, and what meets is verified by the edit
distance, so hashes decide nothing. Strings of at most ``edits`` characters, whose segments may be
empty, meet all that are short enough to be near them. Rows are linear in the strings, and a row holds
its string once, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.runtime import cut


def _segment(n: Column, i: int, edits: int) -> tuple[Column, Column]:
    """Begin, from 0, and length of segment i, from 0, of a string of n characters; the last ones are longer by one."""
    base = F.floor(n / (edits + 1)).cast("int")
    short = edits + 1 - n % (edits + 1)
    return i * base + F.greatest(F.lit(0), i - short), base + F.when(short <= i, 1).otherwise(0)


def _hash(n: Column, i: int, s: Column) -> Column:
    return F.xxhash64(n.cast("int"), F.lit(i), s)


def _segments(s: Column, edits: int) -> Column:
    """The hashes by which a string is found."""
    n = F.char_length(s)
    own = [_hash(n, i, F.substring(s, begin + 1, size)) for i in range(edits + 1) for begin, size in [_segment(n, i, edits)]]
    return F.when(n <= edits, F.array(_hash(n, -1, F.lit("")))).otherwise(F.array(*own))


def _looked_up(s: Column, edits: int) -> Column:
    """The hashes of what strings near this one are found by."""
    m = F.char_length(s)
    out = []
    for longer in range(-edits, edits + 1):  # the string asked has so many characters more than the one found
        n = m - longer
        out.append(F.when((n >= 0) & (n <= edits), _hash(n, -1, F.lit(""))))
        for i in range(edits + 1):
            begin, size = _segment(n, i, edits)
            for off in range(max(-i, longer - (edits - i)), min(i, longer + (edits - i)) + 1):
                at = begin + off
                out.append(F.when((n > edits) & (at >= 0) & (at + size <= m), _hash(n, i, F.substring(s, at + 1, size))))
    return F.array_distinct(F.array_compact(F.array(*out)))


def _as_bytes(s: str) -> Column:
    """A string with one character for each byte of its UTF-8 form."""
    return F.decode(F.encode(s, "UTF-8"), "ISO-8859-1")


def _from_bytes(s: str) -> Column:
    return F.decode(F.encode(s, "ISO-8859-1"), "UTF-8")


def within_edits(a: DataFrame, b: DataFrame, key: list[str], edits: int = 2, q: int | None = None, of_bytes: bool = False) -> DataFrame:
    """(key, s, t, distance): the strings s of ``a`` and t of ``b`` of one key at most ``edits`` edits apart.

    Sides have the key and ``s``. Nulls in either match nothing; repeated rows count once; the empty string is
    a string like others. Edits are of characters, or with ``of_bytes`` of bytes in UTF-8, as DuckDB counts them.
    ``q``, once the size of grams, changes nothing.
    """
    if of_bytes:
        near = within_edits(*(x.select(*key, _as_bytes("s").alias("s")) for x in (a, b)), key, edits)
        return near.select(*key, _from_bytes("s").alias("s"), _from_bytes("t").alias("t"), "distance")
    a, b = (cut(x.select(*key, "s").na.drop().distinct()) for x in (a, b))
    ours = a.select(*key, "s", F.explode(_segments(F.col("s"), edits)).alias("by"))
    theirs = b.select(*key, F.col("s").alias("t"), F.explode(_looked_up(F.col("s"), edits)).alias("by"))
    met = ours.join(theirs, [*key, "by"]).where(F.abs(F.char_length("s") - F.char_length("t")) <= edits)
    near = met.select(*key, "s", "t", F.levenshtein("s", "t", edits).alias("distance"))
    return near.where("distance >= 0").distinct()
