"""Alignment of two word sequences of a recording: layers, captions, corrected copies.

1. Anchors: runs of ``n`` words that stand once on either side, found by one group-by of hashed
   runs. They are pairs of places; texts do not meet.
2. Chain: the longest run of anchors that rises on both sides, by patience sorting. Only
   places reach the task of a recording.
3. Gaps: the words between neighbouring anchors of the chain, dealt to tasks by (recording,
   gap), are aligned at the least number of edits inside a band, which is doubled until it is
   sure to hold that alignment; a gap whose band would take more than ``_CELLS`` numbers is halved first, at
   a place that some best alignment passes.

A gap is thus aligned exactly, and the whole is exact where the chain lies on a best
alignment. Words are compared without case and the punctuation around them.

Edge cases: a null text has no words; a recording that only one side has is aligned with
nothing; a null key is a recording of its own; texts without anchors are one gap; equal turns are
told apart by their order only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.functions.text import words
from quorumtext.runtime import cut, ship_package

RUN = 3
_CELLS = 1 << 23
_FAR = 1 << 28


def bare(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, r"^\p{Punct}+|\p{Punct}+$", ""))


def placed_words(turns: DataFrame, key: list[str], order: list[str], text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, keep, pos, word, h): bare words of turns in order, their place in the recording from 0, and a hash."""
    own = turns.select(*key, *order, *[c for c in keep if c not in order], F.posexplode(words(text)).alias("_i", "_w"))
    pos = F.row_number().over(Window.partitionBy(*key).orderBy(*order, "_i")) - 1
    return own.select(*key, *keep, pos.alias("pos"), bare(F.col("_w")).alias("word")).withColumn("h", F.xxhash64("word"))


def anchors(a: DataFrame, b: DataFrame, key: list[str], n: int = RUN) -> DataFrame:
    """(key, a_pos, b_pos): where runs of ``n`` words that each side has once begin; sides have key, pos and h."""

    def runs(side: DataFrame, ours: bool) -> DataFrame:
        w = Window.partitionBy(*key).orderBy("pos")
        ahead = [F.lead("h", k).over(w) for k in range(n)]
        own = side.select(*key, "pos", *[c.alias(f"_{k}") for k, c in enumerate(ahead)]).where(F.col(f"_{n - 1}").isNotNull())
        return own.select(*key, F.xxhash64(*[f"_{k}" for k in range(n)]).alias("_g"), F.when(F.lit(ours), F.col("pos")).alias("a_pos"), F.when(F.lit(not ours), F.col("pos")).alias("b_pos"))

    both = runs(a, True).unionByName(runs(b, False)).groupBy(*key, "_g")
    once = both.agg(F.count("a_pos").alias("_na"), F.count("b_pos").alias("_nb"), F.min("a_pos").alias("a_pos"), F.min("b_pos").alias("b_pos"))
    return once.where("_na = 1 AND _nb = 1").select(*key, "a_pos", "b_pos")


def rising(b: list[int]) -> list[int]:
    """Indices of a longest strictly rising subsequence."""
    tails: list[int] = []
    last: list[int] = []
    before = [-1] * len(b)
    for i, x in enumerate(b):
        k = bisect_left(tails, x)
        before[i] = last[k - 1] if k else -1
        if k == len(tails):
            tails.append(x)
            last.append(i)
        else:
            tails[k], last[k] = x, i
    out, at = [], last[-1] if last else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def chain(found: DataFrame, key: list[str]) -> DataFrame:
    """The anchors of a longest chain that rises on both sides, per recording."""

    per = found.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("a_pos", "b_pos"))).alias("_places"))

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, places = pc.list_value_length(batch.column(len(key))).to_numpy(), batch.column(len(key)).flatten()
            b, kept, rows, end = places.field("b_pos").to_numpy(), [], [], 0
            for r, n in enumerate(size.tolist()):
                own = b[end : end + n]
                at = np.arange(n) if (own[1:] > own[:-1]).all() else np.array(rising(own.tolist()), np.int64)
                kept.append(at + end)
                rows.append(np.full(len(at), r))
                end += n
            at, row = (pa.array(np.concatenate(x or [np.zeros(0, np.int64)])) for x in (kept, rows))
            yield pa.record_batch([*[batch.column(i).take(row) for i in range(len(key))], places.field("a_pos").take(at), places.field("b_pos").take(at)], names=[*key, "a_pos", "b_pos"])

    return per.select(*key, "_places").mapInArrow(longest, found.schema)


def banded(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Edit distances of all prefixes of a and b on the diagonals within k of those of both ends; and the lowest diagonal."""
    n, m = len(a), len(b)
    low, high = min(0, m - n) - k, max(0, m - n) + k
    c = np.arange(high - low + 1)
    out = np.full((n + 1, len(c)), _FAR, np.int32)
    j = low + c
    out[0] = np.where((j >= 0) & (j <= m), j, _FAR)
    for i in range(1, n + 1):
        j = i + low + c
        inside = (j >= 0) & (j <= m)
        row = np.full(len(c), _FAR, np.int32)
        row[:-1] = out[i - 1, 1:] + 1
        at = (j >= 1) & (j <= m)
        row[at] = np.minimum(row[at], out[i - 1, at] + (b[j[at] - 1] != a[i - 1]))
        row[~inside] = _FAR
        row = np.minimum.accumulate(row - c) + c
        row[~inside] = _FAR
        out[i] = row
    return out, low


def _last_row(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edit distances of a to all prefixes of b."""
    c = np.arange(len(b) + 1)
    row = c.copy()
    for i, x in enumerate(a, 1):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (b != x))
        new[0] = i
        row = np.minimum.accumulate(new - c) + c
    return row


def edit_path(a: np.ndarray, b: np.ndarray, cells: int = _CELLS) -> list[tuple[int, int]]:
    """A best alignment of a with b: pairs of indices, -1 for a word without partner.

    Equal words at either end go together first, so what is missing stays in one piece.
    """
    least = min(len(a), len(b))
    unlike = np.flatnonzero(a[:least] != b[:least])
    head = int(unlike[0]) if len(unlike) else least
    unlike = np.flatnonzero(a[::-1][: least - head] != b[::-1][: least - head])
    tail = int(unlike[0]) if len(unlike) else least - head
    if head or tail:
        inner = edit_path(a[head : len(a) - tail], b[head : len(b) - tail], cells)
        ends = [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
        return [(k, k) for k in range(head)] + [(i + head if i >= 0 else -1, j + head if j >= 0 else -1) for i, j in inner] + ends
    n, m = len(a), len(b)
    if not n or not m:
        return [(i, -1) for i in range(n)] + [(-1, j) for j in range(m)]
    if n == m == 1:
        return [(0, 0)]
    k, turned = 4, m < n  # rows are the shorter side's words; the cells of the band are the same
    while True:
        width = abs(m - n) + 2 * k + 1
        if n > 1 and (n + 1) * width > cells:
            half = n // 2
            at = int(np.argmin(_last_row(a[:half], b) + _last_row(a[half:][::-1], b[::-1])[::-1]))
            rest = edit_path(a[half:], b[at:], cells)
            return edit_path(a[:half], b[:at], cells) + [(i + half if i >= 0 else -1, j + at if j >= 0 else -1) for i, j in rest]
        d, low = banded(b, a, k) if turned else banded(a, b, k)
        if d[-1, abs(n - m) - low if turned else m - n - low] <= k or k >= n + m:
            break
        k *= 2
    out, i, j = [], n, m
    d = d.tolist() if d.size <= 1 << 16 else d
    while i or j:
        c = (i - j if turned else j - i) - low
        here = d[j][c] if turned else d[i][c]
        if i and j and here == (d[j - 1][c] if turned else d[i - 1][c]) + (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and (c > 0 if turned else c + 1 < len(d[0])) and here == (d[j][c - 1] if turned else d[i - 1][c + 1]) + 1:
            i -= 1
            out.append((i, -1))
        else:
            j -= 1
            out.append((-1, j))
    return out[::-1]


def aligned(a: DataFrame, b: DataFrame, key: list[str], n: int = RUN) -> DataFrame:
    """(key, a_pos, b_pos, same): every word of either side once; a place is null where a word has no partner.

    ``same`` tells pairs of equal words from those of different ones. Sides: key, pos, h.
    """
    ship_package(a.sparkSession)
    a, b = cut(a.select(*key, "pos", "h")), cut(b.select(*key, "pos", "h"))
    links = cut(chain(anchors(a, b, key, n), key))

    def gaps(side: DataFrame, ours: bool) -> DataFrame:
        place = "a_pos" if ours else "b_pos"
        own = links.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], F.col(place).alias("_at"))
        on = F.col("pos") == F.col("_at")
        for i, c in enumerate(key):
            on &= F.col(c).eqNullSafe(F.col(f"_k{i}"))
        marked = side.join(own.hint("merge"), on, "left")
        upto = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        item = F.struct("pos", "h")
        return marked.withColumn("gap", F.count("_at").over(upto)).where("_at IS NULL").select(*key, "gap", F.when(F.lit(ours), item).alias("_a"), F.when(F.lit(not ours), item).alias("_b"))

    per = gaps(a, True).unionByName(gaps(b, False)).groupBy(*key, "gap").agg(F.array_sort(F.collect_list("_a")).alias("_a"), F.array_sort(F.collect_list("_b")).alias("_b")).drop("gap")

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ours, theirs, same = [], [], [], []
            for r, (x, y) in enumerate(zip(batch.column(len(key)), batch.column(len(key) + 1), strict=True)):
                (pos_a, h_a), (pos_b, h_b) = ((s.values.field("pos").to_pylist(), s.values.field("h").to_numpy(zero_copy_only=False)) for s in (x, y))
                for i, j in edit_path(h_a, h_b):
                    rows.append(r)
                    ours.append(pos_a[i] if i >= 0 else None)
                    theirs.append(pos_b[j] if j >= 0 else None)
                    same.append(bool(i >= 0 and j >= 0 and h_a[i] == h_b[j]))
            at = pa.array(rows, pa.int64())
            yield pa.record_batch([*[batch.column(i).take(at) for i in range(len(key))], pa.array(ours, pa.int32()), pa.array(theirs, pa.int32()), pa.array(same, pa.bool_())], names=[*key, "a_pos", "b_pos", "same"])

    kinds = ", ".join(f"`{c}` {a.schema[c].dataType.simpleString()}" for c in key)
    between = per.select(*key, "_a", "_b").mapInArrow(paths, f"{kinds}, a_pos int, b_pos int, same boolean")
    return links.withColumn("same", F.lit(True)).unionByName(between)


def missing_by_turn(a: DataFrame, b: DataFrame, key: list[str], seq: str = "seq", text: str = "text", n: int = RUN) -> DataFrame:
    """(key, seq, n_words, n_missing, n_changed): of each turn of ``a``, words that ``b`` lacks, or has another word for.

    With captions as ``a`` and a transcript as ``b`` this finds content that a transcript
    lacks, wherever its turns stand in time. A turn without words has zeros.
    """
    ours = cut(placed_words(a, key, [seq], text, (seq,)))
    links = aligned(ours, placed_words(b, key, [seq], text), key, n).where("a_pos IS NOT NULL")
    on = F.col("pos") == F.col("a_pos")
    renamed = links.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], "a_pos", "b_pos", "same")
    for i, c in enumerate(key):
        on &= F.col(c).eqNullSafe(F.col(f"_k{i}"))
    per = ours.join(renamed.hint("merge"), on).groupBy(*key, seq).agg(F.count(F.lit(1)).alias("n_words"), F.count_if(F.col("b_pos").isNull()).alias("n_missing"), F.count_if(F.col("b_pos").isNotNull() & ~F.col("same")).alias("n_changed"))
    rest = a.select(*key, seq).distinct()
    zeros = rest.select(*key, seq, *[F.lit(0).cast("long").alias(c) for c in ("n_words", "n_missing", "n_changed")])
    return per.unionByName(zeros).groupBy(*key, seq).agg(*[F.max(c).alias(c) for c in ("n_words", "n_missing", "n_changed")])


def distances(a: DataFrame, b: DataFrame, key: list[str], n: int = RUN) -> DataFrame:
    """(key, n_a, n_b, n_edits) per recording: words of either side, and edits of the alignment; sides have key, pos, h."""
    per = aligned(a, b, key, n).groupBy(*key)
    return per.agg(F.count("a_pos").alias("n_a"), F.count("b_pos").alias("n_b"), F.count_if(~F.col("same")).alias("n_edits"))


def aligned_label_errors(words_of: DataFrame, gold: DataFrame, n: int = RUN) -> DataFrame:
    """Per recording: words whose speaker differs from that of the same word in a corrected copy of any length.

    Both have video_id, pos, word, speaker. Words without a partner are counted apart, as
    ``n_unmatched``: what has no counterpart can have no wrong label.
    """
    sides = [w.select("video_id", "pos", bare(F.col("word")).alias("word"), "speaker").withColumn("h", F.xxhash64("word")) for w in (words_of, gold)]
    links = aligned(*sides, ["video_id"], n).where("a_pos IS NOT NULL")
    ours = sides[0].select("video_id", F.col("pos").alias("a_pos"), "speaker")
    theirs = sides[1].select("video_id", F.col("pos").alias("b_pos"), F.col("speaker").alias("_gold"))
    both = links.join(ours, ["video_id", "a_pos"]).join(theirs, ["video_id", "b_pos"], "left")
    wrong = F.col("b_pos").isNotNull() & ~F.col("speaker").eqNullSafe(F.col("_gold"))
    out = both.groupBy("video_id").agg(F.count_if(wrong).alias("n_wrong"), F.count("b_pos").alias("n_words"), F.count_if(F.col("b_pos").isNull()).alias("n_unmatched"))
    return out.withColumn("rate", F.col("n_wrong") / F.nullif(F.col("n_words"), F.lit(0)))
