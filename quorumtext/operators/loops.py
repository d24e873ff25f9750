"""Repetition loops of any period, in words and inside words: finding, deciding, cutting.

A loop is a maximal repetition: a stretch with period p that cannot be made longer. For
k = 1, 2, 4, ... all runs of k symbols are hashed (each from two of half the length) and
sorted; one whose nearest earlier equal lies p back, k / 2 < p <= k, is inside a repetition of
the least period p, and each maximal stretch of such places is one repetition, whole and with its
exact ends. Only runs that occur twice can be part of longer ones that do, so the work
shrinks with k; at most it is n log n comparisons for n symbols, for all periods together.

Loops are a column of each text, so nothing shuffles.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.operators.quality import loop_decision
from quorumtext.runtime import ship_package

LOOP = "array<struct<unit:string,first:int,period:int,repeats:int,begin:int,end:int,phrase:string>>"
_WORD = re.compile("[^ \t\n\r\f\x0b]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def repetitions(symbols: np.ndarray, bounds: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
    """(row, start, period, end) of all maximal repetitions of ``least`` or more periods, three at least; row i is bounds[i]:bounds[i+1]."""
    least = max(3, least)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    h = _mixed(symbols.astype(np.uint64) * _ODD + row.astype(np.uint64) + np.uint64(1))  # equal only within a row
    at, k, found = np.arange(len(symbols)), 1, []
    while len(at):
        order = np.argsort(h, kind="stable")
        again = h[order[1:]] == h[order[:-1]]
        here, back = at[order[1:][again]], (at[order[1:]] - at[order[:-1]])[again]
        repeated = np.zeros(len(at), bool)
        repeated[order[1:][again]] = repeated[order[:-1][again]] = True
        if not len(here):
            break
        own = (2 * back > k) & (back <= k)
        place, p = here[own], back[own]
        rise = np.argsort(place, kind="stable")
        place, p = place[rise], p[rise]
        if len(place):
            head = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(p) != 0)])
            heads = np.flatnonzero(head)
            tails = np.append(heads[1:], len(place)) - 1
            start, end, period = place[heads] - p[heads], place[tails] + k, p[heads]
            for s, e, q in zip(start.tolist(), end.tolist(), period.tolist(), strict=True):
                if e - s >= least * q and np.array_equal(symbols[s : e - q], symbols[s + q : e]):  # hashes only propose
                    r = int(row[s])
                    found.append((r, s - int(bounds[r]), q, e - int(bounds[r])))
        at, h = at[repeated], h[repeated]
        then = np.searchsorted(at, at + k)
        pair = np.flatnonzero((then < len(at)) & (at[np.minimum(then, len(at) - 1)] == at + k))
        pair = pair[row[at[pair]] == row[at[then[pair]]]]
        at, h, k = at[pair], _mixed(h[pair] * _ODD + h[then[pair]]), 2 * k
    return sorted(found)


def loops_in(texts: list[str], least: int) -> list[list[dict]]:
    """Of each text its loops: of words (compared without case and punctuation around them), and of characters inside a word."""
    out: list[list[dict]] = [[] for _ in texts]
    spans = [[m.span() for m in _WORD.finditer(t)] for t in texts]
    numbers: dict[str, int] = {}
    bare = [[t[a:b].strip(string.punctuation).lower() for a, b in own] for t, own in zip(texts, spans, strict=True)]
    symbols = np.array([numbers.setdefault(w, len(numbers)) for own in bare for w in own], np.int64)
    for r, s, p, e in repetitions(symbols, np.concatenate([[0], np.cumsum([len(x) for x in spans])]).astype(np.int64), least):
        own = spans[r]
        out[r].append({"unit": "word", "first": s, "period": p, "repeats": (e - s) // p, "begin": own[s + p - 1][1], "end": own[e - 1][1], "phrase": " ".join(bare[r][s : s + p])})
    long = [(r, a, b) for r, own in enumerate(spans) for a, b in own if b - a >= max(3, least)]
    if long:
        codes = np.concatenate([np.frombuffer(texts[r][a:b].encode("utf-32-le", "surrogatepass"), np.uint32) for r, a, b in long])
        for i, s, p, e in repetitions(codes, np.concatenate([[0], np.cumsum([b - a for _, a, b in long])]).astype(np.int64), least):
            r, a, _ = long[i]
            out[r].append({"unit": "char", "first": a + s, "period": p, "repeats": (e - s) // p, "begin": a + s + p, "end": a + e, "phrase": texts[r][a + s : a + s + p]})
    return out


def loops_of(text: str | Column, least: int = 5) -> Column:
    """Loops of a text: unit, first (word or code point, from 0), period, repeats, begin and end of what follows the first
    instance (code points, the part-repeat behind the last included), phrase. A null text has none."""

    def each(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("unit", pa.string()), *[(c, pa.int32()) for c in ("first", "period", "repeats", "begin", "end")], ("phrase", pa.string())]))
        for col in columns:
            texts, found, size, lo = [t or "" for t in col.to_pylist()], [], 0, 0
            for i, t in enumerate(texts):  # about a megabyte at once
                size += len(t)
                if size > 1 << 20 or i == len(texts) - 1:
                    found += loops_in(texts[lo : i + 1], least)
                    lo, size = i + 1, 0
            yield pa.array(found, kind)

    return F.arrow_udf(each, LOOP)(F.col(text) if isinstance(text, str) else text)


def loop_rows(texts: DataFrame, key: list[str], text: str = "text", least: int = 5) -> DataFrame:
    """(key, unit, first, period, repeats, begin, end, phrase): a row per loop of ``least`` repeats or more (three at least)."""
    ship_package(texts.sparkSession)
    return texts.select(*key, F.explode(loops_of(text, least)).alias("_x")).select(*key, "_x.*")


def without_spans(text: Column, spans: Column) -> Column:
    """The text without these (begin, end) stretches, in order of their begins; they may overlap."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    piece = lambda s, x: F.substring(text, s["at"] + 1, F.greatest(x["begin"] - s["at"], F.lit(0)))
    step = lambda s, x: F.struct(F.concat(s["out"], piece(s, x)).alias("out"), F.greatest(s["at"], x["end"]).alias("at"))
    return F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text))))


def without_loops(turns: DataFrame, text: str = "text", rate: Column | None = None, speech: Column | None = None, least: int = 5) -> DataFrame:
    """``turns`` with the loops nobody said cut out of ``text``, and ``n_removed`` and ``n_flagged`` loops.

    ``rate`` is the turn's words a second, ``speech`` its share of speech, null where unknown;
    the decision is ``loop_decision``. Of a removed loop the first instance stays, its
    repeats and the part-repeat it stops in go. Other loops stay and are counted as flagged. A
    null text stays null.
    """
    ship_package(turns.sparkSession)
    none = F.lit(None).cast("double")
    decided = F.transform("_loops", lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"), loop_decision(x["repeats"], F.col("_rate"), F.col("_speech")).alias("decision")))
    own = turns.withColumns({"_loops": loops_of(text, least), "_rate": none if rate is None else rate, "_speech": none if speech is None else speech}).withColumn("_loops", decided)
    gone = F.array_sort(F.filter("_loops", lambda x: x["decision"] == "remove"))
    out = own.withColumns({"n_removed": F.size(gone), "n_flagged": F.size("_loops") - F.size(gone), "_cut": F.when(F.size(gone) > 0, without_spans(F.col(text), gone)).otherwise(F.col(text))})
    return out.withColumn(text, F.col("_cut")).drop("_loops", "_rate", "_speech", "_cut")
