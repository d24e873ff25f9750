"""Line dedup by a deletion-neighbourhood join: of lines at most one edit apart the earliest stays.

A line is a part of a text between line feeds; empty ones are left alone. Occurrences are
ordered by (doc_id, line number). An occurrence is removed if an equal line occurs earlier,
or, among lines of at least ``min_chars`` characters (one edit changes a shorter one too
much), if any line at edit distance 1 (one character inserted, deleted or replaced) occurs
first earlier than this line does. Links are not followed further.

1. Each distinct line gets its first occurrence (a grouped minimum over 128-bit hashes).
2. Two lines one edit apart are equal outside one of ``m`` parts of the line, so keys "the
   line without part j" are joined, first for 2 parts over all lines, then for 16 parts over
   those that share a half. Only lines that share such a key with another line can have a
   neighbour; this loses none and saves nearly all variants.
3. These emit the deletion neighbourhood inside the parts in question as hashed keys:
   "without character i, at i" (lines that agree but for character i all share it) and
   "without character i" against whole shorter lines.
4. Equal keys (of 128 bits) meet in grouped minima, never in pairs: a key with very many
   lines costs its rows and no more. Each line takes its earliest neighbour, and the edit
   distance to it is verified on the texts.
5. Before a shuffle, rows that cannot meet any wanted key leave through a sieve of fixed size.

Edge cases: a null text stays null and has no lines; empty lines and a last line without a
line feed are kept as they are; rows with one doc_id count as one document whose rows are
cut alike; rows without a doc_id come before or after no other and lose only lines that
their own text repeats; equal first occurrences are told apart by line hash; extra columns
are passed on by ``remove_lines``, whatever they are called; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.sieve import sieved
from quorumtext.llm.textbatch import _Powers, mix, slices
from quorumtext.runtime import cut, release, unused

MIN_CHARS = 20
FINE_PARTS = 16
_TAG = np.uint64(0xC2B2AE3D27D4EB4F)


def line_id(raw: bytes) -> tuple[int, int]:
    """128-bit hash of a line as two signed longs."""
    x = xxhash.xxh3_128_intdigest(raw)
    hi, lo = x >> 64, x & (1 << 64) - 1
    return hi - (hi >> 63 << 64), lo - (lo >> 63 << 64)


class Lines:
    """Prefix sums of many lines' characters: hashes of a line without some of them in constant time."""

    def __init__(self, chars: np.ndarray, start: np.ndarray, end: np.ndarray):
        n = len(chars)
        self.up, self.down = _Powers.upto(n + 1)
        self.acc = np.zeros(n + 1, np.uint64)
        np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=self.acc[1:])
        self.start, self.end, self.chars, self.more = start, end, chars, np.zeros(0, np.uint64)

    @classmethod
    def of(cls, texts: list[str]) -> Lines:
        chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        end = np.cumsum([len(t) for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
        return cls(chars, np.concatenate([[0], end[:-1]]).astype(np.int64), end)

    def without(self, line: np.ndarray, a: np.ndarray, b: np.ndarray, tag: np.ndarray, turn: int = 0) -> np.ndarray:
        """Hash of lines without their characters a to b, with a tag; each turn uses another base's sums."""
        if turn and not len(self.more):
            self.more = np.zeros(len(self.acc), np.uint64)
            np.cumsum(mix(self.chars.astype(np.uint64) + _TAG) * self.up[: len(self.chars)], out=self.more[1:])
        acc = self.more if turn else self.acc
        s, e = self.start[line], self.end[line]
        a, b = s + a, s + b
        rest = (acc[a] - acc[s]) + (acc[e] - acc[b]) * self.down[b - a]
        h = mix(rest * self.down[s] + (e - s - (b - a)).astype(np.uint64))
        return mix(h + tag.astype(np.uint64) * _TAG).view(np.int64)

    def parts(self, m: int) -> tuple[np.ndarray, ...]:
        """(line, 0 or 1, part, first, end): each part of each line as the shorter or equal (0) and as the longer (1) of a pair."""
        line = np.repeat(np.arange(len(self.start)), 2 * m)
        longer = np.tile(np.repeat([0, 1], m), len(self.start))
        part = np.tile(np.arange(m), 2 * len(self.start))
        base = (self.end - self.start)[line] - longer
        return line, longer, part, base * part // m, base * (part + 1) // m + longer

    def part_keys(self, m: int) -> tuple[np.ndarray, ...]:
        line, longer, part, a, b = self.parts(m)
        base = (self.end - self.start)[line] - longer
        return line, longer, part, self.without(line, a, b, (base << 6 | part) * 64 + m)


def occurrences(docs: DataFrame, doc_id: str, text: str, min_chars: int, keyed: bool) -> DataFrame:
    """(doc_id, line, a, b): the first occurrence of each line in its text; with ``keyed`` also keys, without either half, in both roles (none for short lines)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            for s in slices(batch.column(1)):
                raw, at = s.data.tobytes(), s.bounds.tolist()
                row, no, a, b, kept, full = [], [], [], [], [], []
                for i in range(s.hi - s.lo):
                    seen = set()
                    for k, x in enumerate(raw[at[i] : at[i + 1]].split(b"\n")):
                        if x and x not in seen:
                            seen.add(x)
                            key = line_id(x)
                            row.append(lo + i)
                            no.append(k)
                            a.append(key[0])
                            b.append(key[1])
                            if keyed:
                                line = x.decode("utf-8", "surrogatepass")
                                full.append(len(line) >= min_chars)
                                if full[-1]:
                                    kept.append(line)
                lo += s.hi - s.lo
                cols = {"doc_id": batch.column(0).take(pa.array(row, pa.int64())), "line": pa.array(no, pa.int32()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}
                if keyed:
                    keys = Lines.of(kept).part_keys(2)[3] if kept else np.zeros(0, np.int64)
                    ends = np.concatenate([[0], np.cumsum(4 * np.array(full, np.int64))]).astype(np.int32)
                    cols["keys"] = pa.ListArray.from_arrays(ends, pa.array(keys))
                yield pa.record_batch(cols)

    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(each, f"doc_id {kind}, line int, a long, b long" + ", keys array<long>" * keyed)


def _shared(keyed: DataFrame, keep: list[str]) -> DataFrame:
    """Rows (key, a, b, ...) whose key another line has too, as distinct ``keep``."""
    many = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    release(keyed.sparkSession)
    few = sieved(keyed, F.col("key"), many, F.col("key"))
    return few.join(many.hint("merge"), "key", "left_semi").select(*keep).distinct()


def _texts(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(a, b, first, text) of lines wanted (a, b, first: struct of doc_id and line)."""
    kind = docs.schema[doc_id].dataType.simpleString()
    asked = wanted.groupBy(F.col("first.doc_id").alias("doc_id")).agg(F.collect_list(F.struct(F.col("first.line").alias("line"), "a", "b")).alias("asked"))
    asked = cut(asked)
    own = sieved(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), F.col("doc_id"), asked, F.col("doc_id"))
    own = own.join(asked.hint("merge"), "doc_id").select("doc_id", "text", "asked")
    line = F.element_at(F.split("text", "\n", -1), F.col("x.line") + 1)
    got = own.select("doc_id", "text", F.explode("asked").alias("x")).select("x.a", "x.b", F.struct("doc_id", "x.line").alias("first"), line.alias("text"))
    return got.dropDuplicates(["a", "b"]).select("a", "b", F.col("first").cast(f"struct<doc_id:{kind},line:int>").alias("first"), "text")


def _fine_keys(lines: DataFrame) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo = 0
            for s in slices(b.column(2)):
                own = b.slice(lo, s.hi - s.lo)
                lo += s.hi - s.lo
                line, longer, part, key = Lines.of(own.column(2).to_pylist()).part_keys(FINE_PARTS)
                pick = pa.array(line)
                yield pa.record_batch({"a": own.column(0).take(pick), "b": own.column(1).take(pick), "longer": pa.array(longer.astype(np.int32)), "part": pa.array(part.astype(np.int32)), "key": pa.array(key)})

    return lines.select("a", "b", "text").mapInArrow(each, "a long, b long, longer int, part int, key long")


def _variants(lines: DataFrame, first_kind: str) -> DataFrame:
    """(key, more, role, a, b, first): the deletion neighbourhood of lines (a, b, text, first, parts) inside their parts.

    Roles: 0 without character i, at i; 1 without a character; 2 the line itself.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            for s in slices(batch.column(2), 1 << 18):
                own = batch.slice(lo, s.hi - s.lo)
                lo += s.hi - s.lo
                lines = Lines.of(own.column(2).to_pylist())
                size = lines.end - lines.start
                at, kind, where = [], [], []
                for i, parts in enumerate(own.column(4).to_pylist()):
                    for p in parts:
                        longer, part = p["longer"], p["part"]
                        n = int(size[i]) - longer
                        a, b = n * part // FINE_PARTS, n * (part + 1) // FINE_PARTS
                        if longer:
                            where.append(np.arange(a, b + 1))
                            kind.append(np.full(b + 1 - a, 1))
                        else:
                            where.append(np.append(np.arange(a, b), -1))
                            kind.append(np.append(np.zeros(b - a, np.int64), 2))
                        at.append(np.full(len(where[-1]), i))
                if not at:
                    continue
                at, kind, where = np.concatenate(at), np.concatenate(kind), np.concatenate(where)
                whole = where < 0
                a = np.where(whole, 0, where)
                tag = np.where(kind == 0, (where << 1) | 1, 0)
                key, more = (lines.without(at, a, np.where(whole, a, a + 1), tag, turn) for turn in (0, 1))
                once = np.unique(np.stack([at, kind, key, more]), axis=1, return_index=True)[1]
                pick = pa.array(at[once])
                yield pa.record_batch({"key": pa.array(key[once]), "more": pa.array(more[once]), "role": pa.array(kind[once].astype(np.int32)), "a": own.column(0).take(pick), "b": own.column(1).take(pick), "first": own.column(3).take(pick)})

    return lines.select("a", "b", "text", "first", "parts").mapInArrow(each, f"key long, more long, role int, a long, b long, first {first_kind}")


def neighbours(docs: DataFrame, lines: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(a, b) of the distinct lines (a, b, first, keys) with an earlier line one edit away."""
    near = _shared(lines.select("a", "b", "first", F.explode("keys").alias("key")), ["a", "b", "first"])
    known = cut(_texts(docs, near, doc_id, text))
    parts = _shared(_fine_keys(known), ["a", "b", "longer", "part"]).groupBy("a", "b").agg(F.collect_list(F.struct("longer", "part")).alias("parts"))
    rows = cut(_variants(known.join(parts.hint("merge"), ["a", "b"]), known.schema["first"].dataType.simpleString()))
    who = F.struct("first", "a", "b")
    least = lambda role: F.min(F.when(F.col("role") == role, who))
    meet = rows.groupBy("key", "more").agg(least(0).alias("same"), least(1).alias("longer"), least(2).alias("shorter"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    other = F.when(F.col("role") == 0, F.col("same")).when(F.col("role") == 1, F.col("shorter")).otherwise(F.col("longer"))
    best = rows.join(meet.hint("merge"), ["key", "more"]).select("a", "b", "first", other.alias("other")).where("other.first < first").groupBy("a", "b").agg(F.min("other").alias("other"))
    one = known.select("a", "b", F.col("text").alias("x"))
    two = known.select(F.col("a").alias("oa"), F.col("b").alias("ob"), F.col("text").alias("y"))
    pairs = best.select("a", "b", F.col("other.a").alias("oa"), F.col("other.b").alias("ob")).join(one.hint("merge"), ["a", "b"]).join(two.hint("merge"), ["oa", "ob"])
    return pairs.where(F.levenshtein("x", "y", 1) == 1).select("a", "b")


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, gone: line numbers to remove), besides lines repeated inside their own text."""
    lines = occurrences(docs, doc_id, text, min_chars, True).groupBy("a", "b")
    lines = cut(lines.agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys")))
    release(docs.sparkSession)
    near = cut(neighbours(docs, lines, doc_id, text).withColumn("near", F.lit(True)))
    release(docs.sparkSession)
    fate = lines.select("a", "b", "first", "n").join(near.hint("merge"), ["a", "b"], "left").where("n > 1 OR near").select("a", "b", "first", F.coalesce("near", F.lit(False)).alias("near"))
    fate = cut(fate)  # so the join with all occurrences can be split where one line is very common
    del lines, near
    release(docs.sparkSession)
    seen = sieved(occurrences(docs, doc_id, text, min_chars, False), F.col("a"), fate, F.col("a"))
    hit = seen.join(fate.hint("merge"), ["a", "b"]).where(F.col("near") | (F.struct("doc_id", "line") != F.col("first")))
    return hit.groupBy("doc_id").agg(F.array_sort(F.collect_list("line")).alias("gone"))


def remove_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, counts: bool = True) -> DataFrame:
    """``docs`` with its texts cut and, with ``counts``, columns n_lines and n_removed (of these names, replaced)."""
    out_id, gone, done = (unused(docs.columns, c) for c in ("gone_id", "gone", "done"))
    found = cut(removals(docs, doc_id, text, min_chars))
    release(docs.sparkSession)
    found = found.select(F.col("doc_id").alias(out_id), F.col("gone").alias(gone))
    own = docs.join(found.hint("merge"), F.col(doc_id) == F.col(out_id), "left")

    @F.pandas_udf("text string, n_lines int, n_removed int")
    def cut_lines(texts, lists):
        import pandas as pd

        out = []
        for t, g in zip(texts, lists, strict=True):
            if t is None:
                out.append((None, 0, 0))
                continue
            drop, lines = set() if g is None else set(g.tolist()), t.split("\n")
            kept, seen = [], {""}
            for i, x in enumerate(lines):
                if not x or (i not in drop and x not in seen):
                    kept.append(x)
                seen.add(x)
            out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])

    own = own.withColumn(done, cut_lines(F.col(text), F.col(gone)))
    new = {text: F.col(f"{done}.text")} | ({c: F.col(f"{done}.{c}") for c in ("n_lines", "n_removed")} if counts else {})
    return own.withColumns(new).drop(out_id, gone, done)


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without their repeated lines."""
    from quorumtext.runtime import ship_package, table

    ship_package(spark)
    return remove_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
    WITH l AS (SELECT doc_id, i - 1 AS line, x[i] AS s FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i
               FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL))),
    d AS (SELECT s, length(s) AS n, min((doc_id, line)) AS first FROM l WHERE s <> '' AND doc_id IS NOT NULL GROUP BY s),
    half AS (SELECT *, n AS base, 0 AS longer, left(s, n // 2) AS p, right(s, n - n // 2) AS q FROM d WHERE n >= 20
             UNION ALL SELECT *, n - 1, 1, left(s, (n - 1) // 2), right(s, n - 1 - (n - 1) // 2) FROM d WHERE n >= 20),
    c AS (SELECT DISTINCT * FROM (
          SELECT x.s AS x, y.s AS y, x.first AS fx, y.first AS fy FROM half x JOIN half y ON x.base = y.base AND x.p = y.p AND x.s <> y.s
          UNION ALL SELECT x.s, y.s, x.first, y.first FROM half x JOIN half y ON x.base = y.base AND x.q = y.q AND x.s <> y.s)),
    near AS (SELECT DISTINCT x FROM c WHERE fy < fx AND (
          (length(x) = length(y) AND len(list_filter(range(1, length(x) + 1), lambda i: x[i] <> y[i])) = 1)
          OR (length(x) = length(y) + 1 AND len(list_filter(range(0, length(x)), lambda i: x[1:i] || x[i + 2:] = y)) > 0)
          OR (length(y) = length(x) + 1 AND len(list_filter(range(0, length(y)), lambda i: y[1:i] || y[i + 2:] = x)) > 0))),
    gone AS (SELECT l.doc_id, l.line FROM l JOIN d USING (s) LEFT JOIN near ON near.x = l.s WHERE near.x IS NOT NULL OR (l.doc_id, l.line) <> d.first),
    kept AS (SELECT l.* FROM l LEFT JOIN gone USING (doc_id, line) WHERE gone.doc_id IS NULL),
    k AS (SELECT doc_id, string_agg(s, chr(10) ORDER BY line) AS text, count(*) AS m FROM kept GROUP BY doc_id),
    t AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id)
    SELECT documents.doc_id, CASE WHEN documents.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
           CAST(coalesce(n, 0) AS INTEGER) AS n_lines, CAST(coalesce(n, 0) - coalesce(m, 0) AS INTEGER) AS n_removed
    FROM documents LEFT JOIN t USING (doc_id) LEFT JOIN k USING (doc_id)
"""
