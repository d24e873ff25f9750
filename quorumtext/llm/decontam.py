"""Benchmark decontamination: prefix-filtered set join of item windows with documents.

A window is ``window`` consecutive words of an item (a shorter item is one window).
Finding a whole window in a document is a containment join at threshold 1, for which
the prefix of a window's shingles, ordered from rare to common over the corpus, is its
single rarest shingle. So

1. one pass counts in how many documents each benchmark shingle occurs (pre-summed in
   each task; the counts that meet are bounded by the benchmark, not by the corpus);
2. each window keeps its rarest shingle and that shingle's place in the window;
3. a second pass looks document shingles up among these prefix tokens. The place fixes
   where the window would start (positional bound), the document's end must leave room
   for all of it (length bound), and the words are then compared byte by byte.

Documents never shuffle. Distinct windows are numbered and dealt to blocks of ``block_windows`` by
number, so what is broadcast has that bound whatever the benchmark's size, the length of one item or the
items that share a window. A block is one pass that counts shingles, and one more map in
the single pass that searches; each adds its windows to what the row has so far. Which items own a
window stays a table: it meets the different sets of windows that documents hold, not
the documents, and each set's items are sorted in ranges and hashed as they pass.

Edge cases: a null or empty text has no words and no hits; an item without words has no
window; the windows of an item without an id hit, but name no item; rows with one item_id
are one item; repeated documents, and those without an id, are judged each by itself; extra
columns are ignored; an empty table of documents gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.llm.digest import joined_sha256
from quorumtext.llm.textbatch import LOWER, shingle_hashes, slices, span_hashes, word_spans
from quorumtext.runtime import cut

#: Words are runs of 0-9, a-z (after lower-casing A-Z) and all bytes beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True

# The same words as a pattern, once A-Z is lowered.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 200_000
_SIEVE_BITS = 20


class WindowIndex:
    """The windows of one block with their numbers and shingles; small, built on the driver."""

    def __init__(self, windows: list[tuple[int, list[str]]], shingle: int):
        self.numbers = [n for n, _ in windows]
        self.windows = [tuple(x.encode() for x in w) for _, w in windows]
        self.tokens: list[list[tuple[int, int]]] = []  # per window: (shingle hash, place)
        self.sizes: list[int] = []
        for w in self.windows:
            k = min(shingle, len(w))
            data = np.frombuffer(b" ".join(w), np.uint8)
            s, e, first = word_spans(data, np.array([0, len(data)]), IS_WORD)
            h, at, _ = shingle_hashes(span_hashes(data, s, e), first, k)
            self.tokens.append([(int(x), int(p)) for x, p in zip(h, at, strict=True)])
            self.sizes.append(k)

    def shingles(self) -> dict[int, np.ndarray]:
        """Sorted distinct shingle hashes by shingle size."""
        by: dict[int, set[int]] = {}
        for k, t in zip(self.sizes, self.tokens, strict=True):
            by.setdefault(k, set()).update(h for h, _ in t)
        return {k: np.array(sorted(v), np.uint64) for k, v in by.items()}

    def prefixes(self, df_of: dict[int, int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By shingle size: sorted prefix hashes with window number and place; rarest first, then leftmost."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for w, (k, t) in enumerate(zip(self.sizes, self.tokens, strict=True)):
            h, p = min(t, key=lambda x: (df_of.get(x[0], 0), x[1]))
            by.setdefault(k, []).append((h, w, p))
        return {k: (np.array([x[0] for x in sorted(v)], np.uint64), np.array([x[1] for x in sorted(v)]), np.array([x[2] for x in sorted(v)])) for k, v in by.items()}


def item_windows(benchmark: DataFrame, item_id: str, item_text: str, window: int) -> DataFrame:
    """(words, item): the different windows of all items, with the id, as a string, of each item that holds them."""
    low = F.translate(F.coalesce(F.col(item_text), F.lit("")), _UPPER, _UPPER.lower())
    own = benchmark.select(F.col(item_id).cast("string").alias("item"), F.regexp_extract_all(low, F.lit(WORD), F.lit(0)).alias("all")).where("size(all) > 0")
    n = F.least(F.size("all"), F.lit(window))
    rows = own.select("item", n.alias("n"), "all", F.explode(F.sequence(F.lit(1), F.size("all") - n + 1)).alias("i"))
    return rows.select(F.slice("all", F.col("i"), F.col("n")).alias("words"), "item").distinct()


def numbered(windows: DataFrame) -> DataFrame:
    """``windows`` (words) with ``w``, running numbers from 0: each part's rows behind those of the parts before."""
    parts = cut(windows.withColumn("part", F.spark_partition_id()))
    before, n = {0: 0}, 0
    for r in parts.groupBy("part").count().orderBy("part").collect():
        before[r.part] = n
        n += r["count"]
    first = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("part"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("words"))
    return parts.select("words", (first + own - 1).cast("long").alias("w"))


def _sieve(keys: np.ndarray) -> np.ndarray:
    s = np.zeros(1 << _SIEVE_BITS, bool)
    s[keys >> np.uint64(64 - _SIEVE_BITS)] = True
    return s


def _matches(h: np.ndarray, keys: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which h are among the sorted keys: (index into h, first and last key position)."""
    i = np.flatnonzero(sieve[h >> np.uint64(64 - _SIEVE_BITS)])
    lo, hi = np.searchsorted(keys, h[i], "left"), np.searchsorted(keys, h[i], "right")
    ok = lo < hi
    return i[ok], lo[ok], hi[ok]


def _document_frequencies(docs: DataFrame, text: str, shingles: dict[int, np.ndarray]) -> dict[int, int]:
    sent = docs.sparkSession.sparkContext.broadcast(shingles)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = sent.value
        sieves = {k: _sieve(v) for k, v in mine.items()}
        totals = {k: np.zeros(len(v), np.int64) for k, v in mine.items()}
        for b in batches:
            for s in slices(b.column(0)):
                data = LOWER[s.data]
                st, en, first = word_spans(data, s.bounds, IS_WORD)
                words = span_hashes(data, st, en)
                for k, keys in mine.items():
                    h, _, row = shingle_hashes(words, first, k)
                    i, lo, _ = _matches(h, keys, sieves[k])
                    pairs = np.unique(row[i] * len(keys) + lo)
                    totals[k] += np.bincount(pairs % len(keys), minlength=len(keys)) if len(pairs) else 0
        for k, n in totals.items():
            got = np.flatnonzero(n)
            yield pa.record_batch({"h": pa.array(mine[k][got].view(np.int64)), "n": pa.array(n[got])})

    per = docs.select(text).mapInArrow(count, "h long, n long")
    return {int(np.int64(r.h).view(np.uint64)): r.n for r in per.groupBy("h").agg(F.sum("n").alias("n")).collect()}


_FOUND = "n_words long, n_hit long, windows array<long>, ranges array<struct<a:long,z:long>>"


def find_windows(docs: DataFrame, index: WindowIndex, rare: dict[int, int], text: str, keep: tuple[str, ...]) -> DataFrame:
    """``docs`` (keep, text) with n_words, n_hit, the numbers of windows found and the ranges of hit words; what they hold of an earlier block is added to."""
    sent = docs.sparkSession.sparkContext.broadcast((index.prefixes(rare), index.windows, np.array(index.numbers, np.int64)))
    more = "n_words" in docs.columns[len(keep) :]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes, windows, numbers = sent.value
        length = np.array([len(w) for w in windows] or [0])
        sieves = {k: _sieve(v[0]) for k, v in prefixes.items()}
        for b in batches:
            out: list[tuple[int, int, list[int], list[tuple[int, int]]]] = []
            known = list(zip(b.column(len(keep) + 3).to_pylist(), b.column(len(keep) + 4).to_pylist(), strict=True)) if more else None
            for s in slices(b.column(len(keep))):
                data = LOWER[s.data]
                raw = data.tobytes()
                st, en, first = word_spans(data, s.bounds, IS_WORD)
                words = span_hashes(data, st, en)
                found: dict[int, set[int]] = {}
                ranges: dict[int, list[tuple[int, int]]] = {}
                for k, (keys, win, place) in prefixes.items():
                    h, at, row = shingle_hashes(words, first, k)
                    i, lo, hi = _matches(h, keys, sieves[k])
                    n = hi - lo
                    which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    i = np.repeat(i, n)
                    begin, r, w = at[i] - place[which], row[i], win[which]
                    fits = (begin >= first[r]) & (begin + length[w] <= first[r + 1])
                    for a, d, x in zip(begin[fits].tolist(), r[fits].tolist(), w[fits].tolist(), strict=True):
                        z = a + len(windows[x])
                        if all(raw[p:q] == v for p, q, v in zip(st[a:z].tolist(), en[a:z].tolist(), windows[x], strict=True)):
                            found.setdefault(d, set()).add(int(numbers[x]))
                            ranges.setdefault(d, []).append((int(a - first[d]), int(z - first[d])))
                for d, total in enumerate(np.diff(first).tolist()):
                    hits, places = found.get(d, set()), ranges.get(d, [])
                    if known is not None:
                        hits = hits | set(known[s.lo + d][0])
                        places = places + [(x["a"], x["z"]) for x in known[s.lo + d][1]]
                    places = _union(places)
                    out.append((total, sum(z - a for a, z in places), sorted(hits), places))
            cols = {**dict(zip((*keep, text), b.columns, strict=False)), "n_words": pa.array([x[0] for x in out], pa.int64()), "n_hit": pa.array([x[1] for x in out], pa.int64()), "windows": pa.array([x[2] for x in out], pa.list_(pa.int64())), "ranges": pa.array([[{"a": p, "z": q} for p, q in x[3]] for x in out], pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())])))}
            yield pa.record_batch(cols)

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (*keep, text))
    return docs.mapInArrow(search, f"{kinds}, {_FOUND}")


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _searches(docs: DataFrame, windows: DataFrame, text: str, shingle: int, block_windows: int) -> list[tuple[WindowIndex, dict[int, int]]]:
    """Each block's index and how many of ``docs`` hold each of its shingles; one block at least."""
    blocks = max(1, -(-windows.count() // block_windows))
    out = []
    for k in range(blocks):
        rows = windows.where(F.floor(F.col("w") / block_windows) == k).collect()
        index = WindowIndex([(r.w, r.words) for r in rows], shingle)
        out.append((index, _document_frequencies(docs, text, index.shingles()) if rows else {}))
    return out


def without_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text holds no window of any item.

    No row shuffles: a pass a block counts shingles, and one pass searches for all blocks.
    """
    windows = numbered(item_windows(benchmark, item_id, item_text, window).select("words").distinct())
    own = [f"c{i}" for i in range(len(docs.columns))]  # so no column is called like a finding
    at = own[docs.columns.index(text)]
    left = docs.toDF(*own)
    keep = tuple(c for c in own if c != at)
    for index, rare in _searches(left, windows, at, shingle, block_windows):
        left = find_windows(left.select(*keep, at), index, rare, at, keep).where("n_hit = 0").select(*own)
    return left.toDF(*docs.columns)


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block_windows: int = BLOCK_WINDOWS, with_items: bool = True) -> DataFrame:
    """Columns doc_id, n_words, n_hit, ranges (hit word ranges), n_items, items_sha256 (their sorted ids, comma-joined) and, if ``with_items``, items; one row per document.

    ``items`` repeats a set's ids in each document that holds it: leave it out where windows are shared by very many items.
    """
    owners = cut(item_windows(benchmark, item_id, item_text, window))
    windows = numbered(owners.select("words").distinct())
    owners = cut(owners.where("item IS NOT NULL").join(windows.hint("merge"), "words").select("w", "item"))
    left = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    for index, rare in _searches(left, windows, "text", shingle, block_windows):
        left = find_windows(left, index, rare, "text", ("doc_id",))
    found = cut(left.drop("text").withColumn("held", F.when(F.size("windows") > 0, F.sha2(F.array_join(F.transform("windows", lambda w: w.cast("string")), ","), 256))))
    sets = found.where("held IS NOT NULL").groupBy("held").agg(F.first("windows").alias("windows")).select("held", F.explode("windows").alias("w"))
    named = cut(sets.join(owners.hint("merge"), "w").select("held", "item").distinct())
    per = joined_sha256(named, "held", "item").select(F.col("held").alias("set"), F.col("n").alias("n_items"), F.col("sha256").alias("items_sha256"))
    none = F.array().cast("array<string>")
    if with_items:
        lists = named.groupBy(F.col("held").alias("set")).agg(F.array_sort(F.collect_list("item")).alias("items"))
        per = per.join(lists, "set")
    per = cut(per)
    hit = found.where("held IS NOT NULL").join(per.hint("merge"), F.col("held") == F.col("set"), "left")
    clean = found.where("held IS NULL").withColumns({"n_items": F.lit(0).cast("long"), "items_sha256": F.lit(hashlib.sha256(b"").hexdigest())})
    if with_items:
        clean = clean.withColumn("items", none)
    out = hit.drop("set").unionByName(clean)
    shown = ["doc_id", "n_words", "n_hit", "ranges", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("items_sha256")]
    return out.select(*shown, *([F.coalesce("items", none).alias("items")] if with_items else []))


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    """Digest of ``decontaminate`` over all documents and benchmark items."""
    from quorumtext.runtime import ship_package, table

    ship_package(spark)
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), with_items=False)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    win AS (
        SELECT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM win),
    occ AS (
        SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
    hit AS (SELECT DISTINCT o.doc_id, o.i, o.n, win.item_id FROM occ o JOIN win ON o.n = win.n AND o.s = win.s),
    words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
