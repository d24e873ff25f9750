"""Near-duplicate passages by compact windows.

Tokens are the hashes of five-word shingles (A-Z lowered). For one hash function, a token
that is the minimum of all windows of ``t`` tokens starting in some range owns a *compact
window* of the text's Cartesian tree: all subsequences in it share that min-hash. There are
about 2 n / t of them in a text of n tokens, found by sliding minima over a sparse table;
the tree's other nodes own no passage of the least length.

1. The compact windows of two hash functions are intersected: a *cell* is a run of starts
   whose passages of t tokens share both min-hashes. A band gives 4 n / t rows; they are
   found twice: first all signatures, to learn which several documents have, then the cells of
   these alone. Where a sieve cannot tell them the bands are taken one after the other, so only
   one's rows are shuffled at a time.
2. Cells with equal signatures meet by their key. Each links to one representative, the
   shortest text's, so a passage that very many documents share costs its rows, not pairs.
3. The texts of each (document, representative) pair are compared once: a passage is at
   least t tokens of which the other text holds so many, close together, that the
   similarity of the two token sets is 0.8 or more.
4. A signature whose documents are not one class by then may still hide links between texts that its
   representative does not resemble. All its pairs of different texts of different classes are compared,
   but for cells without a window of which another cell of the signature holds tokens enough: a
   sentence that very many documents have, in surroundings of their own, costs its rows, not pairs.
   First the pairs' common tokens are counted, block by block of the signature's texts; only pairs with
   tokens enough for a passage, each as often as both texts hold it, go on as pairs.
5. Where a cell of a document and its representative's are not inside one verified passage
   on both sides, all windows of t tokens of both cells are hashed whole and equal ones
   linked, so exact passages are found whoever the representative is, also if the two
   share another passage. (What can be missed is an inexact passage without a common signature in
   any band: two windows at 0.8 have one with a chance of 1 - (1 - 0.8 ** 2) ** 4 = 0.983, and a passage has
   as many windows as it is longer.)
6. Components of the links are the classes.

Edge cases: null and empty texts and those under ``min_words`` words have no passage;
passages repeated only inside one document do not count; rows with one doc_id count as one
document; a null doc_id is left out; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.graph import connected_components
from quorumtext.llm.sieve import passes, sieve_of, sieved
from quorumtext.llm.textbatch import LOWER, _Powers, mix, shingle_hashes, slices, span_hashes, word_spans
from quorumtext.runtime import cut, release, shared_checkpoint_dir

SHINGLE = 5
MIN_WORDS = 50
SIMILARITY = 0.8
BANDS = ((1, 2), (3, 4), (5, 6), (7, 8))

#: Texts of a signature that are counted against as many others at once, and their bytes.
BLOCK, BLOCK_BYTES = 512, 1 << 24

IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows of a slice, and where each row's begin (one more than rows)."""
    st, en, first = word_spans(LOWER[data], bounds, IS_WORD)
    h, _, row = shingle_hashes(span_hashes(LOWER[data], st, en), first, SHINGLE)
    return h, np.searchsorted(row, np.arange(len(bounds)))


def sliding_minima(v: np.ndarray, t: int) -> np.ndarray:
    """Minimum of each t consecutive values, from the sparse table's levels up to t."""
    level, size = v, 1
    while 2 * size <= t:
        level = np.minimum(level[: len(level) - size], level[size:])
        size *= 2
    return np.minimum(level[: len(v) - t + 1], level[t - size : t - size + len(v) - t + 1])


def cells(h: np.ndarray, begin: np.ndarray, t: int, band: tuple[int, ...]) -> tuple[np.ndarray, ...]:
    """(key, row, first start, last start) of the cells of one band; starts count from their row's begin."""
    n = len(h)
    if n < t:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    low = np.uint64((1 << 24) - 1)
    at = np.arange(n, dtype=np.uint64) & low
    key = np.zeros(n - t + 1, np.uint64)
    same = np.ones(n - t, bool)
    for f in band:
        v = mix(h + np.uint64(f * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        m = sliding_minima(v & ~low | at, t)  # the place breaks ties and tells the owner
        least = v[(m & low).astype(np.int64)]
        same &= least[1:] == least[:-1]  # a token that is repeated goes on, wherever it stands
        key = mix(key + least)
    inside = row[: n - t + 1] == row[t - 1 :]
    head = np.flatnonzero(inside & np.concatenate([[True], ~same | ~inside[:-1] | (row[1 : n - t + 1] != row[: n - t])]))
    tail = np.flatnonzero(inside & np.concatenate([~same | ~inside[1:] | (row[1 : n - t + 1] != row[: n - t]), [True]]))
    r = row[head]
    return mix(key[head] + np.uint64(band[0])).view(np.int64), r, head - begin[r], tail - begin[r]


def _windows(docs: DataFrame, t: int, *bands: tuple[int, ...], brief: bool = False, sieve: Broadcast | None = None) -> DataFrame:
    """(key, doc_id, n, x) of all cells of these bands, x = x0 << 32 | x1, or (key, doc_id) if brief; docs: (doc_id, text).

    With a sieve of keys most cells of other keys stay away.
    """
    limit = 1 << 22  # bytes of a slice: places must fit 24 bits, so a longer text is cut into overlapping pieces

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo = 0
            for s in slices(b.column(1)):
                h, begin = tokens(s.data, s.bounds)
                pieces = [(h, begin, 0)] if len(h) < limit else [(h[a : a + limit + t - 1], np.array([0, min(limit + t - 1, len(h) - a)]), a) for a in range(0, len(h), limit)]
                for band, (own, cut_at, shift) in ((band, piece) for piece in pieces for band in bands):
                    key, row, x0, x1 = cells(own, cut_at, t, band)
                    if sieve is not None:
                        may = passes(sieve.value, key)
                        key, row, x0, x1 = key[may], row[may], x0[may], x1[may]
                    out = {"key": pa.array(key), "doc_id": b.column(0).take(pa.array(lo + row))}
                    if not brief:
                        out |= {"n": pa.array(np.diff(begin)[row].astype(np.int32)), "x": pa.array((x0 + shift) << 32 | (x1 + shift))}
                    yield pa.record_batch(out)
                lo += s.hi - s.lo

    return docs.mapInArrow(each, f"key long NOT NULL, doc_id {docs.schema['doc_id'].dataType.simpleString()} NOT NULL" + ", n int NOT NULL, x long NOT NULL" * (not brief))


def token_index(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of a text's tokens by rising token, the tokens in that order, and at the first of equal ones their number."""
    order = np.argsort(b, kind="stable")
    values = b[order]
    head = np.flatnonzero(np.concatenate([np.ones(min(1, len(b)), bool), values[1:] != values[:-1]]))
    times = np.zeros(len(b), np.int64)
    times[head] = np.diff(np.append(head, len(b)))
    return order, values, times


def least_common(t: int, similarity: float = SIMILARITY) -> int:
    """Equal tokens that two sets of t tokens have at that similarity."""
    return int(np.ceil(2 * t * similarity / (1 + similarity)))


def _different(place: np.ndarray, t: int) -> np.ndarray:
    """Of each t consecutive places, the number of different ones, without those below zero."""
    at = np.flatnonzero(place >= 0)
    order = at[np.argsort(place[at], kind="stable")]
    before = np.full(len(place), -1)
    same = place[order[1:]] == place[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    n = len(place) - t + 1
    first, last = np.maximum(np.maximum(before[at] + 1, at - t + 1), 0), np.minimum(at, n - 1)  # the windows that hold it, but not the same before it
    full = first <= last
    return np.cumsum(np.bincount(first[full], minlength=n + 1) - np.bincount(last[full] + 1, minlength=n + 1))[:n]


def shared_passages(a: np.ndarray, b: np.ndarray, t: int, similarity: float = SIMILARITY, index: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int, int, int]]:
    """Passages (first and last token in a, in b) of at least t tokens at that similarity or more.

    ``index`` is ``token_index(b)``, for callers that compare many texts with one.
    """
    if len(a) < t or len(b) < t:
        return []
    if np.array_equal(a, b):  # every token's partner is itself
        return [(0, len(a) - 1, 0, len(a) - 1)]
    order, values, times = token_index(b) if index is None else index
    at = np.minimum(np.searchsorted(values, a), len(b) - 1)
    there = values[at] == a
    place = np.where(there, order[at], -1)
    again = np.flatnonzero(there & (times[at] > 1))
    if len(again):  # the k-th occurrence in a goes with the k-th in b
        own = np.argsort(a[again], kind="stable")
        turn = np.empty(len(again), np.int64)
        turn[own] = np.arange(len(again)) - np.searchsorted(a[again][own], a[again][own])
        place[again] = order[at[again] + np.minimum(turn, times[at[again]] - 1)]
    least = least_common(t, similarity)
    got = np.concatenate([[0], np.cumsum(there)])
    if got[-1] < least:
        return []
    good = np.flatnonzero(got[t:] - got[:-t] >= least)
    strong = np.flatnonzero(_different(place, t)[good] >= least)  # of the good windows; others cannot begin a passage
    if not len(strong):
        return []
    ends = np.append(np.flatnonzero(np.diff(good) != 1), len(good) - 1)
    run = ends[np.searchsorted(ends, np.arange(len(good)))]  # the last of the good windows that follow each other
    out = []
    k = 0
    while k <= strong[-1]:
        k = int(strong[np.searchsorted(strong, k)])
        x = int(good[k])
        p = place[x : x + t]
        p = p[p >= 0]
        mid = int(np.sort(p)[len(p) // 2])
        p = p[np.abs(p - mid) <= t]
        lo, hi = int(p.min()), int(p.max())
        both = len(np.unique(p))
        if both / (t + max(t, hi - lo + 1) - both) < similarity:
            k += 1
            continue
        j, last, step = k, int(run[k]), 64  # go on while the windows follow each other in both texts
        while j < last:
            new = place[good[j + 1 : min(j + step, last) + 1] + t - 1]
            most = np.maximum.accumulate(np.concatenate([[hi], new]))
            far = np.flatnonzero((new >= 0) & ((new < lo) | (new > most[:-1] + t // 4)))
            more = int(far[0]) if len(far) else len(new)
            hi = int(most[more])
            j += more
            if len(far):
                break
            step *= 2
        out.append((x, int(good[j]) + t - 1, lo, hi))
        k = int(np.searchsorted(good, good[j] + t // 2, side="right")) if j > k else k + 1
        k = max(k, j + 1)
    return out


def _compared(pairs: DataFrame, docs: DataFrame, t: int) -> DataFrame:
    """A row per verified passage of a pair (u, v), with its extent: in words, a0..a1 of u and b0..b1 of v."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                sides = []
                for c in (2, 3):  # each text once: rows come in the order of v, so one v stands in many
                    own, texts = [], pc.fill_null(part.column(c), "").dictionary_encode()
                    for s in slices(texts.dictionary):
                        h, begin = tokens(s.data, s.bounds)
                        own += np.split(h, begin[1:-1])
                    sides.append((own, texts.indices.to_numpy()))
                (ours, who), (theirs, whom) = sides
                indexes = [token_index(b) for b in theirs]
                for i, (k, m) in enumerate(zip(who, whom, strict=True)):
                    rows += [(lo + i, a0, a1 + SHINGLE - 1, b0, b1 + SHINGLE - 1) for a0, a1, b0, b1 in shared_passages(ours[k], theirs[m], t, index=indexes[m])]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), *[pa.array([r[k] for r in rows], pa.int32()) for k in range(1, 5)]], names=["u", "v", "a0", "a1", "b0", "b1"])

    one = sieved(docs, F.col("doc_id"), pairs, F.col("u")).select(F.col("doc_id").alias("u"), F.col("text").alias("tu"))
    two = sieved(docs, F.col("doc_id"), pairs, F.col("v")).select(F.col("doc_id").alias("v"), F.col("text").alias("tv"))
    both = pairs.join(one.hint("merge"), "u").join(two.hint("merge"), "v").select("u", "v", "tu", "tv")
    return both.mapInArrow(each, f"u {kind}, v {kind}, a0 int, a1 int, b0 int, b1 int")


def _whole_windows(rest: DataFrame, docs: DataFrame, t: int) -> DataFrame:
    """(h, doc_id, x): hashes of all windows of t tokens of cells (doc_id, x0, x1)."""
    asked = rest.groupBy("doc_id").agg(F.collect_set(F.struct("x0", "x1")).alias("asked"))
    asked = cut(asked)
    own = sieved(docs, F.col("doc_id"), asked, F.col("doc_id")).join(asked.hint("merge"), "doc_id").select("doc_id", "text", "asked")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo = 0
            for s in slices(b.column(1)):
                h, begin = tokens(s.data, s.bounds)
                up, down = _Powers.upto(len(h))
                acc = np.concatenate([[np.uint64(0)], np.cumsum(h * up[: len(h)], dtype=np.uint64)])
                cells_of = b.column(2).slice(lo, s.hi - s.lo)
                at, flat = np.repeat(np.arange(s.hi - s.lo), pc.list_value_length(cells_of).to_numpy()), cells_of.flatten()
                opens = np.minimum(begin[at] + flat.field("x0").to_numpy(), begin[at + 1])
                shuts = np.maximum(opens, np.minimum(begin[at] + flat.field("x1").to_numpy() + 1, begin[at + 1] - t + 1))
                x = np.flatnonzero(np.cumsum(np.bincount(opens, minlength=len(h) + 1) - np.bincount(shuts, minlength=len(h) + 1)))
                whole = mix((acc[x + t] - acc[x]) * down[x])
                row = np.searchsorted(begin, x, side="right") - 1
                yield pa.record_batch({"h": pa.array(whole.view(np.int64)), "doc_id": b.column(0).take(pa.array(lo + row)), "x": pa.array((x - begin[row]).astype(np.int32))})
                lo += s.hi - s.lo

    return own.mapInArrow(each, f"h long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, x int")


def _written(rows: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """``rows`` as a table in the shared checkpoint folder, and what deletes it.

    For the largest intermediate tables: as columns they take a third of a checkpoint's bytes.
    """
    spark = rows.sparkSession
    path = f"{shared_checkpoint_dir(spark)}/passages-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.schema(rows.schema).parquet(path), lambda: there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def _met(docs: DataFrame, t: int) -> DataFrame:
    """(key, u, v, x, y), cut: cells x of u whose signature's representative is v's cell y."""
    keys = cut(_windows(docs, t, *BANDS, brief=True).groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least <> last").select("key"))
    release(docs.sparkSession)
    sieve = sieve_of(keys.select(F.col("key").alias("h")))
    links = None
    for bands in ((band,) for band in BANDS) if sieve is None else (BANDS,):
        shared = cut(_windows(docs, t, *bands, sieve=sieve).join(keys.hint("merge"), "key"))  # most signatures are one document's
        groups = shared.groupBy("key").agg(F.min(F.struct("n", "doc_id", "x")).alias("rep")).select("key", F.col("rep.doc_id").alias("v"), F.col("rep.x").alias("y"))
        groups = cut(groups)  # so the join can be split at a hot signature
        more = cut(shared.join(groups.hint("merge"), "key").where("doc_id <> v").select("key", F.col("doc_id").alias("u"), "v", "x", "y"))
        links = more if links is None else links.unionByName(more)
        del shared, groups
        release(docs.sparkSession)
    return links


def _tokens_of(own: DataFrame, t: int, brief: bool = False, sieve: Broadcast | None = None) -> DataFrame:
    """(h, key, doc_id, x, at): the tokens in and closely around cells (key, x) asked of texts, by place from the first, hashed with the key.

    (h, doc_id) if brief, less often if a token is repeated. With a sieve of hashes most other tokens stay away.
    """
    around = t // 4  # the other side of a passage is longer by a quarter at most

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo = 0
            for s in slices(b.column(1)):
                h, begin = tokens(s.data, s.bounds)
                cells_of = b.column(2).slice(lo, s.hi - s.lo)
                row, flat = np.repeat(np.arange(s.hi - s.lo), pc.list_value_length(cells_of).to_numpy()), cells_of.flatten()
                key, x = flat.field("key").to_numpy(), flat.field("x").to_numpy()
                first = np.maximum(begin[row], begin[row] + (x >> 32) - around)
                size = np.minimum(begin[row + 1], begin[row] + (x & 0xFFFFFFFF) + t + around) - first
                ends = np.cumsum(size)
                for k in range(0, len(size), 1024):
                    n = size[k : k + 1024]
                    cell = np.repeat(np.arange(k, k + len(n)), n)
                    at = np.arange(len(cell)) - np.repeat(ends[k : k + 1024] - n - (ends[k - 1] if k else 0), n)
                    mixed = mix(h[first[cell] + at] + mix(key[cell].view(np.uint64))).view(np.int64)
                    if brief:
                        some = np.flatnonzero(np.concatenate([np.ones(min(1, len(mixed)), bool), (mixed[1:] != mixed[:-1]) | (row[cell[1:]] != row[cell[:-1]])]))
                    else:
                        some = np.arange(len(mixed)) if sieve is None else np.flatnonzero(passes(sieve.value, mixed))
                    cell, at = cell[some], at[some]
                    out = {"h": pa.array(mixed[some]), "doc_id": b.column(0).take(pa.array(lo + row[cell]))}
                    yield pa.record_batch(out if brief else {"h": out["h"], "key": pa.array(key[cell]), "doc_id": out["doc_id"], "x": pa.array(x[cell]), "at": pa.array(at.astype(np.int32))})
                lo += s.hi - s.lo

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(each, f"h long, doc_id {kind}" if brief else f"h long, key long, doc_id {kind}, x long, at int")


def _met_elsewhere(members: DataFrame, docs: DataFrame, t: int) -> DataFrame:
    """(key, doc_id): of cells (key, doc_id, x), those with a window of which other documents of the key hold tokens enough for a passage."""
    asked = cut(members.groupBy("doc_id").agg(F.collect_list(F.struct("key", "x")).alias("asked")))
    own = cut(sieved(docs, F.col("doc_id"), asked, F.col("doc_id")).join(asked.hint("merge"), "doc_id").select("doc_id", "text", "asked"))
    common = cut(_tokens_of(own, t, brief=True).groupBy("h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least <> last").select("h"))
    places = _tokens_of(own, t, sieve=sieve_of(common)).join(common.hint("merge"), "h").groupBy("key", "doc_id", "x").agg(F.collect_list("at").alias("at"))
    least = least_common(t)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for at in b.column(2):
                got = np.cumsum(np.bincount(at.values.to_numpy() + 1))
                good.append(bool((got[t:] - got[:-t]).max() >= least) if len(got) > t else int(got[-1]) >= least)
            yield pa.record_batch([c.filter(pa.array(good, pa.bool_())) for c in b.columns[:2]], names=["key", "doc_id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return cut(places.select("key", "doc_id", "at").mapInArrow(each, f"key long, doc_id {kind}").distinct())


def common_tokens(texts: pa.Array, t: int) -> np.ndarray:
    """Of all pairs of texts, the number of tokens in common, each as often as both hold it, but t times at most."""
    own, sizes = [], []
    for s in slices(texts):
        h, begin = tokens(s.data, s.bounds)
        own.append(h)
        sizes.append(np.diff(begin))
    h, row = np.concatenate(own), np.repeat(np.arange(len(texts)), np.concatenate(sizes))
    out = np.zeros((len(texts), len(texts)), np.float32)
    parts = 1 + (len(h) >> 21)  # the tokens are taken in so many shares
    for k in range(parts):
        mine = slice(None) if parts == 1 else np.flatnonzero(h % np.uint64(parts) == k)
        order = np.argsort(h[mine], kind="stable")  # so a token's rows rise
        v, r = h[mine][order], row[mine][order]
        new = np.concatenate([np.ones(min(1, len(v)), bool), v[1:] != v[:-1]])
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(v)) - 1
        token = np.cumsum(new) - 1
        own_head = np.flatnonzero(new | np.concatenate([np.ones(min(1, len(v)), bool), r[1:] != r[:-1]]))
        turn = np.arange(len(v)) - np.repeat(own_head, np.diff(np.append(own_head, len(v))))
        kept = np.flatnonzero((r[head] != r[last])[token] & (turn < t))
        at, r = token[kept] * t + turn[kept], r[kept]
        column = np.unique(at, return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        column, r = column[order], r[order]
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, [lo, lo + 4096])
            held = np.zeros((len(texts), 4096), np.float32)
            held[r[a:b], column[a:b] - lo] = 1
            out += held @ held.T
    return out


def _alike(members: DataFrame, docs: DataFrame, t: int) -> DataFrame:
    """(u, v), u > v: the pairs of a key's documents (key, doc_id, c, size) of different c whose texts have tokens enough in common for a passage."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    least = least_common(t)

    def each(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, own = group.column("doc_id").combine_chunks(), group.column("own").to_numpy()
        c = group.column("c").combine_chunks().dictionary_encode().indices.to_numpy()
        apart = c[:, None] != c if own.min() == own.max() else (c[:, None] != c) & (own[:, None] != own)
        i, j = np.nonzero(np.triu(apart) & (common_tokens(group.column("text").combine_chunks(), t) >= least))
        return pa.table({"u": ids.take(pa.array(i)), "v": ids.take(pa.array(j))})

    blocks = members.groupBy("key").agg(F.min("c").alias("least"), F.max("c").alias("last"), F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_BYTES, F.lit(1))).cast("int").alias("blocks")).where("least <> last").select("key", "blocks")
    blocks = cut(blocks)
    dealt = members.join(blocks.hint("merge"), "key").withColumn("own", F.expr("cast(pmod(xxhash64(doc_id), blocks) AS int)")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = cut(dealt.select("key", "doc_id", "c", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")))
    asked = cut(dealt.select("doc_id").distinct())
    text = cut(sieved(docs, F.col("doc_id"), asked, F.col("doc_id")).join(asked.hint("merge"), "doc_id", "left_semi").select("doc_id", "text"))
    held = dealt.join(text.hint("merge"), "doc_id").select("key", "a", "b", "doc_id", "c", "own", "text")
    pairs = held.groupBy("key", "a", "b").applyInArrow(each, f"u {kind}, v {kind}")
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _across(links: DataFrame, pairs: DataFrame, passages: DataFrame, docs: DataFrame, t: int) -> DataFrame:
    """(u, v), cut: the pairs of different texts with a common signature that neither met nor are of one class by ``passages``."""
    comp = cut(connected_components(passages.select("u", "v").distinct()))
    side = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")).hint("merge")
    lone = cut(pairs.join(side("u"), "u", "left").join(side("v"), "v", "left").where("coalesce(cu, u) <> coalesce(cv, v)").select("u", "v"))
    keys = cut(links.join(lone.hint("merge"), ["u", "v"], "left_semi").select("key").distinct())
    own = cut(sieved(links, F.col("key"), keys, F.col("key")).join(keys.hint("merge"), "key", "left_semi"))
    members = cut(own.select("key", F.col("u").alias("doc_id"), "x").unionByName(own.select("key", F.col("v").alias("doc_id"), F.col("y").alias("x"))).distinct())
    asked = cut(members.select("doc_id").distinct())
    text = cut(sieved(docs, F.col("doc_id"), asked, F.col("doc_id")).join(asked.hint("merge"), "doc_id", "left_semi").select("doc_id", F.sha2("text", 256).alias("text"), F.octet_length("text").alias("size")))
    first = cut(text.groupBy("text").agg(F.min("doc_id").alias("first"), F.max("size").alias("size")))  # copies go by one of them
    copies = text.join(first.hint("merge"), "text").groupBy("doc_id").agg(F.min("first").alias("first"))
    members = cut(members.join(copies.hint("merge"), "doc_id").select("key", F.col("first").alias("doc_id"), "x").distinct())
    good = _met_elsewhere(members, docs, t)
    known = comp.select(F.col("node").alias("doc_id"), "component")
    sizes = first.groupBy(F.col("first").alias("doc_id")).agg(F.max("size").alias("size"))
    good = cut(good.join(known.hint("merge"), "doc_id", "left").join(sizes.hint("merge"), "doc_id").select("key", "doc_id", F.coalesce("component", "doc_id").alias("c"), "size"))
    across = _alike(good, docs, t)
    known = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return cut(across.join(known.hint("merge"), ["u", "v"], "left_anti"))


def _uncovered(links: DataFrame, passages: DataFrame, words: int) -> DataFrame:
    """The links (u, v, x, y) whose cells no passage of (u, v) holds on both sides."""
    held = passages.groupBy("u", "v").agg(F.collect_list(F.struct("a0", "a1", "b0", "b1")).alias("held"))
    covers = lambda p: (F.shiftright("x", 32) >= p["a0"]) & (F.col("x").bitwiseAND(0xFFFFFFFF) + words <= p["a1"]) & (F.shiftright("y", 32) >= p["b0"]) & (F.col("y").bitwiseAND(0xFFFFFFFF) + words <= p["b1"])
    return links.join(held.hint("merge"), ["u", "v"], "left").where(F.col("held").isNull() | ~F.exists("held", covers)).select("u", "v", "x", "y")


def passage_links(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(u, v, a0, a1, b0, b1): verified links; docs: (doc_id, text)."""
    t = min_words - SHINGLE + 1
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    words = t + SHINGLE - 2
    links = _met(docs, t)
    pairs = cut(links.select("u", "v").distinct())
    release(docs.sparkSession)
    passages = cut(_compared(pairs, docs, t))
    release(docs.sparkSession)
    passages = passages.unionByName(cut(_compared(_across(links, pairs, passages, docs, t), docs, t)))
    del pairs
    release(docs.sparkSession)
    rest = cut(_uncovered(links, passages, words))
    release(docs.sparkSession)
    own = rest.select(F.col("u").alias("doc_id"), "x").unionByName(rest.select(F.col("v").alias("doc_id"), F.col("y").alias("x"))).distinct()
    own = own.select("doc_id", F.shiftright("x", 32).cast("int").alias("x0"), F.col("x").bitwiseAND(0xFFFFFFFF).cast("int").alias("x1"))
    whole, delete = _written(_whole_windows(own, docs, t))
    release(docs.sparkSession)
    first = whole.groupBy("h").agg(F.min(F.struct("doc_id", "x")).alias("first"), F.max("doc_id").alias("last")).where("first.doc_id <> last").select("h", "first")
    first = cut(first)  # so the join can be split where very many texts share a window
    release(docs.sparkSession)
    exact = whole.join(first.hint("merge"), "h").where("doc_id <> first.doc_id")
    exact = cut(exact.groupBy(F.col("doc_id").alias("u"), F.col("first.doc_id").alias("v")).agg(F.min("x").alias("a0"), (F.max("x") + words).alias("a1"), F.min("first.x").alias("b0"), (F.max("first.x") + words).alias("b1")))
    delete()
    found = passages.groupBy("u", "v").agg(F.min("a0").alias("a0"), F.max("a1").alias("a1"), F.min("b0").alias("b0"), F.max("b1").alias("b1"))
    return found.unionByName(exact)


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, class_id, n_links, first_word, last_word), a row per document that shares a passage with another.

    class_id is the smallest doc_id reachable; the words are the extent of all it shares.
    """
    links = cut(passage_links(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), min_words))
    ends = links.select(F.col("u").alias("doc_id"), F.col("a0").alias("x"), F.col("a1").alias("y")).unionByName(links.select(F.col("v").alias("doc_id"), F.col("b0").alias("x"), F.col("b1").alias("y")))
    per = ends.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_links"), F.min("x").alias("first_word"), F.max("y").alias("last_word"))
    comp = connected_components(links)
    return per.join(comp.hint("merge"), F.col("doc_id") == F.col("node")).select("doc_id", F.col("component").alias("class_id"), "n_links", "first_word", "last_word")


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Classes of all documents that share a passage of 50 words or more."""
    from quorumtext.runtime import ship_package, table

    ship_package(spark)
    return repeated_passages(table(spark, sf_dir, "documents"))
