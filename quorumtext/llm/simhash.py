"""SimHash near-duplicates: BK-trees over shards of fingerprints.

1. Each text gets a 64-bit fingerprint (majority of its word shingles' XXH64 bits).
2. Equal fingerprints become one node, named by its smallest doc_id, so a group of exact
   copies costs one row from here on.
3. Two fingerprints within ``radius`` bits agree on at least ``parts - radius`` of
   ``parts`` bit blocks. Each choice of that many blocks is a *shard key*; a node goes to
   one shard per choice, and keys that only one node has are dropped (they link nothing).
4. In each shard a BK-tree is built, children keyed by integer Hamming distance to their
   parent; every member walks the tree along the edges in [d - radius, d + radius] only.
   A shard's finds leave as a spanning forest, at most one row per member, never as pairs.
5. The number of blocks follows the number of nodes so that chance alone leaves about 64 in
   a shard. One of more than ``max_shard`` nodes is split by longer keys: its other bits are
   cut into twice ``radius`` blocks, of which two near fingerprints agree on half, so keys
   have over 40 bits in all and a row is copied at most 70 times whatever the shard's size.
   Such a key leaves some 22 bits free; if still more than ``max_shard`` *different*
   fingerprints share it, they are cut into pieces (at most 2**22 / ``max_shard``), and each
   pair of pieces is a tree of its own. Nothing is dropped.
6. Components of the forests' union, by star contraction.

The trees travel to the tasks that hold their shard by the shuffle on the shard key.
A broadcast of them would grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.graph import connected_components
from quorumtext.llm.sieve import sieved
from quorumtext.llm.textbatch import LOWER, mix, shingle_hashes, slices, span_hashes, word_spans
from quorumtext.runtime import Tables, cut, release

RADIUS = 4
MAX_SHARD = 8192
IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: str | None, k: int = 4) -> int:
    """SimHash of the k-word shingles of a text; zero without words; null counts as empty."""
    words = (text or "").encode().lower().split()  # bytes: lower() is A-Z only, split() takes ASCII space
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    k = min(k, len(words))
    cut_at = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], 42) for a, b in cut_at], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 4096):
        ones += np.unpackbits(h[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(h)).tolist())


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), k) for t in b.column(1)], np.uint64)
            yield pa.record_batch({"doc_id": b.column(0), "fp": pa.array(fp.view(np.int64))})

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), text).mapInArrow(each, f"doc_id {kind}, fp long")


class Forest:
    """BK-trees of many shards at once, in flat arrays.

    ``shard`` is sorted; the first node of a shard is its root, and a later one hangs below
    the first earlier node that it meets on each level, as inserting one by one would do.
    """

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        n = len(fp)
        self.fp, self.shard = fp, shard
        self.root = np.searchsorted(shard, shard, side="left")
        parent, edge = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        rest = np.flatnonzero(self.root != np.arange(n))
        above = self.root[rest]
        while len(rest):
            d = np.bitwise_count(fp[rest] ^ fp[above]).astype(np.int64)
            key = above * 128 + d
            order = np.argsort(key, kind="stable")
            rest, key = rest[order], key[order]
            head = np.concatenate([[True], key[1:] != key[:-1]])
            at = np.flatnonzero(head)
            first = rest[at]
            parent[first], edge[first] = key[at] // 128, key[at] % 128
            above = np.repeat(first, np.diff(np.append(at, len(rest))))
            rest, above = rest[~head], above[~head]
        child = np.flatnonzero(parent >= 0)
        key = parent[child] * 128 + edge[child]
        order = np.argsort(key, kind="stable")
        self.key, self.child = key[order], child[order]

    def within(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) pairs of one shard at most ``radius`` apart, in pieces of bounded size."""
        size = np.diff(np.append(np.unique(self.root), len(self.fp)))
        load = np.cumsum(np.repeat(size, size))
        lo = 0
        while lo < len(self.fp):
            hi = max(lo + 1, int(np.searchsorted(load, (load[lo - 1] if lo else 0) + _PAIRS_AT_ONCE, side="right")))
            q = np.arange(lo, hi)
            at = self.root[q]
            while len(q):
                d = np.bitwise_count(self.fp[q] ^ self.fp[at]).astype(np.int64)
                near = (d <= radius) & (q != at)
                if near.any():
                    yield q[near], at[near]
                a = np.searchsorted(self.key, at * 128 + np.maximum(d - radius, 0), "left")
                n = np.searchsorted(self.key, at * 128 + d + radius, "right") - a
                step = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
                q, at = np.repeat(q, n), self.child[step]
            lo = hi


def shard_forest(shard: np.ndarray, node: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (node, smaller node) of the links inside shards; shard is sorted."""
    top = np.arange(len(node))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for q, at in Forest(shard, fp).within(radius):
        a, b = top[q], top[at]
        differ = a != b
        if differ.any():
            for x, y in np.unique(np.stack([a[differ], b[differ]], 1), axis=0).tolist():
                x, y = find(x), find(y)
                if x != y:
                    x, y = (x, y) if node[x] < node[y] else (y, x)
                    top[y] = x
            while (top[top] != top).any():
                top = top[top]
    moved = np.flatnonzero(top != np.arange(len(node)))
    return node[moved], node[top[moved]]


def _blocks(n: int, bits: int = (1 << 64) - 1) -> list[int]:
    """The places of ``bits`` as n masks of nearly equal size."""
    places = [i for i in range(64) if bits >> i & 1]
    cuts = [round(len(places) * k / n) for k in range(n + 1)]
    return [sum(1 << i for i in places[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(parts: int, radius: int, bits: int = (1 << 64) - 1) -> list[int]:
    """Every choice of all but ``radius`` of ``parts`` blocks of ``bits``; two words within the radius agree on one."""
    return sorted(sum(c) for c in combinations(_blocks(parts, bits), parts - radius))


def parts_for(n: int, radius: int) -> int:
    """Fewest blocks for which n spread-out fingerprints leave about 64 in a shard."""
    parts = radius + 2
    while parts < 64 and 64 * (parts - radius) // parts < (n // 64).bit_length():
        parts += 1
    return parts


def links(nodes: DataFrame, radius: int = RADIUS, parts: int | None = None, max_shard: int = MAX_SHARD, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs of nodes within ``radius`` bits.

    ``nodes``: (node long, fp long). ``parts`` and ``max_shard`` change the cost, never the result.
    """
    parts = parts or parts_for(nodes.count(), radius)
    masks = _masks(parts, radius)
    longer = {m: [m | x for x in _masks(2 * radius, radius, ~m & (1 << 64) - 1)] for m in masks}
    array = lambda xs: F.array(*[F.lit(_signed(x)).cast("long") for x in xs])
    met = _met(nodes.withColumn("mask", F.explode(array(masks))), keep)
    few = met.where(F.col("members") <= max_shard).withColumns({"a": F.lit(0), "b": F.lit(0)})
    more = F.create_map(*[y for m, xs in longer.items() for y in (F.lit(_signed(m)).cast("long"), array(xs))])
    hot = met.where(F.col("members") > max_shard).select("node", "fp", F.explode(F.element_at(more, F.col("mask"))).alias("mask"))
    hot = _met(hot.distinct(), keep)
    pieces = F.ceil(F.col("members") / F.lit(max_shard)).cast("int")
    hot = hot.withColumn("own", F.pmod(F.xxhash64("fp"), pieces).cast("int")).withColumn("to", F.explode(F.sequence(F.lit(0), pieces - 1)))
    hot = hot.withColumns({"a": F.least("own", "to"), "b": F.greatest("own", "to")})
    columns = ["mask", "value", "a", "b", "node", "fp"]
    return _searched(few.select(columns).unionByName(hot.select(columns)), radius)


def _met(rows: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows (node, fp, mask) with the key's value and its members, where there are two at least."""
    rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
    size = keep(rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))  # in files a hot shard can be split
    return rows.join(size.hint("merge"), ["mask", "value"])


def _searched(rows: DataFrame, radius: int) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []  # rows of shards that the next batch may continue

        def run(rows: np.ndarray) -> pa.RecordBatch:
            shard = np.cumsum(np.concatenate([[0], (rows[:4, 1:] != rows[:4, :-1]).any(0)]))
            a, b = shard_forest(shard, rows[4], rows[5].view(np.uint64), radius)
            return pa.record_batch({"u": pa.array(a, pa.int64()), "v": pa.array(b, pa.int64())})

        for b in batches:
            if not b.num_rows:
                continue
            new = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(6)])
            whole = np.concatenate([*kept, new], 1)
            before = np.flatnonzero((whole[:4] != whole[:4, -1:]).any(0))
            end = int(before[-1]) + 1 if len(before) else 0
            if end:
                yield run(whole[:, :end])
            kept = [whole[:, end:]]
        if kept:
            yield run(kept[0])

    key = ["mask", "value", "a", "b"]
    placed = rows.repartition(*key).sortWithinPartitions(*key, "node")
    return placed.mapInArrow(search, "u long, v long")


def near_duplicates(prints: DataFrame, radius: int = RADIUS, parts: int | None = None, max_shard: int = MAX_SHARD) -> DataFrame:
    """(doc_id, fp, component_id) of fingerprints (doc_id, fp); component_id is the smallest doc_id reachable.

    A null doc_id cannot name a component: such rows are linked like others and keep the
    component of their fingerprint's other rows, or null where there is none. Rows repeated
    with the same doc_id are returned as often as they came; an empty table gives an empty
    result.
    """
    prints = cut(prints)
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("node")))
    comp = connected_components(links(nodes.where("node IS NOT NULL"), radius, parts, max_shard))
    named = nodes.join(comp, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


#: Near copies of five-word shingle similarity. SimHash alone cannot find them: a pair at 0.8 has
#: a cosine of 0.889, so 9.7 of 64 bits differ on average and a radius of 4 holds 3 in 100 pairs.
#: So BANDS fingerprints of ROWS min-hashes each meet as well: a pair at SIMILARITY shares
#: one of them with a chance of 1 - (1 - 0.8 ** 6) ** 24 = 0.9993.
SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 6
#: Leaders of a fingerprint's group are chosen in so many orders, each for a part of the bands.
ORDERS = 3

_SALTS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)).reshape(2, BANDS, ROWS)
_PRINT_SALT = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingles of all rows of a slice, and where each row's begin (one more than rows).

    A text of fewer words is one shingle.
    """
    low = LOWER[data]
    st, en, first = word_spans(low, bounds, IS_WORD)
    words = span_hashes(low, st, en)
    h, _, row = shingle_hashes(words, first, k)
    size = np.diff(first)
    for n in range(1, k):
        short = np.flatnonzero(size == n)
        if len(short):
            whole = np.full(len(short), n, np.uint64)
            for j in range(n):
                whole = mix(whole + words[first[short] + j])
            h, row = np.concatenate([h, whole]), np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.searchsorted(row[new], np.arange(len(bounds)))


def set_prints(h: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row's set, two words that tell equal sets, its SimHash, and the BANDS fingerprints; zeros for an empty set."""
    own = np.flatnonzero(np.diff(begin))
    same, bands = np.zeros((len(begin) - 1, 2), np.uint64), np.zeros((len(begin) - 1, BANDS), np.uint64)
    fp = np.zeros(len(begin) - 1, np.uint64)
    if len(own):
        at = begin[own]
        size = np.diff(begin)[own]
        for byte in range(8):
            bits = np.unpackbits((h >> np.uint64(8 * byte)).astype(np.uint8)[:, None], axis=1, bitorder="little")
            ones = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
            fp[own] |= np.packbits(2 * ones > size[:, None], axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * byte)
        same[own, 0], same[own, 1] = np.add.reduceat(mix(h), at), np.add.reduceat(mix(h ^ _PRINT_SALT), at)
        for b in range(BANDS):
            key = np.full(len(own), b, np.uint64)
            for r in range(ROWS):
                key = mix(key + np.minimum.reduceat((h ^ _SALTS[0, b, r]) * (_SALTS[1, b, r] | np.uint64(1)), at))
            bands[own, b] = key
    return same, fp, bands


def _set_prints_of(docs: DataFrame) -> DataFrame:
    """(doc_id, s0, s1, fp, bands) of docs (doc_id, text); an empty set has no bands."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b.column(1)):
                h, begin = shingle_sets(s.data, s.bounds)
                same, fp, bands = set_prints(h, begin)
                full = np.diff(begin) > 0
                ends = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[full].reshape(-1).view(np.int64)))
                yield pa.record_batch([b.column(0).slice(s.lo, s.hi - s.lo), *[pa.array(x.copy().view(np.int64)) for x in (same[:, 0], same[:, 1], fp)], lists], names=["doc_id", "s0", "s1", "fp", "bands"])

    return docs.mapInArrow(each, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, s0 long, s1 long, fp long, bands array<long>")


def _candidates(nodes: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(u, v, shared): nodes and the leaders of the groups that hold them, with the number of such groups."""
    rows = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    rows = rows.select("key", "node", F.xxhash64("node", F.col("band") % ORDERS).alias("turn"))
    who = F.struct("turn", "node")
    groups = rows.groupBy("key").agg(F.min(who).alias("first"), F.max(who).alias("last")).where("first.node <> last.node").select("key", F.col("first.node").alias("v"))
    met = rows.select("key", "node").join(keep(groups).hint("merge"), "key").where("node <> v")  # groups in a file, so a hot fingerprint can be split
    return met.groupBy(F.col("node").alias("u"), "v").agg(F.count(F.lit(1)).alias("shared"))


def _near_prints(nodes: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(u, v): nodes within RADIUS bits of SimHash, found by the BK-trees; equal fingerprints meet in their smallest node."""
    heads = keep(nodes.groupBy("fp").agg(F.min("node").alias("node")))
    equal = nodes.join(heads.select("fp", F.col("node").alias("v")).hint("merge"), "fp").where("node <> v").select(F.col("node").alias("u"), "v")
    return keep(links(heads, keep=keep)).unionByName(equal)


def _similar(pairs: DataFrame, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (u, v) whose texts' sets of shingles have that Jaccard similarity or more."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                sides = []
                for c in (2, 3):
                    own = []
                    for s in slices(part.column(c)):
                        h, begin = shingle_sets(s.data, s.bounds)
                        own += np.split(h, begin[1:-1])
                    sides.append(own)
                both = np.array([len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(*sides, strict=True)])
                size = np.array([len(a) + len(b) for a, b in zip(*sides, strict=True)])
                yield pa.record_batch([c.filter(pa.array(both >= similarity * (size - both))) for c in part.columns[:2]], names=["u", "v"])

    one = docs.select(F.col("doc_id").alias("u"), F.col("text").alias("tu"))
    two = docs.select(F.col("doc_id").alias("v"), F.col("text").alias("tv"))
    both = pairs.select("u", "v").join(one.hint("merge"), "u").join(two.hint("merge"), "v").select("u", "v", "tu", "tv")
    return both.mapInArrow(each, f"u {kind}, v {kind}")


def _across(nodes: DataFrame, comp: DataFrame, pairs: DataFrame) -> DataFrame:
    """(u, v), cut: the nodes that share a fingerprint but are of different components, unless they are among ``pairs``.

    Only fingerprints at which a node and its leader are apart can hold such nodes; rows of others leave before any shuffle.
    """
    own = nodes.select("node", F.concat(F.coalesce("bands", F.array().cast("array<long>")), F.array(F.xxhash64("fp", F.lit(BANDS)))).alias("keys"))
    known = comp.select(F.col("node").alias("own"), "component")
    side = lambda c: known.select(F.col("own").alias(c), F.col("component").alias(f"c{c}")).hint("merge")
    apart = cut(pairs.join(side("u"), "u", "left").join(side("v"), "v", "left").where("coalesce(cu, u) <> coalesce(cv, v)").select("u", "v"))
    ends = cut(apart.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    keys = cut(sieved(own, F.col("node"), ends, F.col("node")).join(ends.hint("merge"), "node", "left_semi"))
    keys = apart.join(keys.select(F.col("node").alias("u"), F.col("keys").alias("ku")).hint("merge"), "u").join(keys.select(F.col("node").alias("v"), F.col("keys").alias("kv")).hint("merge"), "v")
    keys = cut(keys.select(F.explode(F.array_intersect("ku", "kv")).alias("key")).distinct())
    rows = sieved(own.select("node", F.explode("keys").alias("key")), F.col("key"), keys, F.col("key")).join(keys.hint("merge"), "key", "left_semi")
    rows = cut(rows.join(known.hint("merge"), F.col("node") == F.col("own"), "left").select("key", "node", F.coalesce("component", "node").alias("c")))
    one, two = (rows.select("key", F.col("node").alias(d), F.col("c").alias(f"c{d}")) for d in ("u", "v"))
    met = one.join(two.hint("merge"), "key").where("u > v AND cu <> cv").select("u", "v").distinct()
    there = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return cut(met.join(there.hint("merge"), ["u", "v"], "left_anti"))


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, component_id): groups of near copies at a five-word shingle similarity of 0.8.

    1. Texts with equal sets of shingles become one node, named by its smallest doc_id.
    2. The sets' SimHash fingerprints go through the BK-trees; what is within RADIUS bits is a
       candidate, and the one that is verified first.
    3. Nodes that share one of BANDS min-hash fingerprints meet by it. Each is a candidate with
       its group's leader, so a group costs its rows, not its pairs.
    4. Candidates are verified on the texts: the true Jaccard similarity of the two sets.
       First each node with the leader it meets most often, then all candidates that the
       links found so far do not connect. At last all pairs of a group that is still of
       several components.

    No pair below the similarity is linked, and none is missed that shares a fingerprint, which
    a pair at 0.8 does with a chance of 0.9993.

    Null and empty texts, and texts of spaces, are one group; rows without a doc_id take the
    component of equal sets with one, or null; repeated rows come back as often as they came;
    extra columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = cut(_set_prints_of(docs))
    nodes = cut(prints.groupBy("s0", "s1").agg(F.min("doc_id").alias("node"), F.first("fp").alias("fp"), F.first("bands").alias("bands")))
    release(docs.sparkSession)
    named = nodes.where("node IS NOT NULL")
    with Tables(docs.sparkSession, "near") as keep:
        near = _near_prints(named.select("node", "fp"), keep).distinct().withColumn("shared", F.lit(BANDS + 1).cast("long"))
        pairs = cut(_candidates(named, keep).unionByName(near).groupBy("u", "v").agg(F.max("shared").alias("shared")))
    release(docs.sparkSession)
    best = pairs.groupBy("u").agg(F.max(F.struct("shared", "v")).alias("best")).select("u", F.col("best.v").alias("v"))
    found = cut(_similar(best, docs))
    release(docs.sparkSession)
    comp = cut(connected_components(found))
    one = comp.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    two = comp.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    rest = pairs.join(best.hint("merge"), ["u", "v"], "left_anti").join(one.hint("merge"), "u", "left").join(two.hint("merge"), "v", "left")
    rest = cut(rest.where("coalesce(cu, u) <> coalesce(cv, v)").select("u", "v"))
    found = found.unionByName(cut(_similar(rest, docs)))
    release(docs.sparkSession)
    comp = cut(connected_components(found))
    across = cut(_similar(_across(named, comp, pairs), docs))
    release(docs.sparkSession)
    if not across.isEmpty():
        comp = connected_components(found.unionByName(across))
    named = nodes.join(comp.hint("merge"), "node", "left").select("s0", "s1", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named.hint("merge"), ["s0", "s1"]).select("doc_id", "component_id")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    """Digest of ``near_duplicates`` over all documents."""
    from quorumtext.runtime import ship_package, table

    ship_package(spark)
    out = near_duplicates(fingerprints(table(spark, sf_dir, "documents")))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
