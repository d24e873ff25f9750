"""Nearest neighbours by inner product from an inverted multi-index.

1. Equal vectors become one node with its ``k + 1`` smallest vec_ids, all that any result can
   need of it, so a vector that a third of all rows hold is one row from here on. Queries
   with equal vectors are likewise searched for once.
2. A bounded sample of nodes (``max_train``) fits one codebook a vector half; a node's cell is
   its pair of nearest centroids. Every node is indexed.
3. The distance of a query from a centroid is its half's inner product, negated. A heap walks
   the pairs of centroids by rising summed distance until the cells behind them hold ``visits``
   nodes. What it leaves is the sum it stopped at: the visited cells are those up to that.
4. ``visits`` is measured, not chosen: for ``probes`` sampled queries all nodes are searched, and
   the number is such that ``recall`` of their true neighbours lie in visited cells. So the
   recall holds at any size and any kind of vectors; what changes is the share visited. (Of
   vectors without any structure in 64 dimensions that is near a half.)
5. Nodes are dealt to blocks of bounded size by the first half's centroid, large centroids by
   hash into several, and queries go to the blocks that hold a visited cell, in chunks of
   bounded size. A task reranks the entries of visited cells by the true measure and keeps
   k + 1 a query; these meet by query.

Broadcast or on the driver: the codebooks and the cells' sizes (at most ``MAX_CENTROIDS`` ** 2
numbers), the sample, the probes.

Edge cases: vectors that are null, empty, zero, or hold a null, NaN or infinite component take
no part, as queries or candidates, nor do rows without a vec_id; nor those of another length
than most vectors (the shorter one where two are as frequent). Rows of one vec_id are one
vector, the smallest as an array. Fewer candidates than ``k`` are all returned. Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.runtime import cut

NEAREST, EVERY = 20, 20
MAX_TRAIN = 20_000
MAX_CENTROIDS = 1024
PROBES = 256
RECALL = 0.96
CELL = 12  # nodes a cell that the number of centroids aims at
MAX_BLOCK, MAX_CHUNK = 16_384, 8_192
_SPACE = 1 << 40


def usable(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, e): the vectors that take part."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = embeddings.where(F.col(vec_id).isNotNull() & e.isNotNull()).where(finite & F.exists(e, lambda x: x != 0))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), e.alias("e"))
    sizes = rows.groupBy(F.size("e").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    most = sizes.orderBy(F.desc("rows"), "n").limit(1).collect()
    return rows.where(F.size("e") == (most[0].n if most else 0)).groupBy("vec_id").agg(F.min("e").alias("e"))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """(node, e, ids): the different vectors, named by their smallest vec_id, with their ``ids`` smallest."""
    w = Window.partitionBy("e").orderBy("vec_id")
    few = rows.withColumn("k", F.row_number().over(w)).where(F.col("k") <= ids)  # limited in each task, before the shuffle
    return few.groupBy("e").agg(F.min("vec_id").alias("node"), F.array_sort(F.collect_list("vec_id")).alias("ids")).select("node", "e", "ids")


def matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def nearest_centroids(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), np.int64)
    for a in range(0, len(rows), 4096):
        out[a : a + 4096] = np.argmin((centroids * centroids).sum(1) - 2 * rows[a : a + 4096] @ centroids.T, axis=1)
    return out


def codebook(sample: np.ndarray, size: int, steps: int = 15) -> np.ndarray:
    """Centroids of the sample's rows by k-means, at most ``size``."""
    if not sample.shape[1]:
        return np.zeros((1, 0))
    different = np.unique(sample, axis=0)
    c = different[np.linspace(0, len(different) - 1, min(size, len(different))).astype(int)]
    for _ in range(steps):
        own = nearest_centroids(sample, c)
        n = np.bincount(own, minlength=len(c))
        sums = np.stack([np.bincount(own, weights=x, minlength=len(c)) for x in sample.T], 1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


@dataclass
class Index:
    """Codebooks of the halves and the number of nodes in each cell (first centroid, second centroid)."""

    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.first.shape[1]
        return nearest_centroids(rows[:, :h], self.first), nearest_centroids(rows[:, h:], self.second)

    def distances(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of rows to all centroids of each half; each number by itself, so it never depends on the other rows."""
        h = self.first.shape[1]
        return -np.einsum("qd,cd->qc", rows[:, :h], self.first), -np.einsum("qd,cd->qc", rows[:, h:], self.second)

    def stop(self, d1: np.ndarray, d2: np.ndarray, visits: int) -> float:
        """The summed distance at which cells in rising order hold ``visits`` nodes."""
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        a, b, sizes = d1[o1].tolist(), d2[o2].tolist(), self.sizes[np.ix_(o1, o2)].tolist()
        heap, held, last = [(a[0] + b[0], 0, 0)], 0, float("inf")
        while heap:
            total, i, j = heap[0]
            held += sizes[i][j]
            if held >= visits:
                return total
            if j + 1 < len(b):
                heapq.heapreplace(heap, (a[i] + b[j + 1], i, j + 1))
            else:
                heapq.heappop(heap)
            if not j and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        return last


def fit(nodes: DataFrame, n: int, max_train: int = MAX_TRAIN, max_centroids: int = MAX_CENTROIDS) -> Index:
    """An index of ``nodes`` (node, e), ``n`` of them, on a sample of about ``max_train``."""
    chosen = nodes.where(F.pmod(F.xxhash64("node"), F.lit(_SPACE)) < int(_SPACE * min(1.0, max_train / n))).select("e").limit(2 * max_train)
    sample = matrix(chosen.toArrow().column("e"))
    if not len(sample):  # by chance, from a few nodes
        sample = matrix(nodes.limit(max_train).select("e").toArrow().column("e"))
    size = int(min(max_centroids, max(4, 2 ** round(np.log2(max(1.0, (n / CELL) ** 0.5))))))
    h = sample.shape[1] // 2
    return Index(codebook(sample[:, :h], size), codebook(sample[:, h:], size), np.zeros((1, 1), np.int64))


def placed(nodes: DataFrame, index: Index) -> DataFrame:
    """``nodes`` (node, e, ids) with their cells' centroids i, j."""
    sent = nodes.sparkSession.sparkContext.broadcast(index)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                i, j = sent.value.cells(matrix(b.column(1)))
                yield pa.record_batch([*b.columns, pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))], names=["node", "e", "ids", "i", "j"])

    return nodes.mapInArrow(each, f"node long, e {nodes.schema['e'].dataType.simpleString()}, ids array<long>, i int, j int")


def with_sizes(index: Index, nodes: DataFrame) -> Index:
    got = nodes.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n")).toPandas()
    sizes = np.zeros((len(index.first), len(index.second)), np.int64)
    sizes[got.i, got.j] = got.n
    return Index(index.first, index.second, sizes)


def visits_for(index: Index, nodes: DataFrame, queries: DataFrame, n_queries: int, k: int, probes: int = PROBES, recall: float = RECALL) -> int:
    """Nodes to visit so that this share of sampled queries' true neighbours is among them; queries: (node, e)."""
    share = min(1.0, probes / n_queries)
    chosen = queries.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(_SPACE)) < int(_SPACE * share)).limit(2 * probes).toArrow()
    if not chosen.num_rows:
        chosen = queries.limit(probes).toArrow()
    names, rows = chosen.column("node").to_numpy(), matrix(chosen.column("e"))
    sent = nodes.sparkSession.sparkContext.broadcast((names, rows))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, rows = sent.value
        kept = [np.zeros((len(names), 0))] * 3
        for b in batches:
            node = b.column(0).to_numpy()
            for a in range(0, b.num_rows, 4096):
                part = b.slice(a, 4096)
                s = rows @ matrix(part.column(1)).T
                s[names[:, None] == node[None, a : a + 4096]] = -np.inf
                places = [np.broadcast_to(part.column(c).to_numpy(), s.shape) for c in (2, 3)]
                s, *places = [np.concatenate([x, y], 1) for x, y in zip(kept, (s, *places), strict=True)]
                top = np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k]
                kept = [np.take_along_axis(x, top, 1) for x in (s, *places)]
        s, i, j = kept
        q = np.repeat(np.arange(len(names)), s.shape[1])
        ok = np.isfinite(s.ravel())
        yield pa.record_batch({"q": pa.array(q[ok].astype(np.int32)), "s": pa.array(s.ravel()[ok]), "i": pa.array(i.ravel()[ok].astype(np.int32)), "j": pa.array(j.ravel()[ok].astype(np.int32))})

    found = nodes.select("node", "e", "i", "j").mapInArrow(best, "q int, s double, i int, j int")
    w = Window.partitionBy("q").orderBy(F.desc("s"), "i", "j")
    true = found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("q", "i", "j").toPandas()
    if not len(true):
        return k + 1
    d1, d2 = index.distances(rows)
    need = []
    for q, own in true.groupby("q"):
        total = (d1[q][:, None] + d2[q][None]).ravel()
        order = np.argsort(total, kind="stable")
        held = np.cumsum(index.sizes.ravel()[order])
        at = np.searchsorted(total[order], total[own.i.to_numpy() * d2.shape[1] + own.j.to_numpy()], side="left")
        need.append(held[at])
    return max(k + 1, int(np.quantile(np.concatenate(need), recall, method="higher")))


def blocks_of(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each first centroid its block, and into how many that block is split; centroids in order share a block up to ``most`` nodes."""
    per = sizes.sum(1)
    block, held, number = np.zeros(len(per), np.int64), 0, 0
    for i, n in enumerate(per):
        if held and held + n > most:
            number, held = number + 1, 0
        block[i] = number
        held += n
    total = np.bincount(block, weights=per, minlength=number + 1)
    return block, np.maximum(1, np.ceil(total / most)).astype(np.int64)


def searched(index: Index, nodes: DataFrame, queries: DataFrame, n: int, n_queries: int, k: int, visits: int) -> DataFrame:
    """(q, score, vec_id): of each query (node, e), at least its k + 1 nearest of the visited cells, in each block."""
    sc = nodes.sparkSession.sparkContext
    block, splits = blocks_of(index.sizes, int(np.clip(n // 16, 1024, MAX_BLOCK)))
    before = np.concatenate([[0], np.cumsum(splits)])
    chunks = -(-n_queries // MAX_CHUNK)
    sent = sc.broadcast((index, block, splits, before))
    kind = nodes.schema["e"].dataType.simpleString()

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, block, splits, before = sent.value
        for b in batches:
            if b.num_rows:
                own = block[b.column(3).to_numpy()]
                salt = (b.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                yield pa.record_batch([pa.array(before[own] + salt % splits[own]), *b.columns], names=["block", "node", "e", "ids", "i", "j"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, block, splits, before = sent.value
        for b in batches:
            rows, out_row, out_block, out_stop = matrix(b.column(1)), [], [], []
            for a in range(0, len(rows), 256):
                d1, d2 = index.distances(rows[a : a + 256])
                for r, (x, y) in enumerate(zip(d1, d2, strict=True)):
                    stop = index.stop(x, y, visits)
                    for own in np.unique(block[x + y.min() <= stop]):
                        for number in range(before[own], before[own + 1]):
                            out_row.append(a + r)
                            out_block.append(number)
                            out_stop.append(stop)
            at = pa.array(out_row, pa.int64())
            yield pa.record_batch([pa.array(out_block, pa.int64()), b.column(0).take(at), b.column(1).take(at), pa.array(out_stop, pa.float64())], names=["block", "q", "e", "stop"])

    def rerank(own: pa.Table, queries: pa.Table) -> pa.Table:
        index = sent.value[0]
        names, scores, found = [], [], []
        if own.num_rows and queries.num_rows:
            x, i, j = matrix(own.column("e")), own.column("i").to_numpy(), own.column("j").to_numpy()
            cell = i.astype(np.int64) * len(index.second) + j
            order = np.argsort(cell, kind="stable")
            x, i, j = x[order], i[order], j[order]
            edges = np.append(np.flatnonzero(np.diff(cell[order], prepend=-1)), len(order))
            y, stop = matrix(queries.column("e")), queries.column("stop").to_numpy()
            for a in range(0, len(y), 256):
                part = y[a : a + 256]
                d1, d2 = index.distances(part)
                s = np.full((len(part), len(x)), -np.inf)
                for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                    rows = np.flatnonzero(d1[:, i[lo]] + d2[:, j[lo]] <= stop[a : a + 256])
                    if len(rows):
                        s[rows, lo:hi] = part[rows] @ x[lo:hi].T
                top = np.argpartition(-s, min(k + 1, s.shape[1]) - 1, axis=1)[:, : k + 1]
                q, c = np.repeat(np.arange(len(part)), top.shape[1]), top.ravel()
                ok = np.isfinite(s[q, c])
                q, c = q[ok], c[ok]
                names.append(a + q)
                scores.append((part[q] * x[c]).sum(1))  # in one order, whatever the block
                found.append(order[c])
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        names, found = join(names, np.int64), join(found, np.int64)
        return pa.table({"q": queries.column("q").take(pa.array(names)), "score": pa.array(join(scores, np.float64)), "ids": own.column("ids").take(pa.array(found))})

    n_blocks = int(before[-1]) * chunks
    parts = max(1, min(n_blocks, 2000))
    left = nodes.mapInArrow(entries, f"block long, node long, e {kind}, ids array<long>, i int, j int").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = queries.repartition(max(1, min(parts, -(-n_queries // 64)))).mapInArrow(asked, f"block long, q long, e {kind}, stop double")
    right = right.withColumn("chunk", F.pmod(F.xxhash64("q"), F.lit(chunks)).cast("int"))
    left, right = (x.withColumn("part", F.col("block") * chunks + F.col("chunk")).repartition(parts, "part") for x in (left, right))
    got = left.select("part", "e", "ids", "i", "j").groupBy("part").cogroup(right.select("part", "q", "e", "stop").groupBy("part")).applyInArrow(rerank, "q long, score double, ids array<long>")
    return got.select("q", "score", F.explode("ids").alias("vec_id"))


def nearest(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = NEAREST, every: int = EVERY, max_train: int = MAX_TRAIN, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose vec_id is divisible by ``every``."""
    rows = cut(usable(embeddings, vec_id, embedding))
    nodes = cut(distinct_vectors(rows, k + 1))
    asking = cut(rows.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id").join(nodes.select("node", "e").hint("merge"), "e").select("query_id", F.col("node").alias("q")))
    queries = cut(asking.select(F.col("q").alias("node")).distinct().join(nodes.select("node", "e").hint("merge"), "node"))
    n, n_queries = nodes.count(), queries.count()
    if not n_queries:
        return asking.select("query_id", F.lit(1).alias("rank"), F.col("q").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    index = fit(nodes, n, max_train)
    nodes = cut(placed(nodes, index))
    index = with_sizes(index, nodes)
    visits = visits_for(index, nodes, queries, n_queries, k, recall=recall)
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    best = searched(index, nodes, queries, n, n_queries, k, visits).distinct().withColumn("place", F.row_number().over(w)).where(F.col("place") <= k + 1)
    lists = cut(best.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found")))
    out = asking.join(lists.hint("merge"), "q").select("query_id", F.posexplode(F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", "x.score")


def op11_nearest(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of each vector whose id is divisible by 20, among all others."""
    from quorumtext.runtime import ship_package, table

    ship_package(spark)
    return nearest(table(spark, sf_dir, "embeddings"))
