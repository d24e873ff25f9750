"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the presence in a text of hashed byte n-grams (3 to 7 bytes, A-Z lowered, line
ends and tabs as spaces), long enough for a word's start of a few accented letters.

1. The model is fitted on at most ``max_train`` labelled rows, those whose hashed ids are
   smallest; every other number below comes from all of these rows. The sample's texts are
   found by a broadcast of its ids (bounded by ``max_train``), so the corpus never shuffles.
2. Executors count each n-gram's texts per class; a feature's ratio is
   r = log((p / |p|) / (q / |q|)) of its smoothed counts p (toxic) and q (other).
   All n-grams whose chi-square statistic is at least ``least_effect`` a row (it is 1 a row
   at most) are features, however many. In small samples the statistic must also reach 20,
   where chance alone makes some eight of the 2**20 hash values a feature, or an eighth of
   the rows' number.
3. Logistic regression with an L2 penalty is fitted on the driver to x * r, from the sparse
   rows of the sample's features. A model is at most 2**20 numbers and weights.
4. Every text is scored by one map over the corpus.

Edge cases: a null or empty text has no features and gets the intercept's probability; a
label other than 0 and 1, or a null id, teaches nothing; several labels of one id count as
toxic if any is, and of several texts of one id the least is learned; extra columns are
passed on (one called like the score is replaced); an empty table stays empty; without rows of both classes each text gets the smoothed share of toxic
rows. Only the text is ever an input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.textbatch import LOWER, slices
from quorumtext.runtime import cut

#: A-Z lowered, ASCII white space as one kind of space.
PLAIN = LOWER.copy()
PLAIN[9:14] = 32

SIZES = (3, 4, 5, 6, 7)
BITS = 20
MAX_TRAIN = 20_000
LEAST_EFFECT = 1 / 160
ALPHA = 1.0
SLICE = 1 << 18  # bytes of text whose n-grams are held at once
L2 = 1e-4
_K = 0x9E3779B97F4A7C15 | 1


def ngram_buckets(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, start byte) of every n-gram that lies inside a row, for each n in turn; data is lowered."""
    n = len(data)
    to_end = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    h = np.zeros(n, np.uint64)
    wide = data.astype(np.uint64) + np.uint64(1)
    for size in range(1, max(SIZES) + 1):
        if n < size:
            return
        h = h[: n - size + 1] + wide[size - 1 :] * np.uint64(pow(_K, size, 1 << 64))
        if size in SIZES:
            at = np.flatnonzero(to_end[: len(h)] >= size)
            x = h[at]
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield (x >> np.uint64(64 - BITS)).astype(np.int64), at


@dataclass
class Model:
    """lut[bucket] is a feature's number or -1; weight already holds r."""

    lut: np.ndarray
    weight: np.ndarray
    bias: float


def present(data: np.ndarray, bounds: np.ndarray, lut: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs of a slice, in order."""
    found = []
    for bucket, at in ngram_buckets(data, bounds):
        f = lut[bucket]
        ok = np.flatnonzero(f >= 0)
        row = np.searchsorted(bounds, at[ok], side="right") - 1
        found.append(row * max(1, n_features) + f[ok])
    key = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return key // max(1, n_features), key % max(1, n_features)


def class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per n-gram bucket: texts of class 0 and 1 that hold it."""
    total = np.zeros((2, 1 << BITS), np.int64)
    for b in batches:
        label = b.column(1).to_numpy(zero_copy_only=False)
        for s in slices(b.column(0), SLICE):
            data = PLAIN[s.data]
            for i in range(s.hi - s.lo):
                own = data[s.bounds[i] : s.bounds[i + 1]]
                found = [bucket for bucket, _ in ngram_buckets(own, np.array([0, len(own)]))]
                if found:
                    total[int(label[s.lo + i]), np.unique(np.concatenate(found))] += 1
    at = np.flatnonzero(total.sum(0))
    yield pa.record_batch({"bucket": pa.array(at.astype(np.int32)), "n0": pa.array(total[0][at]), "n1": pa.array(total[1][at])})


def fit_logistic(row: np.ndarray, col: np.ndarray, r: np.ndarray, y: np.ndarray, l2: float, steps: int = 25) -> tuple[np.ndarray, float]:
    """L2-penalised logistic regression on a 0/1 matrix with columns scaled by r, by Newton steps.

    Each step's system is solved by conjugate gradients, so the Hessian is never stored.
    """
    n, m = len(y), len(r)
    penalty = np.append(np.full(m, l2), 1e-8)  # the last weight is the intercept

    def dot(v: np.ndarray) -> np.ndarray:
        return v[m] + np.bincount(row, weights=(v[:m] * r)[col], minlength=n)

    def turned(g: np.ndarray) -> np.ndarray:
        return np.append(r * np.bincount(col, weights=g[row], minlength=m), g.sum())

    def loss(v: np.ndarray) -> float:
        z = dot(v)
        return float(np.mean(np.logaddexp(0, z) - y * z) + 0.5 * (penalty * v * v).sum())

    v = np.append(np.zeros(m), np.log((y.sum() + 1) / (n - y.sum() + 1)))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(dot(v), -35, 35)))
        grad = turned((p - y) / n) + penalty * v
        if np.abs(grad).max() < 1e-7:
            break
        curve = p * (1 - p) / n
        x, res = np.zeros(m + 1), -grad
        way, rr = res.copy(), float(res @ res)
        for _ in range(60):
            h = turned(curve * dot(way)) + penalty * way
            a = rr / max(float(way @ h), 1e-30)
            x, res = x + a * way, res - a * h
            new = float(res @ res)
            if new < 1e-6 * float(grad @ grad):
                break
            way, rr = res + new / rr * way, new
        size, now = 1.0, loss(v)
        while size > 1e-4 and loss(v + size * x) > now:
            size /= 2
        v = v + size * x
    return v[:m], float(v[m])


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, max_train: int) -> DataFrame:
    """(text, y) of the labelled ids with the smallest hashes, at most ``max_train`` rows."""
    one = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("y"))
    chosen = one.orderBy(F.xxhash64("_id"), "_id").limit(max_train)
    own = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "_id")
    return own.groupBy("_id", "y").agg(F.min("text").alias("text")).select("text", "y")


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_train: int = MAX_TRAIN, least_effect: float = LEAST_EFFECT, l2: float = L2) -> Model:
    """A model of ``label`` from at most ``max_train`` labelled documents.

    ``labels`` has the columns ``doc_id`` and ``label`` (0 or 1); others teach nothing.
    """
    rows = cut(training_rows(docs, labels, doc_id, text, label, max_train))
    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    lut = np.full(1 << BITS, -1, np.int32)
    flat = Model(lut, np.zeros(1), float(np.log((n1 + 1) / (n0 + 1))))
    if not n0 or not n1:
        return flat
    counts = rows.coalesce(16).mapInArrow(class_counts, "bucket int, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b"))
    p, q = F.col("b") + F.lit(ALPHA), F.col("a") + F.lit(ALPHA)
    share = (F.col("a") + F.col("b")) / F.lit(n0 + n1)
    chi = F.pow(F.col("b") - share * n1, 2) / (share * n1) + F.pow(F.col("a") - share * n0, 2) / (share * n0)
    counts = cut(counts)
    norm = counts.agg(F.sum(p).alias("p"), F.sum(q).alias("q")).first()
    least = max(least_effect * (n0 + n1), min(20.0, (n0 + n1) / 8))
    best = counts.where(chi >= least).orderBy("bucket").toPandas()
    if not len(best):
        return flat
    m = len(best)
    lut[best.bucket.to_numpy(np.int64)] = np.arange(m)
    r = np.log(((best.b + ALPHA) / norm.p) / ((best.a + ALPHA) / norm.q)).to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(lut)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for s in slices(b.column(0), SLICE):
                row, f = present(PLAIN[s.data], s.bounds, sent.value, m)
                got += np.split(f.astype(np.int32), np.searchsorted(row, np.arange(1, s.hi - s.lo)))
            yield pa.record_batch({"f": pa.array([x.tobytes() for x in got], pa.binary()), "y": b.column(1)})

    got = rows.mapInArrow(features, "f binary, y int").toPandas()
    cols = [np.frombuffer(x, np.int32) for x in got.f]
    row = np.repeat(np.arange(len(cols)), [len(c) for c in cols])
    w, b = fit_logistic(row, np.concatenate(cols), r, got.y.to_numpy(float), l2)
    return Model(lut, w * r, b)


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with column ``to``: the probability that the text is toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def each(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = sent.value
        for t in texts:
            out = []
            for s in slices(t, SLICE):
                row, f = present(PLAIN[s.data], s.bounds, m.lut, len(m.weight))
                out.append(m.bias + np.bincount(row, weights=m.weight[f], minlength=s.hi - s.lo))
            z = np.concatenate(out) if out else np.zeros(0)
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))

    return docs.withColumn(to, F.arrow_udf(each, "double")(F.col(text)))


def in_fold(doc_id: str | Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text is divisible by ``folds``; false for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % folds == 0, F.lit(False))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that has seen no label of the held-out fold."""
    from quorumtext.runtime import ship_package, table

    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").where(~in_fold("doc_id")))
    out = score(docs, model).drop("text")
    return out.select("doc_id", in_fold("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
