"""Quality by co-training: a text-content view and a page-metadata view teach each other.

1. One map turns every document into its features, written to the shared folder: about 200
   small numbers, not the text. Of these at most ``max_labelled`` labelled rows, those with
   the smallest hashed ids, reach the driver.
2. A fifth of the labelled rows is set aside for calibration. Each view starts from the rest
   and fits a penalised logistic regression. In each of ``rounds`` rounds both views score
   *all* unlabelled documents on the executors, and each hands the other the ``gifts`` rows
   it is surest of, at ``confident`` or more, in the labelled classes' proportion, with its
   labels; then both are fitted again. A row is never handed to the same view twice. The
   surest rows are found by a histogram of the scores and a top-k behind its cut, so only
   they reach the driver: 2 * rounds * gifts at most.
3. Each view's log-odds are calibrated on the rows set aside (a slope and an intercept), and
   the two calibrated log-odds are combined by a logistic regression on the same rows.
4. One map scores every document.

Text view: shares of character classes, words' lengths, repeats and case, lines, and the
words themselves, hashed with signs into WORDS places. Metadata view: language and source
(an indicator for each value among the labelled rows, one for all others) and length. The text
view has the length in bytes among its measures, so the two share that one; all else is apart.

Edge cases: null or empty texts have zero counts; null metadata is a category of its own;
labels other than 0 and 1 or without id teach nothing, several labels of one id count as
their smallest, and of several rows of one id one teaches; rows without an id are scored but
never handed over; without both classes every document gets the smoothed share of good rows;
extra columns are passed on (those called like the scores are replaced); an empty table
stays empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.textbatch import slices, span_hashes, word_spans
from quorumtext.runtime import cut, unused

Surest = Callable[[list, int, int, int, set], tuple[list, np.ndarray]]
NAMES = ("text_score", "meta_score", "score")

MAX_LABELLED = 10_000
ROUNDS = 5
CONFIDENT = 0.97
GIFTS = 400
WORDS = 128

# The text view's character classes, each a share of the bytes.
_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r", "\n", ".,;:'\"-", "!?", "|/\\", "#$%&*@^~=+_", "<>[](){}")
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _k, _chars in enumerate(_CLASSES):
    _CLASS[np.frombuffer(_chars.encode(), np.uint8)] = _k
_CLASS[128:] = len(_CLASSES) + 1
_N_CLASSES = len(_CLASSES) + 2
IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
N_TEXT = _N_CLASSES + 9 + WORDS


def text_features(col: pa.Array) -> np.ndarray:
    """One row of N_TEXT numbers for each text."""
    out = []
    for s in slices(col):
        n = s.hi - s.lo
        size = np.diff(s.bounds)
        row = np.repeat(np.arange(n), size)
        kinds = np.bincount(row * _N_CLASSES + _CLASS[s.data], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES)
        st, en, first = word_spans(s.data, s.bounds, IS_WORD)
        words = np.diff(first)
        at = np.repeat(np.arange(n), words)
        h = span_hashes(s.data, st, en)
        order = np.lexsort((h, at))
        new = np.ones(len(h), bool)
        new[1:] = (h[order[1:]] != h[order[:-1]]) | (at[order[1:]] != at[order[:-1]])
        once = order[new]
        distinct = np.bincount(at[once], minlength=n)
        place, sign = (h[once] >> np.uint64(40)).astype(np.int64) % WORDS, 1 - 2 * (h[once] & np.uint64(1)).astype(np.int64)
        said = np.bincount(at[once] * WORDS + place, weights=sign, minlength=n * WORDS).reshape(n, WORDS) / np.sqrt(np.maximum(distinct, 1))[:, None]
        same = np.bincount(at[1:][(h[1:] == h[:-1]) & (at[1:] == at[:-1])], minlength=n)  # back to back
        length = en - st
        upper = np.bincount(at[(_CLASS[s.data[st]] == 1) & (_CLASS[s.data[np.minimum(st + 1, len(s.data) - 1)]] == 1)], minlength=n) if len(h) else np.zeros(n)
        odd_end = np.bincount(at[np.isin(_CLASS[s.data[en - 1]], (6, 7, 8))], minlength=n) if len(h) else np.zeros(n)
        many, w = np.maximum(size, 1), np.maximum(words, 1)
        mean = np.bincount(at, weights=length, minlength=n) / w
        var = np.bincount(at, weights=length.astype(float) ** 2, minlength=n) / w - mean**2
        lines = kinds[:, 4] + 1
        more = [np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(var, 0)), distinct / w, same / w, upper / w, odd_end / w, np.log1p(words / lines)]
        out.append(np.concatenate([kinds / many[:, None], np.stack(more, 1), said], 1))
    return np.concatenate(out) if out else np.zeros((0, N_TEXT))


@dataclass
class Meta:
    """The values of language and source that have an indicator of their own."""

    langs: list
    sources: list

    def features(self, lang: list, source: list, n_chars: list) -> np.ndarray:
        """One row for each document: indicators, the last of each for other values, and length."""
        n, i = len(lang), np.arange(len(lang))
        width = len(self.langs) + len(self.sources) + 2
        out = np.zeros((n, width + 3))
        for start, known, values in ((0, self.langs, lang), (len(self.langs) + 1, self.sources, source)):
            seat = {v: k for k, v in enumerate(known)}
            out[i, [start + seat.get(v, len(known)) for v in values]] = 1
        size = np.log1p(np.array([0 if x is None else max(0, x) for x in n_chars], float))
        out[:, -3:] = np.stack([size, size**2 / 10, [x is None for x in n_chars]], 1)
        return out


def fit_dense(x: np.ndarray, y: np.ndarray, l2: float, steps: int = 30) -> np.ndarray:
    """Weights and intercept (last) of an L2-penalised logistic regression, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    pen = np.append(np.full(x.shape[1] - 1, l2), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        g = x.T @ (p - y) / len(y) + pen * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(pen), g)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(g).max() < 1e-8:
            break
    return w


@dataclass
class View:
    """Log-odds of one view: standardised features, weights, calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight[:-1] + self.weight[-1]

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


@dataclass
class Model:
    views: list[View]
    mix: np.ndarray  # weights of the two views' log-odds, and an intercept
    meta: Meta | None = None

    def scores(self, xs: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        odds = [v.odds(x) for v, x in zip(self.views, xs, strict=True)]
        both = sum(m * o for m, o in zip(self.mix, odds, strict=False)) + self.mix[-1]
        return tuple(1 / (1 + np.exp(-np.clip(o, -35, 35))) for o in (*odds, both))


def _flat(good: float, bad: float, widths: list[int], meta: Meta | None = None) -> Model:
    odds = float(np.log((good + 1) / (bad + 1)))
    return Model([View(np.zeros(n), np.ones(n), np.append(np.zeros(n), odds)) for n in widths], np.array([0.5, 0.5, 0.0]), meta)


def co_train(labelled: list[np.ndarray], y: np.ndarray, surest: Surest, rounds: int = ROUNDS, gifts: int = GIFTS, l2: float = 1e-3) -> Model:
    """Two views of labelled rows; ``surest`` finds what a view hands over.

    ``surest(views, k, label, n, known)``: at most n unlabelled rows that view k is surest
    have that label, but none of the ids in ``known``, as (ids, their features for the other view).
    """
    aside = np.arange(len(y)) % 5 == 4
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        return _flat(y.sum(), len(y) - y.sum(), [x.shape[1] for x in labelled])
    xs = [x[~aside] for x in labelled]
    ys = [y[~aside].astype(float)] * 2
    good = y[~aside].mean()
    had: list[set] = [set(), set()]  # ids handed to each view
    means, scales = [x.mean(0) for x in xs], [x.std(0) + 1e-3 for x in xs]

    def fitted(k: int) -> View:
        v = View(means[k], scales[k], np.zeros(0))
        v.weight = fit_dense(np.clip((xs[k] - v.mean) / v.scale, -8, 8), ys[k], l2)
        return v

    views = [fitted(k) for k in range(2)]
    for _ in range(rounds):
        handed = [[surest(views, 1 - k, label, int(np.ceil(gifts * part)), had[k]) for label, part in ((1, good), (0, 1 - good))] for k in range(2)]
        for k in range(2):
            for label, (ids, x) in zip((1.0, 0.0), handed[k], strict=True):
                had[k].update(ids)
                if len(ids):
                    xs[k], ys[k] = np.concatenate([xs[k], x]), np.concatenate([ys[k], np.full(len(ids), label)])
        if not any(len(ids) for h in handed for ids, _ in h):
            break
        views = [fitted(k) for k in range(2)]
    yc = y[aside].astype(float)
    for k, v in enumerate(views):
        v.slope, v.shift = fit_dense(v.raw(labelled[k][aside])[:, None], yc, 1e-3)
        v.slope = max(float(v.slope), 0.0)
    mix = fit_dense(np.stack([v.odds(x[aside]) for v, x in zip(views, labelled, strict=True)], 1), yc, 1e-3)
    return Model(views, mix)


def features_of(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(id, t, lang, source, n_chars) of documents; t: the text view as 32-bit numbers, words as bytes of 1/32."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(_packed(text_features(b.column(1))), pa.binary()), *b.columns[2:]], names=["id", "t", "lang", "source", "n_chars"])

    kind = lambda c: docs.schema[c].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("id"), F.col("text").alias("text"), "lang", "source", "n_chars")
    return own.mapInArrow(each, f"id {kind(doc_id)}, t binary, lang {kind('lang')}, source {kind('source')}, n_chars {kind('n_chars')}")


def _packed(x: np.ndarray) -> list[bytes]:
    head = x[:, :-WORDS].astype(np.float32)
    words = np.clip(np.round(x[:, -WORDS:] * 32), -127, 127).astype(np.int8)
    return [a.tobytes() + b.tobytes() for a, b in zip(head, words, strict=True)]


def _unpacked(t: list[bytes]) -> np.ndarray:
    n = 4 * (N_TEXT - WORDS)
    raw = np.frombuffer(b"".join(t), np.uint8).reshape(len(t), n + WORDS) if len(t) else np.zeros((0, n + WORDS), np.uint8)
    return np.concatenate([raw[:, :n].copy().view(np.float32).astype(float), raw[:, n:].view(np.int8) / 32.0], 1)


def _plain(values: pd.Series) -> list:
    return [None if pd.isna(v) else v for v in values]


def train(docs: DataFrame, labels: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", label: str = "quality", max_labelled: int = MAX_LABELLED, **options) -> Model:
    """Co-train on ``docs`` (doc_id, text, lang, source, n_chars) and ``labels``; ids in ``known`` are never handed over."""
    one = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id")).agg(F.min(label).cast("int").alias("y"))
    chosen = cut(one.orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    taken = (known if known is not None else labels).select(F.col(doc_id).alias("id")).distinct()
    rows = cut(features_of(docs, doc_id))
    own = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min(F.struct("y", "t", "lang", "source", "n_chars")).alias("x")).select("id", "x.*")
    got = own.toPandas()
    got = got.iloc[np.argsort([xxhash.xxh64_intdigest(str(i)) for i in got.id], kind="stable")]
    meta = Meta(sorted(set(_plain(got.lang)), key=str), sorted(set(_plain(got.source)), key=str))
    views = lambda f: [_unpacked(list(f.t)), meta.features(*(_plain(f[c]) for c in ("lang", "source", "n_chars")))]
    x = views(got)
    y = got.y.to_numpy(int)
    if len(got) and min(y.sum(), len(y) - y.sum()) > 0:
        pool = cut(rows.where("id IS NOT NULL").join(taken.hint("merge"), "id", "left_anti"))
        model = co_train(x, y, _Pool(pool, meta, views), **options)
    else:
        model = _flat(y.sum(), len(y) - y.sum(), [v.shape[1] for v in x])
    model.meta = meta
    return model


class _Pool:
    """Finds the unlabelled rows that a view is surest of; one scoring map for each pair of fitted views."""

    def __init__(self, rows: DataFrame, meta: Meta, views: Callable[[pd.DataFrame], list[np.ndarray]]):
        self.rows, self.meta, self.views = rows, meta, views
        self.of: list[View] | None = None
        self.kind = rows.schema["id"].dataType.simpleString()

    def scored(self, views: list[View]) -> DataFrame:
        if views is self.of:
            return self.held
        sent = self.rows.sparkSession.sparkContext.broadcast((views, self.meta))

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (text, page), meta = sent.value
            for b in batches:
                odds = [text.raw(_unpacked(b.column(1).to_pylist())), page.raw(meta.features(*(b.column(i).to_pylist() for i in (2, 3, 4))))]
                yield pa.record_batch([b.column(0), *[pa.array(o) for o in odds]], names=["id", "o0", "o1"])

        self.of, self.held = views, cut(self.rows.mapInArrow(each, f"id {self.kind}, o0 double, o1 double").groupBy("id").agg(F.min("o0").alias("o0"), F.min("o1").alias("o1")))
        return self.held

    def __call__(self, views: list[View], k: int, label: int, n: int, known: set) -> tuple[list, np.ndarray]:
        odds = F.col(f"o{k}") if label else -F.col(f"o{k}")
        sure = self.scored(views).select("id", odds.alias("sure")).where(F.col("sure") >= float(np.log(CONFIDENT / (1 - CONFIDENT))))
        most = n + len(known)
        bins = sorted(((r.b, r.n) for r in sure.groupBy(F.least(F.floor(F.col("sure") * 8), F.lit(4000)).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
        total, cut_at = 0, 0
        for b, m in bins:
            total, cut_at = total + m, b
            if total >= most:
                break
        top = [r.id for r in sure.where(F.col("sure") >= cut_at / 8).orderBy(F.desc("sure"), "id").limit(most).collect()]
        ids = [i for i in top if i not in known][:n]
        if not ids:
            return [], np.zeros((0, 0))
        few = self.rows.sparkSession.createDataFrame([(i,) for i in ids], f"id {self.kind}")
        found = self.rows.join(F.broadcast(few), "id").groupBy("id").agg(F.min(F.struct("t", "lang", "source", "n_chars")).alias("x")).select("id", "x.*").orderBy("id").toPandas()
        return list(found.id), self.views(found)[1 - k]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with text_score, meta_score and score: probabilities that a document is good."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def each(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for text, lang, source, n_chars in parts:
            m = sent.value
            got = m.scores([_unpacked(_packed(text_features(text))), m.meta.features(*(x.to_pylist() for x in (lang, source, n_chars)))])
            yield pa.StructArray.from_arrays([pa.array(g) for g in got], names=list(NAMES))

    to = unused(docs.columns, "scores")
    view = F.arrow_udf(each, ", ".join(f"{c} double" for c in NAMES))("text", "lang", "source", "n_chars")
    return docs.withColumn(to, view).withColumns({c: F.col(f"{to}.{c}") for c in NAMES}).drop(to)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents by views that have seen no label of the held-out fold (crc32 of the id, mod 5, is 0)."""
    from quorumtext.llm.toxicity import in_fold
    from quorumtext.runtime import ship_package, table

    ship_package(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~in_fold("doc_id")), known=labels)
    out = score(docs, model)
    return out.select("doc_id", in_fold("doc_id").alias("held_out"), "text_score", "meta_score", "score", (F.col("score") >= 0.5).alias("keep"))
