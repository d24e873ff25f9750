"""Names for anonymous voices: best one-to-one matching by overlap, and nearest known profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.operators.alignment import RUN, aligned, bare
from quorumtext.operators.turns import UNKNOWN
from quorumtext.runtime import Tables, cut, ship_package, unused

MAX_PROFILES = 10_000


def best_matching(gain: np.ndarray) -> np.ndarray:
    """For each row its column in a one-to-one matching of greatest total gain, -1 where it has none.

    Shortest augmenting paths with potentials, one row at a time; gains are not negative, and a
    match without gain is none.
    """
    turned = gain.shape[0] > gain.shape[1]
    cost = -(gain.T if turned else gain).astype(np.float64)
    n, m = cost.shape
    u, v, owner = np.zeros(n), np.zeros(m + 1), np.full(m + 1, -1)
    for row in range(n):
        owner[m], at = row, m
        least, before, done = np.full(m, np.inf), np.full(m, m), np.zeros(m + 1, bool)
        while owner[at] >= 0:
            done[at] = True
            i = owner[at]
            slack = cost[i] - u[i] - v[:m]
            better = ~done[:m] & (slack < least)
            least[better], before[better] = slack[better], at
            free = np.where(done[:m], np.inf, least)
            then = int(np.argmin(free))
            step = free[then]
            u[owner[done]] += step
            v[done] -= step
            least[~done[:m]] -= step
            at = then
        while at != m:
            owner[at] = owner[before[at]]
            at = before[at]
        owner[m] = -1
    out = np.full(gain.shape[0], -1)
    for c in np.flatnonzero(owner[:m] >= 0):
        r, k = (c, owner[c]) if turned else (owner[c], c)
        if gain[r, k] > 0:
            out[r] = k
    return out


def matched_names(overlap: DataFrame) -> DataFrame:
    """(video_id, spk, speaker, weight): each recording's voices matched one to one with names, for the greatest total overlap.

    ``overlap``: (video_id, spk, speaker, weight), summed by the four first; weights that are null or not above zero are no
    overlap. A voice left over has a null speaker and weight 0. The matrix of a
    recording is its voices by its names, which no number of words makes larger.
    """
    ship_package(overlap.sparkSession)
    per = overlap.where("spk IS NOT NULL").groupBy("video_id", "spk", "speaker").agg(F.coalesce(F.sum(F.col("weight").cast("double")), F.lit(0.0)).alias("weight"))
    schema = per.schema

    def match(t: pa.Table) -> pa.Table:
        t = t.sort_by([("spk", "ascending"), ("speaker", "ascending")])
        voices, names = (t.column(c).combine_chunks().dictionary_encode() for c in ("spk", "speaker"))
        rows, cols = voices.indices.to_numpy(), names.indices.to_numpy(zero_copy_only=False)
        known = np.flatnonzero(~np.isnan(cols.astype(float)))
        gain = np.zeros((len(voices.dictionary), max(1, len(names.dictionary))))
        gain[rows[known], cols[known].astype(int)] = np.maximum(0, t.column("weight").to_numpy()[known])
        to = best_matching(gain)
        weight = np.where(to >= 0, gain[np.arange(len(to)), to], 0.0)
        speakers = names.dictionary.take(pa.array([None if x < 0 else int(x) for x in to], pa.int64()))
        video = t.column("video_id").combine_chunks().take(pa.array(np.zeros(len(to), np.int64)))
        return pa.table([video, voices.dictionary, speakers, pa.array(weight)], names=schema.names)

    return per.groupBy("video_id").applyInArrow(match, schema)


def diarisation_errors(words_of: DataFrame, gold: DataFrame, n: int = RUN) -> DataFrame:
    """(video_id, n_wrong, n_words, n_unmatched, rate): label errors of anonymous voices under their best matching with the speakers of a corrected copy.

    Both have video_id, pos, word and speaker. Words are aligned first, so the copy may be of another
    length; voices are matched on the aligned words; a word is wrong if its voice's
    match is not its speaker in the copy. Words without a partner are counted apart.
    """
    sides = [w.select("video_id", "pos", bare(F.col("word")).alias("word"), "speaker").withColumn("h", F.xxhash64("word")) for w in (words_of, gold)]
    links = aligned(*sides, ["video_id"], n).where("a_pos IS NOT NULL")
    ours = sides[0].select("video_id", F.col("pos").alias("a_pos"), F.coalesce("speaker", F.lit(UNKNOWN)).alias("spk"))
    theirs = sides[1].select("video_id", F.col("pos").alias("b_pos"), F.coalesce("speaker", F.lit(UNKNOWN)).alias("speaker"))
    both = links.join(ours, ["video_id", "a_pos"]).join(theirs, ["video_id", "b_pos"], "left")
    counts = both.groupBy("video_id", "spk", "speaker").agg(F.count(F.lit(1)).alias("weight"))
    told = matched_names(counts.where("speaker IS NOT NULL")).select("video_id", "spk", F.col("speaker").alias("_name"))
    judged = counts.join(told, ["video_id", "spk"], "left")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("weight"))), F.lit(0))
    out = judged.groupBy("video_id").agg(total(F.col("speaker").isNotNull() & ~F.col("speaker").eqNullSafe(F.col("_name"))).alias("n_wrong"), total(F.col("speaker").isNotNull()).alias("n_words"), total(F.col("speaker").isNull()).alias("n_unmatched"))
    return out.withColumn("rate", F.col("n_wrong") / F.nullif(F.col("n_words"), F.lit(0)))


class Profiles:
    """Unit vectors in groups around pivots, each with the greatest angle to its pivot."""

    def __init__(self, names: list[str], rows: np.ndarray):
        order = np.argsort(np.array(names, object), kind="stable")[::-1]  # equal ones: the last name wins
        self.names, self.rows = [names[i] for i in order], rows[order]
        n = len(rows)
        chosen, far = [0], self.angles(self.rows, self.rows[:1])[:, 0] if n else np.zeros(0)
        while len(chosen) < int(np.ceil(np.sqrt(n))):  # each pivot as far as can be from those before
            chosen.append(int(np.argmax(far)))
            far = np.minimum(far, self.angles(self.rows, self.rows[chosen[-1:]])[:, 0])
        self.pivots = self.rows[chosen]
        d = self.angles(self.rows, self.pivots)
        own = np.argmin(d, axis=1)
        self.groups = [np.flatnonzero(own == p) for p in range(len(chosen))]
        self.radius = np.array([d[g, p].max() if len(g) else -np.inf for p, g in enumerate(self.groups)])

    @staticmethod
    def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(a @ b.T, -1.0, 1.0))

    def nearest(self, x: np.ndarray, best: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Improve best similarities and the profiles' numbers of rows x in place; how many profiles each row met.

        A group whose pivot is further away than its radius and the best so far allow can hold no nearer one.
        """
        d = self.angles(x, self.pivots)
        met = np.full(len(x), len(self.pivots))
        least = d - self.radius - 1e-7  # no profile of the group has a smaller angle
        first = np.argmin(d, axis=1)
        for again in (False, True):
            for p, g in enumerate(self.groups):
                bound = np.arccos(np.clip(best, -1.0, 1.0))
                rows = np.flatnonzero((first != p) & (least[:, p] <= bound) if again else first == p)
                if not len(rows) or not len(g):
                    continue
                s = np.einsum("vd,pd->vp", x[rows], self.rows[g])  # each number by itself, so equal profiles tie
                top = s.argmax(axis=1)
                value, number = s[np.arange(len(rows)), top], g[top]
                win = (value > best[rows]) | ((value == best[rows]) & (number < who[rows]))
                best[rows[win]], who[rows[win]] = value[win], number[win]
                met[rows] += len(g)
        return met


def nearest_profile(voices: DataFrame, profiles: DataFrame, max_profiles: int = MAX_PROFILES) -> DataFrame:
    """(video_id, spk, speaker, similarity, n_compared): each anonymous voice's nearest named profile by cosine, exactly.

    ``profiles`` (speaker, embedding) is a query set that every voice needs: it travels in blocks of about half of
    ``max_profiles`` rows, one after the other, and a voice keeps its best of them all. What a block found is a table
    before the next is sent, so a task holds one block, however many there are. Inside a block a voice meets only the
    groups that the triangle inequality leaves; ``n_compared`` counts the pivots and profiles it met.
    Of equally near profiles the last by name wins. A voice or profile without a direction (null, empty, zero,
    null or non-finite components), and a profile of another length than the voice, is near nothing: such a voice has a null speaker.
    """
    ship_package(voices.sparkSession)
    e = F.col("embedding")
    sound = e.isNotNull() & F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(e, lambda x: x != 0)
    known = profiles.where(F.col("speaker").isNotNull() & F.coalesce(sound, F.lit(False)))
    n = known.count()
    blocks = -(-2 * n // max_profiles) if n > max_profiles else 1
    block = F.pmod(F.xxhash64("speaker", "embedding"), F.lit(blocks))
    name = {c: unused(voices.columns, c) for c in ("speaker", "similarity", "n_compared", "sound")}
    out = voices.select("video_id", "spk", "embedding", F.coalesce(sound, F.lit(False)).alias(name["sound"]), F.lit(None).cast("string").alias("speaker"), F.lit(None).cast("double").alias("similarity"), F.lit(0).cast("long").alias("n_compared"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields)
    with Tables(voices.sparkSession, "profiles") as keep:
        for k in range(blocks):
            rows = known.where(block == k).select("speaker", "embedding").collect()
            by: dict[int, tuple[list[str], list]] = {}
            for r in rows:
                names, vectors = by.setdefault(len(r.embedding), ([], []))
                names.append(r.speaker)
                vectors.append(r.embedding)
            unit = lambda x: x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]
            sent = voices.sparkSession.sparkContext.broadcast({d: Profiles(names, unit(np.array(vectors, np.float64))) for d, (names, vectors) in by.items()})

            def each(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    size = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
                    ok = b.column(3).to_numpy(zero_copy_only=False)
                    speaker, similarity = b.column(4).to_pylist(), b.column(5).to_numpy(zero_copy_only=False).copy()
                    met = b.column(6).to_numpy().copy()
                    for d, own in sent.value.items():
                        at = np.flatnonzero(ok & (size == d))
                        for lo in range(0, len(at), 4096):
                            part = at[lo : lo + 4096]
                            x = b.column(2).take(pa.array(part)).flatten().to_numpy().astype(np.float64).reshape(len(part), d)
                            x /= np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]
                            best, who = np.full(len(part), -np.inf), np.zeros(len(part), np.int64)
                            met[part] += own.nearest(x, best, who)
                            for i, s, w in zip(part.tolist(), best.tolist(), who.tolist(), strict=True):
                                if speaker[i] is None or (s, own.names[w]) > (similarity[i], speaker[i]):
                                    similarity[i], speaker[i] = s, own.names[w]
                    yield pa.record_batch([*b.columns[:4], pa.array(speaker, pa.string()), pa.array(similarity, pa.float64(), from_pandas=True), pa.array(met)], names=b.schema.names)

            out = out.mapInArrow(each, kinds)
            if k < blocks - 1:
                out = keep(out, alone=True)
        out = out.select("video_id", "spk", "speaker", "similarity", "n_compared")
        return cut(out) if blocks > 1 else out
