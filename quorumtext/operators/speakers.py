"""Speaker assembly: words meet segments, labels are overridden, snapped and named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.operators.sweep import active_at
from quorumtext.operators.turns import coalesced
from quorumtext.runtime import unused


def point_in_interval(points: DataFrame, intervals: DataFrame, key: list[str], at: str, start: str, end: str, width: float, keep: list[str]) -> DataFrame:
    """``points`` with the columns ``keep`` of the interval, start <= at < end, that holds them, null where none does.

    Where several intervals hold a point, the latest start wins, then the earliest end, then the
    largest ``keep``.
    """
    found = unused(points.columns, "_active")
    rows = active_at(points, intervals, key, at, start, end, keep, width, found)
    best = F.array_max(F.transform(found, lambda x: F.struct(x["start"].alias("s"), (-x["end"]).alias("e"), *[x[c].alias(c) for c in keep])))
    return rows.withColumn(found, best).select(*points.columns, *[F.col(found)[c].alias(c) for c in keep])


def crosstalk(words: DataFrame, segments: DataFrame, width: float = 60.0) -> DataFrame:
    """``words`` with ``speakers``, all that a segment at the word's start names, sorted: several during crosstalk, none in silence."""
    got = active_at(words, segments, ["video_id"], "t0", "t0", "t1", ["spk"], width, "speakers")
    return got.withColumn("speakers", F.array_sort(F.array_distinct(F.filter(F.transform("speakers", lambda x: x["spk"]), lambda s: s.isNotNull()))))


def assign_speakers(words: DataFrame, segments: DataFrame, width: float = 60.0, fallback: str | None = None) -> DataFrame:
    """``words`` (video_id, pos, word, t0, t1, ...) with ``speaker`` from the segment at the word's start.

    A word in no segment takes ``fallback``, a column of the voice profile's label, else the
    unknown speaker.
    """
    base = words.drop("speaker") if fallback != "speaker" else words.withColumnRenamed("speaker", "_profile")
    got = point_in_interval(base, segments, ["video_id"], "t0", "t0", "t1", width, ["spk"])
    silent = "_profile" if fallback == "speaker" else fallback
    return got.withColumn("speaker", coalesced("spk", *([silent] if silent else []))).drop("spk", "_profile")


def by_camera(words: DataFrame, segments: DataFrame, least_words: int = 4, width: float = 60.0) -> DataFrame:
    """Camera labels at word times; turns shorter than ``least_words`` words keep the label they had."""
    w = Window.partitionBy("video_id").orderBy("pos")
    new = F.when(F.lag("speaker").over(w).eqNullSafe(F.col("speaker")), 0).otherwise(1)
    runs = words.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy("video_id", "_run"))).drop("_new", "_run")
    got = point_in_interval(runs, segments, ["video_id"], "t0", "t0", "t1", width, ["spk"])
    return got.withColumn("speaker", F.when(F.col("_size") < least_words, F.col("speaker")).otherwise(coalesced("spk", "speaker"))).drop("spk", "_size")


def with_rulings(words: DataFrame, rulings: DataFrame, width: float = 60.0) -> DataFrame:
    """Owner rulings (video_id, t0, t1, speaker) beat every other label."""
    ruled = point_in_interval(words, rulings.withColumnRenamed("speaker", "_ruled"), ["video_id"], "t0", "t0", "t1", width, ["_ruled"])
    return ruled.withColumn("speaker", coalesced("_ruled", "speaker")).drop("_ruled")


def snap_to_sentences(words: DataFrame, reach: int = 2) -> DataFrame:
    """A change of speaker within ``reach`` words of a sentence's end moves to it.

    The nearest end wins, the earlier one on a tie. Words between the old and the new place
    of the change take the label of the side that they now lie on.
    """
    w = Window.partitionBy("video_id").orderBy("pos")
    ends = F.lag("word").over(w).rlike(r"[.!?][\"')\]]*$")
    change = (F.lag("speaker").over(w) != F.col("speaker")).alias("_change")
    marked = words.withColumns({"_starts": F.coalesce(ends, F.lit(True)), "_change": F.coalesce(change, F.lit(False)), "_before": F.lag("speaker").over(w)})
    shift: Column = F.lit(None).cast("int")
    for d in reversed([0, *[s * k for k in range(1, reach + 1) for s in (-1, 1)]]):
        shift = F.when(F.coalesce(F.lead("_starts", d).over(w) if d >= 0 else F.lag("_starts", -d).over(w), F.lit(False)), F.lit(d)).otherwise(shift)
    marked = marked.withColumn("_to", F.when(F.col("_change"), shift))
    label = F.col("speaker")
    for d in range(1, reach + 1):  # a change d words ahead that moves back over this word, or d - 1 behind that moves on
        ahead, target, new = F.lead("_change", d).over(w), F.lead("_to", d).over(w), F.lead("speaker", d).over(w)
        label = F.when(F.coalesce(ahead & (target <= -d), F.lit(False)), new).otherwise(label)
        back, went, old = F.lag("_change", d - 1).over(w), F.lag("_to", d - 1).over(w), F.lag("_before", d - 1).over(w)
        label = F.when(F.coalesce(back & (went >= d), F.lit(False)), old).otherwise(label)
    return marked.withColumn("_label", label).withColumn("speaker", F.col("_label")).drop("_starts", "_change", "_before", "_to", "_label")


def label_errors(words: DataFrame, gold: DataFrame) -> DataFrame:
    """Per recording: words whose speaker differs from the corrected copy, all words, and the rate."""
    g = gold.select("video_id", "pos", F.col("speaker").alias("_gold"))
    per = words.join(g, ["video_id", "pos"]).groupBy("video_id").agg(F.count_if(~F.col("speaker").eqNullSafe(F.col("_gold"))).alias("n_wrong"), F.count(F.lit(1)).alias("n_words"))
    return per.withColumn("rate", F.col("n_wrong") / F.col("n_words"))
