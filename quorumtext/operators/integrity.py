"""Does the archive agree with itself: index and files, sibling layers, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.functions.text import duration_label, slug


def index_against_files(index: DataFrame, files: DataFrame) -> DataFrame:
    """(video_id, layer, state): links without a file (``dangling``), files without a link (``unlisted``)."""
    linked = index.select("video_id", F.explode(F.map_values("links")).alias("link")).select("video_id", F.regexp_extract("link", r"([^/]+)\.md$", 1).alias("layer")).where("layer <> ''").distinct().withColumn("linked", F.lit(True))
    there = files.select("video_id", "layer").distinct().withColumn("there", F.lit(True))
    both = linked.join(there, ["video_id", "layer"], "full_outer")
    return both.where("linked IS NULL OR there IS NULL").select("video_id", "layer", F.when(F.col("there").isNull(), "dangling").otherwise("unlisted").alias("state"))


def sibling_drift(headers: DataFrame, fields: list[str]) -> DataFrame:
    """(video_id, field, n_values): header fields whose values differ between a recording's layers."""
    long = headers.select("video_id", F.explode(F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), F.array(*[F.col(f).cast("string") for f in fields]))).alias("field", "value"))
    return long.groupBy("video_id", "field").agg(F.count_distinct(F.coalesce("value", F.lit("\0"))).alias("n_values")).where("n_values > 1")


def key_faults(files: DataFrame) -> DataFrame:
    """(video_id, fault): ids in several directories, wrong dates, lengths and slugs against the header."""
    h = files.select(F.col("header.video_id").alias("video_id"), "dir_date", "slug", "show", "ep", F.try_to_date(F.col("header.publish_date"), "yyyy-MM-dd").alias("date"), F.col("header.duration").alias("duration"), duration_label("header.duration_seconds").alias("shown"), slug("header.title").alias("made"))
    tell = F.array_compact(F.array(F.when(F.col("dir_date") != F.col("date"), "date"), F.when(F.col("duration") != F.col("shown"), "duration"), F.when(~F.col("made").startswith(F.rtrim(F.col("slug"), F.lit("-"))), "slug")))
    own = h.select("video_id", F.explode(tell).alias("fault")).distinct()
    twice = h.groupBy("video_id").agg(F.count_distinct("show", "ep", "dir_date").alias("n")).where("n > 1").select("video_id", F.lit("directories").alias("fault"))
    return own.unionByName(twice)


def unknown_speakers(turns: DataFrame, episodes: DataFrame) -> DataFrame:
    """(video_id, layer, speaker, n): turns whose speaker is neither host nor guest."""
    people = episodes.select("video_id", F.explode(F.concat(F.coalesce("hosts", F.array().cast("array<string>")), F.coalesce("guests", F.array().cast("array<string>")))).alias("speaker")).distinct()
    return turns.groupBy("video_id", "layer", "speaker").agg(F.count(F.lit(1)).alias("n")).join(people, ["video_id", "speaker"], "left_anti").select("video_id", "layer", "speaker", "n")


def totals(episodes: DataFrame) -> DataFrame:
    """(show, n_episodes, hours)."""
    return episodes.groupBy("show").agg(F.count(F.lit(1)).alias("n_episodes"), F.round(F.sum("duration_seconds") / 3600, 3).alias("hours"))
