"""New layer files as a stream: one run takes what has come since the last and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quorumtext.sources import archive


def ingest_turns(spark: SparkSession, root: str, to: str, state: str) -> StreamingQuery:
    """Append the turns of files not seen before to Parquet at ``to``; ``state`` is the stream's checkpoint.

    Each batch is parsed by the batch readers; a batch that is run again after a failure
    replaces its own folder, so turns are never written twice.
    """
    files = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").schema("value string").load(root)
    path = F.col("_metadata.file_path")
    part = lambda i: F.regexp_extract(path, archive.EPISODE_DIR, i)
    rows = files.select(path.alias("path"), part(1).alias("show"), part(3).try_cast("int").alias("ep"), part(5).alias("layer"), F.col("value").alias("text")).where("show <> ''")

    def write(batch: DataFrame, n: int) -> None:
        archive.turns(archive.with_headers(batch)).write.mode("overwrite").parquet(f"{to}/batch={n}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()


def event_counts(events: DataFrame, time: str, kind: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Windowed counts by kind; on a stream, rows later than ``late`` are dropped by the watermark."""
    timed = events.withColumn("_at", F.col(time).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("_at", late)
    return timed.groupBy(F.window("_at", window).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")
