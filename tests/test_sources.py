"""The archive as a data source, and runs on a stream that is stopped and goes on."""

import os
import time

from pyspark.sql import functions as F

from quorumtext.operators import turns
from quorumtext.runtime import ship_package
from quorumtext.sources import archive, datasource
from quorumtext.streaming import islands
from tests.test_archive import HEAD, NAV, write

COLUMNS = ["video_id", "layer", "seq", "line", "start_sec", "speaker", "text", "n_paragraphs", "n_words"]


def corpus(root, shows=2, episodes=3):
    for s in range(shows):
        for e in range(episodes):
            a = dict(title="T", vid=f"{s}{e}".ljust(11, "x"), sec=60, dur="0h 1m", views=1, more="note: n\nmodel: m\n")
            d = f"2024-01-0{e + 1}-ep0{e + 1}-t"
            write(root, f"show-{s}", d, "raw", HEAD.format(**a) + NAV + "# Raw Transcript\n\n[00:01] Ali (D'C): satu: dua é\n\n[1:51:01] Speaker ?: tiga\n\n---\n\nnot raw\n")
            write(root, f"show-{s}", d, "interview", HEAD.format(**a) + "# Interview\n\nlone\n\n**Ali:** Hello\n\nmore words\n\n[00:02] no: turn here\n\n**B. C:** x\n")


def test_the_source_gives_the_turns_of_the_batch_reader(spark, tmp_path):
    corpus(tmp_path)
    ship_package(spark)
    datasource.register(spark)
    want = archive.turns(archive.with_headers(archive.scan_layers(spark, str(tmp_path)))).select(COLUMNS)
    for how in ({}, {"partitionBytes": "1"}):
        got = spark.read.format("transcripts").options(**how).load(str(tmp_path))
        assert sorted(map(str, got.select(COLUMNS).collect())) == sorted(map(str, want.collect())) and got.count() > 0
        assert got.rdd.getNumPartitions() == (12 if how else 1)
    own = spark.read.format("transcripts").option("partitionBytes", "1").load(str(tmp_path)).where("layer = 'raw' AND show IN ('show-1', 'other') AND seq > 0")
    assert own.rdd.getNumPartitions() == 3 and {(r.show, r.layer) for r in own.collect()} == {("show-1", "raw")}
    assert spark.read.format("transcripts").load(str(tmp_path / "none")).count() == 0
    assert spark.read.format("transcripts").load(f"file://{tmp_path}").count() == want.count()


def test_only_matching_files_are_opened(tmp_path):
    corpus(tmp_path)
    reader = datasource.TurnReader({"path": str(tmp_path)})
    rest = list(reader.pushFilters([datasource.EqualTo(("layer",), "raw"), datasource.In(("ep",), (1, 3)), datasource.EqualTo(("speaker",), "Ali")]))
    assert rest == [datasource.EqualTo(("speaker",), "Ali")]
    paths = [p for part in reader.partitions() for p in part.paths]
    assert len(paths) == 4 and all(p.endswith("raw.md") and "ep02" not in p for p in paths)


def test_the_stream_takes_each_file_once(spark, tmp_path):
    corpus(tmp_path / "a", 1, 2)
    ship_package(spark)
    datasource.register(spark)

    def run():
        q = spark.readStream.format("transcripts").load(str(tmp_path / "a")).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count()

    first = run()
    assert first == spark.read.format("transcripts").load(str(tmp_path / "a")).count() and run() == first
    time.sleep(0.05)
    corpus(tmp_path / "b", 1, 3)
    new = tmp_path / "a" / "show-0" / "2024-01-03-ep03-t"
    os.rename(tmp_path / "b" / "show-0" / "2024-01-03-ep03-t", new)
    assert run() == first + 4  # two turns a file


def test_runs_on_a_stream_equal_those_of_the_batch_after_a_stop(spark, tmp_path):
    """Events of sf0.001 in three files, out of order inside and between them, the stream stopped after each."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events = events.orderBy("ts").withColumn("part", F.ntile(3).over(__import__("pyspark").sql.Window.orderBy("ts", "event_id"))).cache()
    late = events.where("part = 1").orderBy(F.desc("ts")).limit(5).cache()  # come with the second part, within the watermark's delay
    files = [events.where("part = 1").join(late, "event_id", "left_anti"), events.where("part = 2").unionByName(late), events.where("part = 3")]
    schema = "event_id long, user_id long, ts timestamp, event_type string"
    to, state = str(tmp_path / "runs"), str(tmp_path / "state")
    for k, rows in enumerate(files):
        rows.select("event_id", "user_id", "ts", "event_type").orderBy(F.rand(k)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        q = islands.follow(stream, "user_id", "ts", "event_id", "event_type", to, state, late="3 days")
        q.awaitTermination()
        seen = files[0].select(schema_names := ["event_id", "user_id", "ts", "event_type"])
        for more in files[1 : k + 1]:
            seen = seen.unionByName(more.select(schema_names))
        batch = turns.islands(seen, ["user_id"], ["ts", "event_id"], "event_type").groupBy("user_id", "island").agg(F.min("event_type").alias("kind"), F.min("ts").alias("start"), F.count(F.lit(1)).alias("n"))
        want = sorted((str(r.user_id), r.island, r.kind, r.start, r.n) for r in batch.collect())
        assert sorted((r.key, r.island, r.kind, r.start, r.n) for r in islands.current(spark, to).collect()) == want
