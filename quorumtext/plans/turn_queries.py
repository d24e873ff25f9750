"""Queries over speaker turns, on the shapes of ``conversations`` and ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumtext.operators import integrity, quality, speakers, turns
from quorumtext.runtime import table
from quorumtext.streaming.ingest import event_counts


def speaker_word_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and share of words of each speaker in each conversation."""
    return turns.speaker_share(table(spark, sf_dir, "conversations"), ["conv_id"], "role", "text")


def turn_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each role follows each other one."""
    return turns.transitions(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role")


def turn_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal runs of one event type of each user: number, start, length."""
    e = turns.islands(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type")
    return e.groupBy("user_id", "island").agg(F.min("event_type").alias("event_type"), F.min("ts").alias("start"), F.count(F.lit(1)).alias("n"))


def turn_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with neighbouring turns of one role joined."""
    t = table(spark, sf_dir, "conversations")
    return turns.build_turns(t.withColumn("start", F.col("turn")), ["conv_id"], ["turn"], "role", "start", "text").withColumn("n_turns", F.col("n_words")).drop("n_words")


def turn_order_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ties and decreases of the time in event order, per user."""
    return turns.order_faults(table(spark, sf_dir, "events"), ["user_id"], "event_id", "ts")


def turn_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of properties per second up to the user's next event."""
    e = table(spark, sf_dir, "events").withColumn("sec", F.unix_timestamp(F.col("ts").cast("timestamp")))
    return turns.speaking_rate(e, ["user_id"], "event_id", "sec", "props").select("event_id", "n_words", F.round("rate", 6).alias("rate"))


def layer_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant words per user word, by conversation."""
    t = table(spark, sf_dir, "conversations")
    return turns.layer_ratio(t.where("role = 'user'"), t.where("role = 'assistant'"), ["conv_id"], "text")


def point_in_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other events with the click, up to the user's next one, that they follow."""
    e = table(spark, sf_dir, "events")
    from pyspark.sql import Window

    second = F.unix_timestamp(F.col("ts").cast("timestamp")).alias("sec")
    kinds = e.select("user_id", "event_id", "event_type", second)
    w = Window.partitionBy("user_id").orderBy("sec", "event_id")
    marks = kinds.where("event_type = 'click'").select("user_id", F.col("event_id").alias("mark_id"), F.col("sec").alias("from_sec"), F.lead("sec").over(w).alias("to_sec"))
    points = kinds.where("event_type <> 'click'").select("event_id", "user_id", "sec")
    out = speakers.point_in_interval(points, marks.where("to_sec IS NOT NULL"), ["user_id"], "sec", "from_sec", "to_sec", 86400.0, ["mark_id", "from_sec"])
    return out.select("event_id", "mark_id", "from_sec")


def override_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' source, overridden by a ruling where a label exists."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    rulings = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id", F.lit("ruled").alias("ruled"))
    return d.join(rulings, "doc_id", "left").select("doc_id", turns.coalesced("ruled", "source").alias("source"))


def as_of_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's latest click of the same user, at or before it."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("video_id"), F.lit("raw").alias("layer"), F.col("event_id").cast("int").alias("seq"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("start_sec"), "event_type")
    clicks = e.where("event_type = 'click'").select("video_id", F.col("start_sec").alias("t0"))
    return quality.nearest_caption(e, clicks).select(F.col("seq").alias("event_id"), F.col("caption_t0").cast("long").alias("click_sec"))


def label_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns whose role differs from a copy in which each seventh turn was ruled otherwise."""
    t = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("pos"), F.col("role").alias("speaker"))
    gold = t.withColumn("speaker", F.when(F.col("pos") % 7 == 3, "Audience").otherwise(F.col("speaker")))
    return speakers.label_errors(t, gold).select(F.col("video_id").alias("conv_id"), "n_wrong", "n_words", F.round("rate", 6).alias("rate"))


def sibling_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields in which documents of one text differ."""
    d = table(spark, sf_dir, "documents").select(F.md5("text").alias("video_id"), "lang", "source", "n_chars")
    return integrity.sibling_drift(d, ["lang", "source", "n_chars"]).withColumnRenamed("video_id", "text_md5")


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each type by hour, as the stream counts them."""
    return event_counts(table(spark, sf_dir, "events"), "ts", "event_type").withColumn("start", F.unix_timestamp("start"))


QUERIES = {f.__name__: f for f in (speaker_word_share, turn_transition, turn_islands, turn_build, turn_order_faults, turn_rate, layer_ratio, point_in_interval, override_coalesce, as_of_nearest, label_errors, sibling_drift, event_windows)}

_W = r"len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\v]+'))"

ORACLE_SQL = {
    "speaker_word_share": rf"""
        WITH w AS (SELECT conv_id, role, CAST(sum({_W}) AS BIGINT) AS n_words, count(*) AS n_turns FROM conversations GROUP BY conv_id, role)
        SELECT conv_id, role, n_turns, n_words, round(n_words / nullif(sum(n_words) OVER (PARTITION BY conv_id), 0), 6) AS share FROM w
    """,
    "turn_transition": """
        SELECT p AS from_speaker, role AS to_speaker, count(*) AS n
        FROM (SELECT role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) WHERE p IS NOT NULL GROUP BY ALL
    """,
    "turn_islands": """
        WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new
                   FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        i AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM m)
        SELECT user_id, island, min(event_type) AS event_type, min(ts) AS start, count(*) AS n FROM i GROUP BY user_id, island
    """,
    "turn_build": """
        WITH m AS (SELECT *, CASE WHEN lag(role) OVER w IS NOT DISTINCT FROM role AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new
                   FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
        i AS (SELECT *, CAST(sum(new) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seq FROM m)
        SELECT conv_id, seq, coalesce(min(role), 'Speaker ?') AS role, min(turn) AS start, string_agg(text, ' ' ORDER BY turn) AS text, CAST(count(*) AS INTEGER) AS n_turns
        FROM i GROUP BY conv_id, seq
    """,
    "turn_order_faults": """
        SELECT user_id, count(*) AS n_turns, count(*) FILTER (ts = p) AS n_ties, count(*) FILTER (ts < p) AS n_decreases
        FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) GROUP BY user_id
    """,
    "turn_rate": rf"""
        WITH e AS (SELECT event_id, CAST({_W.replace("text", "props")} AS BIGINT) AS n_words, CAST(floor(epoch(ts)) AS BIGINT) AS s, user_id FROM events),
        n AS (SELECT *, lead(s) OVER (PARTITION BY user_id ORDER BY event_id) - s AS d FROM e)
        SELECT event_id, n_words, round(CASE WHEN d > 0 THEN n_words / d END, 6) AS rate FROM n
    """,
    "layer_ratio": rf"""
        WITH w AS (SELECT conv_id, role, CAST(sum({_W}) AS BIGINT) AS n FROM conversations GROUP BY conv_id, role)
        SELECT a.conv_id, a.n AS words_a, b.n AS words_b, round(b.n / nullif(a.n, 0), 6) AS ratio
        FROM w a JOIN w b ON a.conv_id = b.conv_id AND a.role = 'user' AND b.role = 'assistant'
    """,
    "point_in_interval": """
        WITH e AS (SELECT event_id, event_type, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events),
        m AS (SELECT user_id, event_id AS mark_id, s AS a, lead(s) OVER (PARTITION BY user_id ORDER BY s, event_id) AS z FROM e WHERE event_type = 'click'),
        h AS (SELECT p.event_id, m.mark_id, m.a, row_number() OVER (PARTITION BY p.event_id ORDER BY m.a DESC NULLS LAST, m.z, m.mark_id DESC) AS k
              FROM e p LEFT JOIN m ON p.user_id = m.user_id AND p.s >= m.a AND p.s < m.z WHERE p.event_type <> 'click')
        SELECT event_id, mark_id, a AS from_sec FROM h WHERE k = 1
    """,
    "override_coalesce": """
        SELECT d.doc_id, coalesce(CASE WHEN l.doc_id IS NOT NULL THEN 'ruled' END, d.source, 'Speaker ?') AS source
        FROM documents d LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 0) l USING (doc_id)
    """,
    "as_of_nearest": """
        WITH e AS (SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)
        SELECT CAST(event_id AS INTEGER) AS event_id, max(CASE WHEN event_type = 'click' THEN s END) OVER (PARTITION BY user_id ORDER BY s RANGE UNBOUNDED PRECEDING) AS click_sec FROM e
    """,
    "label_errors": """
        SELECT conv_id, count(*) FILTER (turn % 7 = 3) AS n_wrong, count(*) AS n_words, round(count(*) FILTER (turn % 7 = 3) / count(*), 6) AS rate
        FROM conversations GROUP BY conv_id
    """,
    "sibling_drift": """
        WITH f AS (SELECT md5(text) AS text_md5, unnest(['lang', 'source', 'n_chars']) AS field, unnest([lang, source, CAST(n_chars AS VARCHAR)]) AS v FROM documents)
        SELECT text_md5, field, count(DISTINCT v) AS n_values FROM f GROUP BY ALL HAVING count(DISTINCT v) > 1
    """,
    "event_windows": """
        SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start, event_type, count(*) AS n FROM events GROUP BY ALL
    """,
}
