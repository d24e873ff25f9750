"""Queries of speaker assembly, gates, text rules, pages and readers, on the driver's tables.

Where an archive is needed one is written from ``conversations``: a file per conversation,
with a header, a heading and its turns, which the readers must give back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumtext.functions import text as T
from quorumtext.operators import naming, quality, speakers
from quorumtext.plans.text_queries import _NAMES, _SCALED, LEXICON, PHRASES
from quorumtext.runtime import table
from quorumtext.sources import archive, publish

# Fixed values of the queries: a sentence that is cut out, the size of a gate's segment, a gate's words and their least share.
SENTENCE = "thank you"
SEGMENT = 4
GATE_WORDS, GATE_SHARE = ("of", "to", "in", "de", "en", "der"), 0.02


def _one_line(c: str) -> F.Column:
    return F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"[\s:*|\[\]]+", " "))


def _conversation_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, pos, word, speaker): the words of conversations in order."""
    t = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("video_id"), "turn", F.col("role").alias("speaker"), F.posexplode(T.words("text")).alias("at", "word"))
    w = Window.partitionBy("video_id").orderBy("turn", "at")
    return t.withColumn("pos", F.row_number().over(w)).select("video_id", "pos", "word", "speaker")


def voice_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding's nearest of the labels' first embeddings."""
    e = table(spark, sf_dir, "embeddings")
    known = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding")).select(F.concat(F.lit("p"), "label").alias("speaker"), "embedding")
    voices = e.select(F.col("vec_id").alias("video_id"), F.col("label").cast("string").alias("spk"), "embedding")
    return naming.nearest_profile(voices, known).select(F.col("video_id").alias("vec_id"), "speaker", F.round("similarity", 5).alias("similarity"))


def sentence_snapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each role once changes of speaker have moved to sentence ends; every third change is late by a word before."""
    words = _conversation_words(spark, sf_dir)
    w = Window.partitionBy("video_id").orderBy("pos")
    late = words.withColumn("speaker", F.when(F.length("word") % 3 == 0, F.coalesce(F.lag("speaker").over(w), "speaker")).otherwise(F.col("speaker")))
    return speakers.snap_to_sentences(late).groupBy("video_id", "speaker").agg(F.count(F.lit(1)).alias("n_words"), F.sum("pos").alias("places")).withColumnRenamed("video_id", "conv_id")


def timed_rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' types, overruled from each purchase to an hour later."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t0"), F.col("event_type").alias("speaker"))
    ruled = e.where("speaker = 'purchase'").select("video_id", "t0", (F.col("t0") + 3600).alias("t1"), F.concat(F.lit("ruled "), F.col("t0")).alias("speaker"))
    return speakers.with_rulings(e, ruled, 3600.0).select("event_id", F.col("speaker").alias("label"))


def camera_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' types after a camera that sees one hour in two; runs of less than two keep theirs."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), F.col("event_id").alias("pos"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t0"), F.col("event_type").alias("speaker"))
    hours = e.select("video_id", (F.floor(F.col("t0") / 7200) * 7200).alias("t0")).distinct()
    seen = hours.select("video_id", "t0", (F.col("t0") + 3600).alias("t1"), F.lit("camera").alias("spk"))
    return speakers.by_camera(e, seen, 2, 3600.0).select(F.col("pos").alias("event_id"), F.col("speaker").alias("label"))


def credit_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' lines that name a licence and link somewhere; a link is put behind every licence, not behind other phrases."""
    linked = F.regexp_replace("text", "(?i)licen[cs]e", "$0 www.example.org/l ")
    d = table(spark, sf_dir, "documents").withColumn("text", linked).select("doc_id", quality.credit_lines("text", list(PHRASES)).alias("x"))
    return d.where(F.size("x") > 0).select("doc_id", F.size("x").cast("long").alias("n"), F.array_join("x", "\n").alias("lines"))


def model_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes about the text in turns, and user turns as orphans; a note is put before each third-length text."""
    t = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("video_id"), F.lit("raw").alias("layer"), F.col("turn").cast("int").alias("seq"), "role", F.when(F.length("text") % 3 == 0, F.concat(F.lit("[unclear, "), F.col("turn"), F.lit("] "), F.col("text"))).otherwise(F.col("text")).alias("text"))
    found = quality.model_notes(t, t.where("role = 'system'").select("video_id", "layer", F.col("seq").alias("line"), "text"))
    return found.groupBy("video_id", "check").agg(F.count(F.lit(1)).alias("n"), F.max("evidence").alias("evidence"))


def segment_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates between conversations and their copies without listed words, some with a speaker of another name, by segments of four turns."""
    t = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("video_id"), (F.col("turn") + 1).alias("seq"), F.col("role").alias("speaker"), "text")
    renamed = F.when((F.col("video_id") % 5 == 0) & (F.col("seq") % 3 == 2), "Speaker ?").otherwise(F.col("speaker"))
    told = t.withColumns({"text": T.without_words("text", list(LEXICON)), "speaker": renamed})
    out = quality.segment_gates(told, t, SEGMENT, 0.9, 1.3, list(GATE_WORDS), GATE_SHARE)
    return out.select(F.col("video_id").alias("conv_id"), "segment", F.round("ratio", 6).alias("ratio"), F.round("density", 6).alias("density"), "figures_kept", "speakers_kept", "passes")


def page_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as table cells and as navigation titles."""
    d = table(spark, sf_dir, "documents").withColumn("text", F.regexp_replace("text", "\\s+", " "))
    return d.select("doc_id", T.escaped_cell("text").alias("cell"), T.nav_title("text").alias("title"))


def phrase_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns without a sentence that stands behind each comma and at the end of some, in another case in others, where it stays."""
    t = table(spark, sf_dir, "conversations")
    said = F.when(F.col("turn") % 3 == 0, F.lit(SENTENCE)).when(F.col("turn") % 3 == 1, F.lit(SENTENCE.title())).otherwise(F.lit(""))
    put = F.concat(F.regexp_replace("text", F.lit(", "), F.concat(F.lit(", "), said, F.lit(" "))), F.lit(" "), said)
    return t.select("conv_id", "turn", quality.without_phrase(put, SENTENCE).alias("text"))


def clock_and_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' time of day read back from clocks, and links from event ids."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", T.clock_seconds(F.date_format("ts", "H:mm:ss")).alias("seconds"), T.clock_seconds(F.date_format("ts", "mm:ss")).alias("short"), F.coalesce(T.clock_seconds("event_type"), F.lit(-1)).alias("none"), T.video_url(F.col("event_id").cast("string")).alias("url"))


def guests_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows of conversations in both locales: guests are the roles that are not hosts."""
    t = table(spark, sf_dir, "conversations")
    ep = t.groupBy("conv_id").agg(F.array_sort(F.collect_set("role")).alias("guests"), F.max("turn").alias("last"))
    ep = ep.select(F.col("conv_id").cast("string").alias("video_id"), F.lit("show").alias("show"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("last").cast("int")).alias("publish_date"), F.col("last").cast("int").alias("ep"), F.concat(F.lit("a|b "), "conv_id").alias("title"), (F.col("last") * 1000).cast("int").alias("duration_seconds"), F.array(F.lit("assistant")).alias("hosts"), "guests")
    layers = ep.select("video_id", F.lit("raw").alias("layer"), F.concat("video_id", F.lit("/raw.md")).alias("path"))
    both = [publish.index_view(ep, layers, loc).select(F.lit(loc).alias("locale"), "publish_date", "row") for loc in ("en", "ms")]
    return both[0].unionByName(both[1]).withColumn("publish_date", F.date_format("publish_date", "yyyy-MM-dd"))


def topics_oldest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order priority's topic list, oldest month first."""
    o = table(spark, sf_dir, "orders").groupBy(F.trunc("o_orderdate", "month").alias("publish_date"), F.col("o_orderpriority").alias("show")).agg(F.array_sort(F.collect_set("o_orderstatus")).alias("topics"))
    rows = publish.topic_view(o.withColumns({"ep": F.lit(1), "title": F.lit("t")}))
    per = rows.groupBy("show").agg(F.array_sort(F.collect_list(F.struct("publish_date", "topic"))).alias("x"))
    return per.select("show", F.size("x").cast("long").alias("n"), F.array_join(F.transform("x", lambda v: F.concat(F.date_format(v["publish_date"], "yyyy-MM-dd"), F.lit(" "), v["topic"])), ", ").alias("topics"))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", _one_line("text").alias("text"))
    line = F.concat(F.lit("**"), F.col("role"), F.lit(":** "), F.col("text"))
    per = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))).alias("x"))
    head = F.concat(F.lit("---\ntitle: 'It''s no. "), F.col("conv_id"), F.lit("'\nvideo_id: v"), F.col("conv_id"), F.lit("\nduration_seconds: "), F.size("x"), F.lit("\nhosts:\n  - user\n---\n\n# Heading\n\nlead line\n\n"))
    text = F.concat(head, F.array_join(F.transform("x", lambda v: v["line"]), "\n\n"), F.lit("\n"))
    return per.select(F.concat(F.lit("/a/show/2024-01-01-ep01-x/interview.md#"), "conv_id").alias("path"), F.lit("show").alias("show"), F.lit(1).alias("ep"), F.lit("interview").alias("layer"), text.alias("text"))


def archive_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns read back from files written from conversations."""
    got = archive.turns(archive.with_headers(_files(spark, sf_dir)))
    return got.select("video_id", "seq", "speaker", "text", "n_paragraphs", "n_words")


def archive_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings and orphans read back from these files."""
    files = archive.with_headers(_files(spark, sf_dir))
    lone = archive.orphans(files).groupBy("video_id").agg(F.count(F.lit(1)).alias("n_orphans"), F.max("text").alias("orphan"))
    return archive.episodes(files).join(lone, "video_id", "left").select("video_id", "title", "duration_seconds", F.array_join("hosts", ",").alias("hosts"), "n_orphans", "orphan")


def _episodes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Recordings and layers made of conversations: a day and a show by id, three layers in four."""
    t = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max("turn").alias("last"))
    vid = F.lpad(F.col("conv_id").cast("string"), 11, "v")
    ep = t.select(vid.alias("video_id"), F.concat(F.lit("show "), F.col("conv_id") % 3).alias("show"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("conv_id").cast("int")).alias("publish_date"), (F.col("conv_id") % 100).cast("int").alias("ep"), F.concat(F.lit("a | b "), "conv_id", F.lit(" | Show")).alias("title"), (F.col("last") * 1000).cast("int").alias("duration_seconds"), F.array(F.lit("Ali")).alias("hosts"), F.array(F.lit("Ali"), F.lit("B. Abu")).alias("guests"))
    layers = t.select("conv_id", vid.alias("video_id"), F.explode(F.array(*[F.lit(k) for k in publish.LAYERS])).alias("layer")).where("NOT (layer = 'raw' AND conv_id % 4 = 1)")
    return ep, layers.select("video_id", "layer", F.concat("video_id", F.lit("/"), "layer", F.lit(".md")).alias("path"))


def index_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an index page for each show, read back from its text with the section they stand in."""
    ep, layers = _episodes(spark, sf_dir)
    rows = publish.index_view(ep, layers).groupBy("show").agg(F.array_sort(F.collect_list("row")).alias("x"))
    page = F.concat(F.lit("# Index\n\n## "), F.col("show"), F.lit("\n\n| Ep | Date |\n|---|---|\n"), F.array_join("x", "\n"), F.lit("\n"))
    got = archive.index_rows(rows.select(page.alias("text")), "en")
    return got.select("video_id", "section", "ep", F.date_format("date", "yyyy-MM-dd").alias("date"), "title", "length", F.array_join("hosts", ",").alias("hosts"), F.array_join("guests", ",").alias("guests"), F.array_join(F.map_keys("links"), ",").alias("links"))


def navigation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Navigation blocks of all layers: the current one in bold, links only to those that exist."""
    return publish.nav_blocks(*_episodes(spark, sf_dir))


QUERIES = {f.__name__: f for f in (voice_profiles, sentence_snapping, timed_rulings, camera_labels, credit_links, model_notes, segment_gates, page_cells, phrase_removal, clock_and_link, guests_listed, topics_oldest_first, archive_turns, archive_headers, index_read_back, navigation)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\v]+')"
_STRIP = r"regexp_replace(regexp_replace(w, '^[!-/:-@\[-`{-~]+', ''), '[!-/:-@\[-`{-~]+$', '')"
_LISTED = ", ".join(f"'{w}'" for w in LEXICON)
_SEC = "CAST(floor(epoch(ts)) AS BIGINT)"
_SAID = "|".join(PHRASES)
_FIGURES = rf"list_transform(regexp_extract_all(lower(coalesce(text, '')), '[0-9][0-9,]*(?:\.[0-9]+)?(?:\s*(?:{_NAMES})\b)?'), lambda f: CAST(CAST(replace(regexp_extract(f, '^[0-9,]+(?:\.[0-9]+)?'), ',', '') AS DECIMAL(24, 6)) * CASE regexp_extract(f, '[a-z]+$') {_SCALED} ELSE 1 END AS DECIMAL(38, 6)))"
_LABELS = "w AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) AS pos FROM (SELECT conv_id, turn, role, x[i] AS word, i FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM (SELECT conv_id, turn, role, " + _WORDS + " AS x FROM conversations))))"


def _snapping_sql() -> str:
    over = "OVER (PARTITION BY conv_id ORDER BY pos)"
    shift = " ".join(f"WHEN coalesce({'lead' if d >= 0 else 'lag'}(starts, {abs(d)}) {over}, false) THEN {d}" for d in (0, -1, 1, -2, 2))
    label = "speaker"
    for d in (1, 2):
        label = f"CASE WHEN coalesce(lead(change, {d}) {over} AND lead(dest, {d}) {over} <= {-d}, false) THEN lead(speaker, {d}) {over} ELSE {label} END"
        label = f"CASE WHEN coalesce(lag(change, {d - 1}) {over} AND lag(dest, {d - 1}) {over} >= {d}, false) THEN lag(before, {d - 1}) {over} ELSE {label} END"
    return rf"""
        WITH {_LABELS},
        s AS (SELECT conv_id, pos, word, CASE WHEN length(word) % 3 = 0 THEN coalesce(lag(role) {over}, role) ELSE role END AS speaker FROM w),
        m AS (SELECT *, coalesce(regexp_matches(lag(word) {over}, '[.!?]["'')\]]*$'), true) AS starts, coalesce(lag(speaker) {over} <> speaker, false) AS change, lag(speaker) {over} AS before FROM s),
        t AS (SELECT *, CASE WHEN change THEN CASE {shift} END END AS dest FROM m),
        l AS (SELECT conv_id, pos, {label} AS speaker FROM t)
        SELECT conv_id, speaker, count(*) AS n_words, CAST(sum(pos) AS BIGINT) AS places FROM l GROUP BY conv_id, speaker
    """


ORACLE_SQL = {
    "voice_profiles": """
        WITH k AS (SELECT 'p' || label AS speaker, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS e FROM embeddings GROUP BY label),
        s AS (SELECT vec_id, speaker, list_inner_product(CAST(embedding AS DOUBLE[]), e) / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) * list_inner_product(e, e)) AS c FROM embeddings, k)
        SELECT vec_id, arg_max(speaker, c) AS speaker, round(max(c), 5) AS similarity FROM s GROUP BY vec_id
    """,
    "sentence_snapping": _snapping_sql(),
    "timed_rulings": f"""
        WITH e AS (SELECT event_id, user_id, {_SEC} AS s, event_type FROM events),
        r AS (SELECT e.event_id, max(p.s) AS t FROM e JOIN (SELECT user_id, s FROM e WHERE event_type = 'purchase') p ON p.user_id = e.user_id AND e.s >= p.s AND e.s < p.s + 3600 GROUP BY e.event_id)
        SELECT event_id, coalesce('ruled ' || t, event_type) AS label FROM e LEFT JOIN r USING (event_id)
    """,
    "camera_labels": f"""
        WITH e AS (SELECT user_id, event_id, {_SEC} AS s, event_type FROM events),
        m AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
        r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM m),
        z AS (SELECT *, count(*) OVER (PARTITION BY user_id, run) AS n FROM r)
        SELECT event_id, CASE WHEN n < 2 OR s % 7200 >= 3600 THEN event_type ELSE 'camera' END AS label FROM z
    """,
    "credit_links": rf"""
        WITH x AS (SELECT doc_id, list_filter(string_split(regexp_replace(coalesce(text, ''), '(?i)licen[cs]e', '\0 www.example.org/l ', 'g'), chr(10)), lambda v: regexp_matches(v, '(?i){_SAID}') AND regexp_matches(v, '(?i)(?:https?://|www\.)\S|\b[a-z0-9-]+\.(?:com|org|net)\b')) AS x FROM documents)
        SELECT doc_id, CAST(len(x) AS BIGINT) AS n, array_to_string(x, chr(10)) AS lines FROM x WHERE len(x) > 0
    """,
    "model_notes": r"""
        WITH t AS (SELECT CAST(conv_id AS VARCHAR) AS video_id, role, CASE WHEN length(text) % 3 = 0 THEN '[unclear, ' || turn || '] ' || text ELSE text END AS text FROM conversations),
        f AS (SELECT video_id, 'model_note' AS "check", unnest(regexp_extract_all(coalesce(text, ''), '(?i)[\[(](?:note|nota|translator|penterjemah|transcript|transkrip|unclear|tidak jelas|inaudible)[^\])]*[\])]')) AS e FROM t
              UNION ALL SELECT video_id, 'orphan', text FROM t WHERE role = 'system')
        SELECT video_id, "check", count(*) AS n, max(e) AS evidence FROM f GROUP BY ALL
    """,
    "segment_gates": rf"""
        WITH r AS (SELECT conv_id, turn // {SEGMENT} AS segment, role, CASE WHEN conv_id % 5 = 0 AND (turn + 1) % 3 = 2 THEN 'Speaker ?' ELSE role END AS told, {_WORDS} AS w, {_FIGURES} AS f FROM conversations),
        p AS (SELECT conv_id, segment, role, told, f, len(w) AS n, list_filter(w, lambda w: lower({_STRIP}) NOT IN ({_LISTED})) AS text_w FROM r),
        q AS (SELECT *, len(text_w) AS k, len(list_filter(text_w, lambda w: lower({_STRIP}) IN ({", ".join(f"'{x}'" for x in GATE_WORDS)}))) AS d, array_to_string(text_w, ' ') AS text FROM p),
        g AS (SELECT conv_id, segment, sum(k) / nullif(sum(n), 0) AS ratio, sum(d) / nullif(sum(k), 0) AS density, flatten(list(f)) AS fr, flatten(list({_FIGURES})) AS fp, list(role) AS roles, list(told) AS tolds FROM q GROUP BY conv_id, segment),
        h AS (SELECT *, len(list_filter(fp, lambda x: NOT list_contains(fr, x))) = 0 AS kept, len(list_filter(tolds, lambda x: NOT list_contains(roles, x))) = 0 AS same FROM g)
        SELECT conv_id, segment, round(ratio, 6) AS ratio, round(density, 6) AS density, kept AS figures_kept, same AS speakers_kept, coalesce(ratio BETWEEN 0.9 AND 1.3 AND density >= {GATE_SHARE} AND kept AND same, false) AS passes FROM h
    """,
    "page_cells": r"""
        WITH d AS (SELECT doc_id, regexp_replace(text, '\s+', ' ', 'g') AS text FROM documents)
        SELECT doc_id, replace(text, '|', '\|') AS cell, regexp_replace(regexp_replace(text, '\s*\|\s*[^|]*$', ''), '\s*\|\s*', ' - ', 'g') AS title FROM d
    """,
    "phrase_removal": f"""
        WITH s AS (SELECT *, CASE turn % 3 WHEN 0 THEN '{SENTENCE}' WHEN 1 THEN '{SENTENCE.title()}' ELSE '' END AS said FROM conversations),
        p AS (SELECT conv_id, turn, replace(text, ', ', ', ' || said || ' ') || ' ' || said AS text FROM s)
        SELECT conv_id, turn, trim(regexp_replace(replace(text, '{SENTENCE}', ''), ' {{2,}}', ' ', 'g')) AS text FROM p
    """,
    "clock_and_link": "SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS seconds, CAST(minute(ts) * 60 + second(ts) AS INTEGER) AS short, -1 AS none, 'https://www.youtube.com/watch?v=' || event_id AS url FROM events",
    "guests_listed": """
        WITH c AS (SELECT conv_id, max(turn) AS l, array_to_string(list_sort(list_filter(list(DISTINCT role), lambda x: x <> 'assistant')), ', ') AS g FROM conversations GROUP BY conv_id),
        m AS (SELECT unnest(['en', 'ms']) AS locale, unnest(['Raw', 'Mentah']) AS raw)
        SELECT locale, strftime(DATE '2024-01-01' + CAST(l AS INTEGER), '%Y-%m-%d') AS publish_date,
               '| ' || lpad(CAST(l AS VARCHAR), 2, '0') || ' | ' || strftime(DATE '2024-01-01' + CAST(l AS INTEGER), '%Y-%m-%d') || ' | [a\\|b ' || conv_id || '](https://www.youtube.com/watch?v=' || conv_id || ') | '
               || (l * 1000 // 3600) || 'h ' || (l * 1000 % 3600 // 60) || 'm | assistant | ' || g || ' | [' || raw || '](' || conv_id || '/raw.md) |' AS row FROM c, m
    """,
    "topics_oldest_first": """
        WITH d AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS m, o_orderpriority AS s, o_orderstatus AS t FROM orders)
        SELECT s AS "show", count(*) AS n, string_agg(strftime(m, '%Y-%m-%d') || ' ' || t, ', ' ORDER BY m, t) AS topics FROM d GROUP BY s
    """,
    "archive_turns": rf"""
        WITH t AS (SELECT conv_id, turn, role, trim(regexp_replace(coalesce(text, ''), '[\s:*|\[\]]+', ' ', 'g')) AS text FROM conversations)
        SELECT 'v' || conv_id AS video_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS seq, role AS speaker, text, 1 AS n_paragraphs, CAST(len({_WORDS}) AS BIGINT) AS n_words FROM t
    """,
    "index_read_back": """
        WITH c AS (SELECT conv_id, max(turn) AS l FROM conversations GROUP BY conv_id)
        SELECT lpad(CAST(conv_id AS VARCHAR), 11, 'v') AS video_id, 'show ' || conv_id % 3 AS section, lpad(CAST(conv_id % 100 AS VARCHAR), 2, '0') AS ep, strftime(DATE '2024-01-01' + CAST(conv_id AS INTEGER), '%Y-%m-%d') AS date,
               'a | b ' || conv_id || ' | Show' AS title, (l * 1000 // 3600) || 'h ' || (l * 1000 % 3600 // 60) || 'm' AS length, 'Ali' AS hosts, 'B. Abu' AS guests,
               CASE WHEN conv_id % 4 = 1 THEN '' ELSE 'Raw,' END || 'Interview,English,Bahasa Melayu' AS links FROM c
    """,
    "navigation": """
        WITH c AS (SELECT conv_id, max(turn) AS l FROM conversations GROUP BY conv_id),
        k AS (SELECT unnest(['raw', 'interview', 'interview-en', 'interview-ms']) AS layer, unnest(['Raw', 'Interview', 'English', 'Bahasa Melayu']) AS name, unnest([1, 2, 3, 4]) AS o),
        f AS (SELECT * FROM c, k WHERE NOT (layer = 'raw' AND conv_id % 4 = 1))
        SELECT lpad(CAST(a.conv_id AS VARCHAR), 11, 'v') AS video_id, a.layer, '<!-- nav -->' || chr(10) || '**a - b ' || a.conv_id || '**' || chr(10) || chr(10)
               || CAST(day(DATE '2024-01-01' + CAST(any_value(a.conv_id) AS INTEGER)) AS VARCHAR) || strftime(DATE '2024-01-01' + CAST(any_value(a.conv_id) AS INTEGER), ' %B %Y') || ' · ' || (any_value(a.l) * 1000 // 3600) || 'h ' || (any_value(a.l) * 1000 % 3600 // 60) || 'm · '
               || string_agg(CASE WHEN b.layer = a.layer THEN '**' || b.name || '**' ELSE '[' || b.name || '](' || b.layer || '.md)' END, ' · ' ORDER BY b.o) || chr(10) || '<!-- /nav -->' AS nav
        FROM f a JOIN f b ON a.conv_id = b.conv_id GROUP BY a.conv_id, a.layer
    """,
    "archive_headers": "SELECT 'v' || conv_id AS video_id, 'It''s no. ' || conv_id AS title, CAST(count(*) AS INTEGER) AS duration_seconds, 'user' AS hosts, 1 AS n_orphans, 'lead line' AS orphan FROM conversations GROUP BY conv_id",
}
