"""Queries of alignment, loops, near names and correction dictionaries, with SQL that searches by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumtext.operators import alignment, fuzzy, loops, naming, quality, speakers, turns
from quorumtext.operators.corrections import corrected
from quorumtext.plans.text_queries import _BARE, _WORDS
from quorumtext.runtime import table

# Fixed values of the queries: the stretch of a turn that its copy lacks, the words it changes.
GAP = (0.30, 0.71)
CHANGED = (17, 5)
# Fixed values of the queries: what is said over and over, how often, and what it breaks off in.
SAID = (" sari kata oleh", 12, " sari")
ZEROS = (",000", 30)
YES = (" ada", 9)


def _damaged(words: DataFrame, key: list[str]) -> DataFrame:
    """Words without a stretch of 41 in 100, and with each 17th changed."""
    size = F.count(F.lit(1)).over(Window.partitionBy(*key))
    own = words.withColumn("_n", size).where(~((F.col("pos") >= F.floor(F.col("_n") * GAP[0])) & (F.col("pos") < F.floor(F.col("_n") * GAP[1]))))
    word = F.when(F.col("pos") % CHANGED[0] == CHANGED[1], F.concat(F.lit("changed"), "pos")).otherwise(F.col("word"))
    own = own.withColumn("word", word).withColumn("pos", F.row_number().over(Window.partitionBy(*key).orderBy("pos")) - 1)
    return own.select(*key, "pos", "word", F.xxhash64("word").alias("h"))


def alignment_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits between each turn and a copy that lacks 41 in 100 of its words in one stretch and has others changed."""
    key = ["conv_id", "turn"]
    a = alignment.placed_words(table(spark, sf_dir, "conversations"), key, ["role"])
    return alignment.distances(a, _damaged(a, key), key)


def loops_inside_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetitions inside single words of documents; each third document ends in a number that goes on and on."""
    d = table(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" 9" + ZEROS[0] * 12))).otherwise(F.col("text"))
    found = loops.loop_rows(d.select("doc_id", text.alias("text")), ["doc_id"]).where("unit = 'char'")
    return found.groupBy("doc_id", "period", "repeats", "phrase").agg(F.count(F.lit(1)).alias("n"))


def _with_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with a loop behind their first word, by the turn's number, a rate of words and a share of speech."""
    t = table(spark, sf_dir, "conversations")
    put = F.when(F.col("turn") % 4 == 0, SAID[0] * SAID[1] + SAID[2]).when(F.col("turn") % 4 == 1, " 5" + ZEROS[0] * ZEROS[1]).when(F.col("turn") % 4 == 2, YES[0] * YES[1]).otherwise("")
    text = F.regexp_replace("text", "^([^ \t\n\r\f\x0b]+)", F.concat(F.lit("$1"), put))
    return t.select("conv_id", "turn", text.alias("text"), ((F.col("conv_id") % 11).cast("double")).alias("rate"), (F.col("conv_id") % 10 / 10).alias("speech"))


def loop_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns after the loops that rate, speech or length rule out are cut, and what is flagged instead."""
    t = _with_loops(spark, sf_dir)
    return loops.without_loops(t, rate=F.col("rate"), speech=F.col("speech")).select("conv_id", "turn", "text", "n_removed", "n_flagged")


def names_alike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of a language's longer documents and of its others that are at most two edits apart."""
    d = table(spark, sf_dir, "documents")
    side = lambda c: quality.names_in(d.where(c), ["lang"]).withColumnRenamed("name", "s")
    return fuzzy.within_edits(side("n_chars >= 1500"), side("n_chars < 1500"), ["lang"])


def correction_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns after a dictionary of all longer words of the user's turns, half of them for one conversation only."""
    t = table(spark, sf_dir, "conversations")
    word = t.where("role = 'user'").select("conv_id", F.explode(F.regexp_extract_all("text", F.lit(r"\w+"), F.lit(0))).alias("wrong")).where(r"wrong RLIKE '^[a-z]{5,}$'")
    everywhere = word.where("length(wrong) % 2 = 0").select("wrong", F.lit(None).cast("long").alias("scope"))
    fixed = everywhere.unionByName(word.where("length(wrong) % 2 = 1").select("wrong", F.col("conv_id").alias("scope"))).distinct()
    fixed = fixed.select(F.length("wrong").alias("ord"), "wrong", F.concat(F.lit("<"), F.upper("wrong"), F.lit(">")).alias("right"), "scope")
    return corrected(t, fixed, scope="conv_id").select("conv_id", "turn", "text")


def aliases_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns by canonical speakers: each conversation's assistant is its first user; counted."""
    t = table(spark, sf_dir, "conversations")
    names = t.where("role = 'assistant'").select(F.concat("role", F.lit(" "), "conv_id").alias("alias"), F.concat(F.lit("speaker "), F.col("conv_id") % 10).alias("canonical")).distinct()
    said = t.withColumn("speaker", F.concat("role", F.lit(" "), "conv_id"))
    return turns.with_aliases(said, names, "speaker").groupBy("speaker").agg(F.count(F.lit(1)).alias("n_turns"))


def crosstalk_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kinds of a user's events that began up to ten times their value in seconds before each event."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), "event_id", "event_type", "value", F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double").alias("t0"))
    said = e.select("video_id", "t0", (F.col("t0") + 600 * F.col("value")).alias("t1"), F.col("event_type").alias("spk"))
    return speakers.crosstalk(e, said).select("event_id", F.array_join("speakers", ",").alias("speakers"))


def voices_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each user whose kind and hour go together in the best matching of kinds with six parts of the day."""
    e = table(spark, sf_dir, "events")
    over = e.select(F.col("user_id").alias("video_id"), F.col("event_type").alias("spk"), F.floor(F.hour("ts") / 4).cast("string").alias("speaker")).groupBy("video_id", "spk", "speaker").agg(F.count(F.lit(1)).alias("weight"))
    return naming.matched_names(over).groupBy(F.col("video_id").alias("user_id")).agg(F.count(F.lit(1)).alias("n_voices"), F.sum("weight").cast("long").alias("n_events"))


def profiles_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding's nearest among those whose id is divisible by seven, named by their ids."""
    e = table(spark, sf_dir, "embeddings")
    known = e.where("vec_id % 7 = 0").select(F.lpad(F.col("vec_id").cast("string"), 9, "0").alias("speaker"), "embedding")
    found = naming.nearest_profile(e.select(F.col("vec_id").alias("video_id"), F.col("label").cast("string").alias("spk"), "embedding"), known)
    return found.select(F.col("video_id").alias("vec_id"), "speaker", F.round("similarity", 5).alias("similarity"))


QUERIES = {f.__name__: f for f in (alignment_distance, loops_inside_words, loop_removal, names_alike, correction_dictionary, aliases_resolved, crosstalk_words, voices_named, profiles_pruned)}

_CHARS = "regexp_extract_all(w, '.')"


def _distance_sql() -> str:
    """A full dynamic programme by diagonals."""
    cut = f"floor(len(a) * {GAP[0]}) AND i - 1 < floor(len(a) * {GAP[1]})"
    return f"""
        WITH RECURSIVE x AS (SELECT conv_id, turn, list_transform({_WORDS.format(c='text')}, lambda w: {_BARE}) AS a FROM conversations),
        y AS (SELECT conv_id, turn, a, list_filter(list_transform(a, lambda w, i: CASE WHEN i - 1 >= {cut} THEN NULL WHEN (i - 1) % {CHANGED[0]} = {CHANGED[1]} THEN 'changed' || (i - 1) ELSE w END), lambda w: w IS NOT NULL) AS b FROM x WHERE len(a) > 0),
        r AS (
            SELECT conv_id, turn, a, b, 0 AS d, list_transform(range(0, len(a) + 1), lambda i: CAST(CASE WHEN i = 0 THEN 0 ELSE 9999 END AS SMALLINT)) AS p, list_transform(range(0, len(a) + 1), lambda i: CAST(9999 AS SMALLINT)) AS q FROM y
            UNION ALL
            SELECT conv_id, turn, a, b, d + 1,
                   list_transform(range(0, len(a) + 1), lambda i: CAST(CASE WHEN d + 1 - i < 0 OR d + 1 - i > len(b) THEN 9999 WHEN i = 0 OR i = d + 1 THEN d + 1
                       ELSE least(p[i] + 1, p[i + 1] + 1, q[i] + CASE WHEN a[i] = b[d + 1 - i] THEN 0 ELSE 1 END) END AS SMALLINT)), p
            FROM r WHERE d < len(a) + len(b))
        SELECT conv_id, turn, len(a) AS n_a, len(b) AS n_b, CAST(p[len(a) + 1] AS BIGINT) AS n_edits FROM r WHERE d = len(a) + len(b)
    """


def repetitions_sql(symbols: str, key: str, least: int = 5, tag: str = "s") -> str:
    """CTEs ending in ``rep_<tag>`` (key, n, first, size, repeats): all pairs of equal symbols, islands by distance, least periods; ``symbols``: (key, pos, s)."""
    return f"""
        sym_{tag} AS ({symbols}),
        pairs_{tag} AS (SELECT {key}, b.pos - a.pos AS n, a.pos AS i FROM sym_{tag} a JOIN sym_{tag} b USING ({key}, s) WHERE b.pos > a.pos),
        islands_{tag} AS (SELECT {key}, n, i, i - row_number() OVER (PARTITION BY {key}, n ORDER BY i) AS run FROM pairs_{tag}),
        runs_{tag} AS (SELECT {key}, n, min(i) AS first, count(*) + n AS size FROM islands_{tag} GROUP BY {key}, n, run HAVING (count(*) + n) // n >= {least}),
        rep_{tag} AS (SELECT {key}, min(n) AS n, first, size, size // min(n) AS repeats FROM runs_{tag} GROUP BY {key}, first, size)
    """


#: DuckDB's edit distance counts bytes; letters beyond ASCII become one byte each for it.
_ONE_BYTE = "translate({c}, 'ÄÖÜßäöüÀÂÇÈÉÊËÎÏÔÛÙàâçèéêëîïôûùÁÍÓÚÑáíóúñ', '0123456789!\"#$%&()*+,/:;<=>?@[]^_`{{|}}~' || chr(1) || chr(2) || chr(3) || chr(4) || chr(5) || chr(6) || chr(7) || chr(8))"

ORACLE_SQL = {
    "alignment_distance": _distance_sql(),
    "loops_inside_words": f"""
        WITH w AS (SELECT doc_id, unnest({_WORDS.format(c="CASE WHEN doc_id % 3 = 0 THEN text || ' 9' || repeat(',000', 12) ELSE text END")}) AS w FROM documents),
        c AS (SELECT doc_id, w, count(*) AS n_words FROM w GROUP BY ALL),
        u AS (SELECT w, string_split(w, '') AS x FROM (SELECT DISTINCT w FROM c WHERE length(w) >= 5)),
        {repetitions_sql("SELECT w, x[i] AS s, i - 1 AS pos FROM (SELECT w, x, unnest(range(1, len(x) + 1)) AS i FROM u)", "w")}
        SELECT doc_id, CAST(n AS INTEGER) AS period, CAST(repeats AS INTEGER) AS repeats, substring(w, CAST(first + 1 AS BIGINT), CAST(n AS BIGINT)) AS phrase, CAST(sum(n_words) AS BIGINT) AS n
        FROM rep_s JOIN c USING (w) GROUP BY ALL
    """,
    "loop_removal": rf"""
        WITH t AS (SELECT conv_id, turn, conv_id % 11 > 7 OR (conv_id % 10) / 10 < 0.2 AS odd, regexp_replace(text, '^([^ \t\n\r\f\v]+)', '\1' || CASE turn % 4 WHEN 0 THEN repeat('{SAID[0]}', {SAID[1]}) || '{SAID[2]}' WHEN 1 THEN ' 5' || repeat('{ZEROS[0]}', {ZEROS[1]}) WHEN 2 THEN repeat('{YES[0]}', {YES[1]}) ELSE '' END) AS text FROM conversations),
        w AS (SELECT conv_id, turn, x[i] AS w, i FROM (SELECT conv_id, turn, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT conv_id, turn, {_WORDS.format(c="text")} AS x FROM t))),
        {repetitions_sql(f"SELECT conv_id, turn, {_BARE} AS s, i AS pos FROM w", "conv_id, turn", tag="w")},
        {repetitions_sql("SELECT conv_id, turn, i AS wi, x[k] AS s, k AS pos FROM (SELECT conv_id, turn, i, x, unnest(range(1, len(x) + 1)) AS k FROM (SELECT conv_id, turn, i, string_split(w, '') AS x FROM w WHERE length(w) >= 5))", "conv_id, turn, wi", tag="c")},
        l AS (SELECT conv_id, turn, repeats FROM rep_w UNION ALL SELECT conv_id, turn, repeats FROM rep_c),
        k AS (SELECT conv_id, turn, count(*) FILTER (repeats >= 10 AND (odd OR repeats >= 25)) AS n_removed, count(*) AS n FROM l JOIN t USING (conv_id, turn) GROUP BY ALL),
        f AS (SELECT *, length(regexp_extract(text, '(?:{SAID[0]})+')) // {len(SAID[0])} AS ns, length(regexp_extract(text, '(?:{ZEROS[0]})+')) // {len(ZEROS[0])} AS nz FROM t)
        SELECT conv_id, turn, CASE WHEN ns >= 10 AND (odd OR ns >= 25) THEN regexp_replace(text, '({SAID[0]})(?:{SAID[0]})+(?:{SAID[2]})?', '\1') WHEN nz >= 10 AND (odd OR nz >= 25) THEN regexp_replace(text, '({ZEROS[0]})(?:{ZEROS[0]})+', '\1') ELSE text END AS text,
               CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed, CAST(coalesce(n - n_removed, 0) AS INTEGER) AS n_flagged FROM f LEFT JOIN k USING (conv_id, turn)
    """,
    "names_alike": rf"""
        WITH f AS (SELECT DISTINCT lang, n_chars >= 1500 AS p, unnest(regexp_extract_all(coalesce(text, ''), '{quality.NAME.replace("'", "''")}')) AS name FROM documents),
        g AS (SELECT *, {_ONE_BYTE.format(c="name")} AS b FROM f)
        SELECT x.lang, x.name AS s, y.name AS t, CAST(levenshtein(x.b, y.b) AS INTEGER) AS distance FROM g x JOIN g y ON x.lang = y.lang AND x.p AND NOT y.p WHERE abs(length(x.name) - length(y.name)) <= 2 AND levenshtein(x.b, y.b) <= 2
    """,
    "correction_dictionary": r"""
        WITH w AS (SELECT conv_id, unnest(regexp_extract_all(text, '\w+')) AS w FROM conversations WHERE role = 'user'),
        d AS (SELECT DISTINCT w, CASE WHEN length(w) % 2 = 1 THEN conv_id END AS scope FROM w WHERE regexp_matches(w, '^[a-z]{5,}$')),
        t AS (SELECT conv_id, turn, x[i] AS w, i FROM (SELECT conv_id, turn, x, unnest(range(1, len(x) + 1)) AS i FROM (SELECT conv_id, turn, regexp_extract_all(text, '(?s)\w+|\W+') AS x FROM conversations)))
        SELECT conv_id, turn, string_agg(CASE WHEN EXISTS (SELECT 1 FROM d WHERE d.w = t.w AND (d.scope IS NULL OR d.scope = t.conv_id)) THEN '<' || upper(w) || '>' ELSE w END, '' ORDER BY i) AS text FROM t GROUP BY conv_id, turn
    """,
    "crosstalk_words": """
        WITH e AS (SELECT user_id, event_id, event_type, value, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events)
        SELECT p.event_id, coalesce(array_to_string(list_sort(list(DISTINCT s.event_type)), ','), '') AS speakers
        FROM e p LEFT JOIN e s ON s.user_id = p.user_id AND p.t >= s.t AND p.t < s.t + 600 * s.value GROUP BY p.event_id
    """,
    "voices_named": """
        WITH RECURSIVE c AS (SELECT user_id, event_type AS spk, hour(ts) // 4 AS part, count(*) AS n FROM events GROUP BY ALL),
        v AS (SELECT user_id, spk, row_number() OVER (PARTITION BY user_id ORDER BY spk) AS k FROM (SELECT DISTINCT user_id, spk FROM c)),
        m AS (SELECT user_id, 0 AS k, CAST([] AS BIGINT[]) AS taken, 0 AS total FROM v WHERE k = 1
              UNION ALL
              SELECT m.user_id, m.k + 1, CASE WHEN p.part IS NULL THEN m.taken ELSE list_append(m.taken, p.part) END, CAST(m.total + coalesce(c.n, 0) AS INTEGER)
              FROM m JOIN v ON v.user_id = m.user_id AND v.k = m.k + 1 CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4, 5, NULL]) AS part) p
              LEFT JOIN c ON c.user_id = m.user_id AND c.spk = v.spk AND c.part = p.part
              WHERE p.part IS NULL OR (NOT list_contains(m.taken, p.part) AND c.n > 0))
        SELECT user_id, CAST(max(k) AS BIGINT) AS n_voices, CAST(arg_max(total, k * 1000000 + total) AS BIGINT) AS n_events FROM m GROUP BY user_id
    """,
    "profiles_pruned": """
        WITH u AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM embeddings),
        s AS (SELECT a.vec_id, lpad(CAST(b.vec_id AS VARCHAR), 9, '0') AS speaker, list_inner_product(a.e, b.e) / (a.n * b.n) AS c FROM u a, u b WHERE b.vec_id % 7 = 0)
        SELECT vec_id, arg_max(speaker, c) AS speaker, round(max(c), 5) AS similarity FROM s GROUP BY vec_id
    """,
    "aliases_resolved": """
        SELECT CASE WHEN role = 'assistant' THEN 'speaker ' || conv_id % 10 ELSE role || ' ' || conv_id END AS speaker, count(*) AS n_turns FROM conversations GROUP BY ALL
    """,
}
