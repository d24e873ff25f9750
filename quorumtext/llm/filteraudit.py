"""Filter interaction audit: what each of five filters removes, in every order they can be applied in.

1. Texts that are equal become one row by their SHA-256, with the smallest doc_id that has
   them; the copies are gone before the shuffle, and the rows then lie by text.
2. Words are exploded and counted by (text, word), then by text, for the totals and the
   distinct words. The first step's partitioning serves both, so words never shuffle.
3. A second, narrow scan gives each document its other flags; totals, first ids and labels
   are outer-joined to it, with sides in files, so a text that a third of all documents share
   can be split.
4. Documents are counted by (part, failures), five bits, and these at most 32 rows a part
   become the 32 columns ``kept(S)``: the documents that fail no filter of the set S. An order's
   every step is a difference of two of them, so no order is ever run over documents.

Filters. A: fewer than ``min_words`` words; B: the share of distinct words is below
``least_distinct`` in 100; C: more than ``most_upper`` in 100 code points are A-Z; D: a
symbol; E: equal to the text of a smaller doc_id.

Edge cases: a null text is empty: it fails A (and E where a smaller doc_id has one), never B, C or D.
Rows of one doc_id are counted each; they fail E only by a smaller doc_id. A null doc_id fails
no E, makes no other row fail it, and has no label. A null source is the part ``''``, like an
empty one. Several labels of one document count as 1 if any is. Extra columns are ignored; an
empty table has no part and gives no row.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.runtime import cut

# Words, and the symbols of filter D.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
MIN_WORDS, LEAST_DISTINCT, MOST_UPPER = 50, 65, 5
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def word_totals(docs: DataFrame) -> DataFrame:
    """(sha, first_id, n_words, n_distinct) of the different texts; docs: (doc_id, text, sha)."""
    texts = docs.groupBy("sha").agg(F.first("text").alias("text"), F.min("doc_id").alias("first_id"))
    words = texts.select("sha", "first_id", F.explode_outer(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word"))
    per = words.groupBy("sha", "first_id", "word").agg(F.count("word").alias("n"))
    return per.groupBy("sha", "first_id").agg(F.sum("n").alias("n_words"), F.count("word").alias("n_distinct"))


def failures(docs: DataFrame, labels: DataFrame, min_words: int = MIN_WORDS, least_distinct: int = LEAST_DISTINCT, most_upper: int = MOST_UPPER) -> DataFrame:
    """(doc_id, part, mask, good, toxic), a row per document; bit k of ``mask`` is a failure of filter k."""
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("sha"))
    totals = cut(word_totals(own.select("doc_id", "text", "sha")))
    upper = 100 * F.regexp_count("text", F.lit("[A-Z]")) > most_upper * F.char_length("text")
    flags = own.select("doc_id", "part", "sha", upper.alias("c"), F.col("text").rlike(SYMBOLS).alias("d"))
    known = cut(labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    both = flags.join(totals.hint("merge"), "sha", "left").join(known.hint("merge"), F.col("doc_id") == F.col("id"), "left")
    tests = (F.col("n_words") < min_words, 100 * F.col("n_distinct") < least_distinct * F.col("n_words"), F.col("c"), F.col("d"), F.coalesce(F.col("first_id") < F.col("doc_id"), F.lit(False)))
    mask = sum((F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)), F.lit(0))
    return both.select("doc_id", "part", mask.alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def kept_by_set(rows: DataFrame) -> DataFrame:
    """(part, n, good, toxic): per part, three arrays of 32 numbers: documents that fail no filter of each set."""
    per = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    columns = [F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(s) == 0, F.col(c))), F.lit(0)).alias(f"{c}_{s}") for c in ("n", "good", "toxic") for s in range(ALL + 1)]
    return per.groupBy("part").agg(*columns).select("part", *[F.array(*[f"{c}_{s}" for s in range(ALL + 1)]).alias(c) for c in ("n", "good", "toxic")])


def _shapley(bit: int) -> Column:
    """A filter's removals summed over all orders: each set before it comes in |S|! (4 - |S|)! of them."""
    at = lambda s: F.col("n")[s]
    before = [s for s in range(ALL + 1) if not s & bit]
    return sum((F.lit(factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count())) * (at(s) - at(s | bit)) for s in before), F.lit(0)).cast("long")


def audit(docs: DataFrame, labels: DataFrame, min_words: int = MIN_WORDS, least_distinct: int = LEAST_DISTINCT, most_upper: int = MOST_UPPER) -> DataFrame:
    """A row per part, order of the filters and step, with the effect of the step's filter there.

    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality and toxic.
    """
    kept = kept_by_set(failures(docs, labels, min_words, least_distinct, most_upper))
    shares = kept.withColumn("shapleys", F.array(*[_shapley(1 << k) for k in range(len(FILTERS))]))
    steps = shares.withColumn("filter_order", F.explode(F.array(*[F.lit(o) for o in ORDERS]))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    before = sum((F.when(F.col("step") > k, F.expr(f"shiftleft(1, ascii(substring(filter_order, {k}, 1)) - {ord(FILTERS[0])})")).otherwise(0) for k in range(1, len(FILTERS))), F.lit(0))
    own = F.expr(f"shiftleft(1, ascii(substring(filter_order, step, 1)) - {ord(FILTERS[0])})")
    steps = steps.withColumns({"before": before, "own": own}).withColumn("after", F.col("before") + F.col("own"))
    at = lambda c, s: F.element_at(c, s + 1)
    lost = lambda c: at(c, F.col("before")) - at(c, F.col("after"))
    fails = at("n", F.lit(0)) - at("n", F.col("own"))
    return steps.select(
        "part",
        "filter_order",
        "step",
        at("n", F.col("after")).alias("kept"),
        lost("n").alias("removed"),
        (fails - lost("n")).alias("redundant"),
        (at("n", F.lit(ALL) - F.col("own")) - at("n", F.lit(ALL))).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.element_at("shapleys", F.expr(f"ascii(substring(filter_order, step, 1)) - {ord(FILTERS[0]) - 1}")).alias("shapley"),
    )


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    """The audit of all documents by source."""
    from quorumtext.runtime import table

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
    l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
    f AS (SELECT part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(first_id < w.doc_id, false)] AS f,
                 coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
    m AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, f),
    x AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
    o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS p FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
    r AS (SELECT part, p, x.k AS step, p[x.k] AS own, n, good, toxic, f[p[x.k]] AS fails, list_bool_or(list_transform(p[1:x.k - 1], lambda i: f[i])) AS gone, len(list_filter(f, lambda v: v)) AS n_fails FROM m, o, x),
    s AS (SELECT part, p, step, own,
            sum(CASE WHEN NOT fails AND NOT coalesce(gone, false) THEN n ELSE 0 END) AS kept,
            sum(CASE WHEN fails AND NOT coalesce(gone, false) THEN n ELSE 0 END) AS removed,
            sum(CASE WHEN fails AND coalesce(gone, false) THEN n ELSE 0 END) AS redundant,
            sum(CASE WHEN fails AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
            sum(CASE WHEN fails AND NOT coalesce(gone, false) THEN good ELSE 0 END) AS good_lost,
            sum(CASE WHEN fails AND NOT coalesce(gone, false) THEN toxic ELSE 0 END) AS toxic_lost
          FROM r GROUP BY ALL)
    SELECT part, array_to_string(list_transform(p, lambda i: chr(CAST(64 + i AS INTEGER))), '') AS filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
    FROM s
"""
