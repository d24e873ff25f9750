"""Checks of published layers against their originals; all return one schema of findings.

A finding is (video_id, layer, seq, check, severity, evidence). Thresholds and word lists
that have no published value are parameters with neutral defaults.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.functions.text import figures, n_words, words
from quorumtext.runtime import cut

LOOP_REPEATS, LOOP_RATE, LOOP_SPEECH, LOOP_LONG = 10, 7.0, 0.20, 25


def finding(check: str, severity: str, evidence: str | Column, seq: str | None = "seq") -> list[Column]:
    """The columns of a finding."""
    e = F.col(evidence) if isinstance(evidence, str) else evidence
    return [F.col("video_id"), F.col("layer"), (F.col(seq) if seq else F.lit(None)).cast("int").alias("seq"), F.lit(check).alias("check"), F.lit(severity).alias("severity"), e.cast("string").alias("evidence")]


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """A dictionary, broadcast if it has at most ``most`` rows; else it joins as any table does."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def bare_words(text: str | Column) -> Column:
    """Distinct words, lower case, without punctuation around them."""
    return F.array_distinct(F.transform(words(text), lambda w: F.lower(F.regexp_replace(w, r"^\p{Punct}+|\p{Punct}+$", ""))))


def lexicon_leaks(published: DataFrame, raw: DataFrame, lexicon: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, word): listed words that a recording's published text has and its raw text lacks."""
    listed = small(lexicon.select(F.lower("word").alias("word")).distinct())
    tokens = lambda t: t.select(*key, F.explode(bare_words(text)).alias("word")).join(listed, "word", "left_semi").distinct()
    return tokens(published).join(tokens(raw), [*key, "word"], "left_anti")


def figures_absent(published: DataFrame, raw: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, figure): normalised figures of the published text that the raw text lacks."""
    found = lambda t: t.select(*key, F.explode(figures(text)).alias("figure")).distinct()
    return found(published).join(found(raw), [*key, "figure"], "left_anti")


NAME = r"\p{Lu}[\p{L}'.-]+(?: (?:bin|binti|bt|al|a/l|a/p)?\.? ?\p{Lu}[\p{L}'.-]+)+"


def names_in(texts: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, name): the different runs of two or more capitalised words."""
    run = F.lit(NAME + "+")  # possessive: nothing follows, and Java takes a stack frame for each word of a run otherwise
    return texts.select(*key, F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), run, F.lit(0))).alias("name")).distinct()


def names_absent(published: DataFrame, raw: DataFrame, key: list[str], text: str = "text", edits: int = 2, of_bytes: bool = False) -> DataFrame:
    """(key, name): names of the published text without one within ``edits`` edits in the raw text of the same key.

    Names that the raw text has as they are go first; the rest are looked up by segments, which
    misses no name that near, whatever letter it differs in. Edits are of characters, or of bytes in UTF-8.
    """
    from quorumtext.operators.fuzzy import within_edits

    known = names_in(raw, key, text)
    rest = cut(names_in(published, key, text).join(known, [*key, "name"], "left_anti"))
    alike = within_edits(rest.withColumnRenamed("name", "s"), known.withColumnRenamed("name", "s"), key, edits, of_bytes=of_bytes)
    return rest.join(alike.select(*key, F.col("s").alias("name")).distinct(), [*key, "name"], "left_anti")


def repeat_runs(rows: DataFrame, key: list[str], order: str, item: str, least: int = 2) -> DataFrame:
    """(key, first, item, repeats): maximal runs of one item in order, at least ``least`` long."""
    w = Window.partitionBy(*key).orderBy(order)
    new = F.when(F.lag(item).over(w) == F.col(item), 0).otherwise(1)
    runs = rows.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    per = runs.groupBy(*key, "_run").agg(F.min(order).alias("first"), F.first(item).alias("item"), F.count(F.lit(1)).alias("repeats"))
    return per.where(F.col("repeats") >= least).drop("_run")


def ngram_loops(texts: DataFrame, key: list[str], text: str = "text", least: int = 5) -> DataFrame:
    """(key, n, first, repeats, phrase): phrases of any length repeated back to back, first word of each run."""
    from quorumtext.operators.loops import loop_rows

    found = loop_rows(texts, key, text, least).where("unit = 'word'")
    return found.select(*key, F.col("period").alias("n"), "first", "repeats", "phrase")


def bare_words_in_order(text: str | Column) -> Column:
    return F.transform(words(text), lambda w: F.lower(F.regexp_replace(w, r"^\p{Punct}+|\p{Punct}+$", "")))


def loop_decision(repeats: Column, rate: Column, speech: Column) -> Column:
    """``remove`` for long and implausible runs, else ``flag``; unknown rate or speech never argues for removal."""
    odd = F.coalesce(rate > LOOP_RATE, F.lit(False)) | F.coalesce(speech < LOOP_SPEECH, F.lit(False)) | (repeats >= LOOP_LONG)
    return F.when((repeats >= LOOP_REPEATS) & odd, "remove").otherwise("flag")


def without_loop(words_in_order: Column, first: Column, n: Column, repeats: Column) -> Column:
    """Words without a loop: its repeats and a part-repeat behind them go, the first instance stays."""
    phrase = F.slice(words_in_order, first + 1, n)
    tail_at = first + n * repeats

    def goes_on(k: Column) -> Column:
        return F.forall(F.sequence(F.lit(0), k - 1), lambda i: F.try_element_at(words_in_order, (tail_at + i + 1).cast("int")).eqNullSafe(F.try_element_at(phrase, (i + 1).cast("int"))))

    part = F.when(n > 1, F.coalesce(F.array_max(F.filter(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), goes_on)), F.lit(0))).otherwise(0)
    return F.concat(F.slice(words_in_order, 1, first + n), F.slice(words_in_order, (tail_at + part + 1).cast("int"), F.size(words_in_order)))


def credit_lines(text: str | Column, phrases: list[str]) -> Column:
    """Lines with one of the phrases and a link."""
    said = "|".join(rf"\Q{p}\E" for p in phrases)
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: x.rlike(f"(?i){said}") & x.rlike(r"(?i)(?:https?://|www\.)\S|\b[a-z0-9-]+\.(?:com|org|net)\b"))


def model_notes(turns: DataFrame, orphans: DataFrame) -> DataFrame:
    """Findings: bracketed notes about the text itself, and body text before any turn."""
    note = r"(?i)[\[(](?:note|nota|translator|penterjemah|transcript|transkrip|unclear|tidak jelas|inaudible)[^\])]*[\])]"
    spans = turns.withColumn("_e", F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(note), F.lit(0))))
    return spans.select(*finding("model_note", "flag", "_e")).unionByName(orphans.select(*finding("orphan", "flag", "text", None)))


def language_density(text: str | Column, lexicon: list[str]) -> Column:
    """Share of a text's words that are in a lexicon; null without words."""
    return F.element_at(F.array(_listed(text, lexicon) / F.nullif(n_words(text), F.lit(0))), 1)


def language_densities(text: str | Column, lexicons: dict[str, list[str]]) -> Column:
    """A struct with the share of each lexicon, for short ones; a table of words is what ``lexicon_densities`` takes."""
    return F.struct(*[language_density(text, v).alias(k) for k, v in lexicons.items()])


def _listed(text: str | Column, lexicon: list[str]) -> Column:
    """Number of words that are listed, case and punctuation around them aside: one pattern over the whole text."""
    c = F.col(text) if isinstance(text, str) else text
    known = sorted({x.lower() for x in lexicon if x and not set(x) & set(" \t\n\r\f\x0b") and x == x.strip(string.punctuation)})
    if not known:
        return F.lit(0)
    said = "|".join(rf"\Q{x}\E" for x in known)
    return F.coalesce(F.regexp_count(F.lower(c), F.lit(rf"(?<![^ \t\n\r\f\x0B])\p{{Punct}}*+(?:{said})\p{{Punct}}*+(?![^ \t\n\r\f\x0B])")), F.lit(0))


def lexicon_densities(texts: DataFrame, key: list[str], lexicon: DataFrame, text: str = "text") -> DataFrame:
    """(key, lang, n_listed, n_words, density) for each key with words and each language of a lexicon (word, lang) of any size.

    Words are counted by key first, before any shuffle; the lexicon is broadcast if its rows are few, else joined.
    """
    tokens = texts.select(*key, F.explode(bare_words_in_order(text)).alias("word")).groupBy(*key, "word").agg(F.count(F.lit(1)).alias("_n"))
    total = tokens.groupBy(*key).agg(F.sum("_n").alias("n_words"))
    listed = lexicon.select(F.lower("word").alias("word"), "lang").na.drop().distinct()
    hits = tokens.join(small(listed), "word").groupBy(*key, "lang").agg(F.sum("_n").alias("n_listed"))
    out = total.join(F.broadcast(listed.select("lang").distinct())).join(hits, [*key, "lang"], "left")
    return out.select(*key, "lang", F.coalesce("n_listed", F.lit(0)).alias("n_listed"), "n_words", (F.coalesce("n_listed", F.lit(0)) / F.col("n_words")).alias("density"))


def longest_run(items: Column) -> Column:
    """The most times that one item stands back to back in an array; 0 in an empty one."""
    start = F.struct(F.lit(None).cast("string").alias("item"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(s["item"].eqNullSafe(x) & (s["run"] > 0), s["run"] + 1).otherwise(1)
        return F.struct(x.alias("item"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(items, start, step, lambda s: s["best"])


def coverage(turns: DataFrame, captions: DataFrame, bucket: int = 60) -> DataFrame:
    """Per recording: buckets of time that have captions, and the share of these that has a turn's words.

    Recordings without captions have a null share.
    """
    t = turns.where("start_sec IS NOT NULL").select("video_id", F.floor(F.col("start_sec") / bucket).alias("b")).distinct().withColumn("said", F.lit(1))
    c = captions.select("video_id", F.floor(F.col("t0") / bucket).alias("b")).distinct().withColumn("shown", F.lit(1))
    both = t.join(c, ["video_id", "b"], "full_outer")
    return both.groupBy("video_id").agg(F.count("shown").alias("n_shown"), F.count_if(F.col("said").isNotNull() & F.col("shown").isNotNull()).alias("n_both")).withColumn("share", F.col("n_both") / F.nullif(F.col("n_shown"), F.lit(0)))


def nearest_caption(turns: DataFrame, captions: DataFrame) -> DataFrame:
    """``turns`` with ``caption_t0``, the latest caption start at or before the turn's (as-of join).

    Both sides become one ordered stream per recording, so nothing is compared pairwise.
    """
    a = turns.select("video_id", "layer", "seq", F.col("start_sec").cast("double").alias("at"), F.lit(None).cast("double").alias("c"))
    b = captions.select("video_id", F.lit(None).cast("string").alias("layer"), F.lit(None).cast("int").alias("seq"), F.col("t0").cast("double").alias("at"), F.col("t0").cast("double").alias("c"))
    w = Window.partitionBy("video_id").orderBy("at", F.col("c").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b).withColumn("caption_t0", F.last("c", True).over(w)).where("layer IS NOT NULL")
    return turns.join(both.select("video_id", "layer", "seq", "caption_t0"), ["video_id", "layer", "seq"], "left")


def segment_gates(published: DataFrame, raw: DataFrame, size: int = 20, low: float = 0.4, high: float = 1.3, lexicon: list[str] | None = None, least_density: float = 0.0) -> DataFrame:
    """Per (video_id, segment of ``size`` turns): length ratio, density, figures kept, speakers kept, and whether all pass."""

    def side(t: DataFrame, name: str) -> DataFrame:
        s = t.withColumn("segment", F.floor((F.col("seq") - 1) / size))
        return s.groupBy("video_id", "segment").agg(F.sum(n_words("text")).alias(f"words_{name}"), F.array_distinct(F.flatten(F.collect_list(figures("text")))).alias(f"fig_{name}"), F.collect_set("speaker").alias(f"spk_{name}"), F.concat_ws(" ", F.collect_list("text")).alias(f"text_{name}"))

    both = side(published, "p").join(side(raw, "r"), ["video_id", "segment"])
    density = language_density("text_p", lexicon) if lexicon else F.lit(1.0)
    out = both.select("video_id", "segment", (F.col("words_p") / F.nullif(F.col("words_r"), F.lit(0))).alias("ratio"), density.alias("density"), (F.size(F.array_except("fig_p", "fig_r")) == 0).alias("figures_kept"), (F.size(F.array_except("spk_p", "spk_r")) == 0).alias("speakers_kept"))
    return out.withColumn("passes", F.coalesce(F.col("ratio").between(low, high) & (F.col("density") >= least_density) & F.col("figures_kept") & F.col("speakers_kept"), F.lit(False)))


def without_reviewed(findings: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Findings that nobody has marked as harmless (by recording, check and evidence)."""
    r = reviewed.select("video_id", "check", "evidence").distinct()
    return findings.join(r, ["video_id", "check", "evidence"], "left_anti")


def rollup(findings: DataFrame, checks: list[str], key: str = "video_id") -> DataFrame:
    """One row per recording: findings of each check, and all."""
    return findings.groupBy(key).agg(*[F.count_if(F.col("check") == c).alias(c) for c in checks], F.count(F.lit(1)).alias("n_findings"))


def without_phrase(text: str | Column, phrase: str) -> Column:
    """The text without a fixed sentence."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, rf"\Q{phrase}\E", ""), " {2,}", " "))


def admitted(episodes: DataFrame, least_seconds: int = 3600) -> DataFrame:
    """Full episodes only."""
    return episodes.where(F.col("duration_seconds") >= least_seconds)
