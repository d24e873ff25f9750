"""Analytics and assembly of speaker turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumtext.functions.text import n_words

UNKNOWN = "Speaker ?"


def speaker_share(turns: DataFrame, key: list[str], speaker: str, text: str) -> DataFrame:
    """Turns, words and share of the words per speaker within ``key``.

    The first aggregation combines before the shuffle; the share is then a window over one
    row per speaker. A recording without words has a null share.
    """
    per = turns.groupBy(*key, speaker).agg(F.count(F.lit(1)).alias("n_turns"), F.sum(n_words(text)).alias("n_words"))
    total = F.sum("n_words").over(Window.partitionBy(*key))
    return per.withColumn("share", F.round(F.col("n_words") / F.nullif(total, F.lit(0)), 6))


def transitions(turns: DataFrame, key: list[str], order: str, speaker: str) -> DataFrame:
    """How often each speaker follows each other one in the next turn."""
    before = F.lag(speaker).over(Window.partitionBy(*key).orderBy(order))
    pairs = turns.select(before.alias("from_speaker"), F.col(speaker).alias("to_speaker")).where("from_speaker IS NOT NULL")
    return pairs.groupBy("from_speaker", "to_speaker").agg(F.count(F.lit(1)).alias("n"))


def islands(turns: DataFrame, key: list[str], order: list[str], speaker: str) -> DataFrame:
    """``turns`` with ``island``: the number, within ``key``, of its run of equal speakers."""
    w = Window.partitionBy(*key).orderBy(*order)
    new = F.when(F.lag(speaker).over(w).eqNullSafe(F.col(speaker)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return turns.withColumn("_new", new).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def build_turns(words: DataFrame, key: list[str], order: list[str], speaker: str, start: str, text: str) -> DataFrame:
    """Maximal runs of one speaker: first start, text joined in order, number of words."""
    item = F.struct(*order, F.col(text).alias("_text"))
    per = islands(words, key, order, speaker).groupBy(*key, "island").agg(F.first(speaker).alias(speaker), F.min(start).alias(start), F.array_sort(F.collect_list(item)).alias("_items"))
    return per.select(*key, F.col("island").alias("seq"), F.coalesce(F.col(speaker), F.lit(UNKNOWN)).alias(speaker), start, F.array_join(F.transform("_items", lambda x: x["_text"]), " ").alias(text), F.size("_items").alias("n_words"))


def order_faults(turns: DataFrame, key: list[str], order: str, start: str) -> DataFrame:
    """Per recording: ties and decreases of the start time in turn order, and rows."""
    before = F.lag(start).over(Window.partitionBy(*key).orderBy(order))
    marked = turns.select(*key, (F.col(start) == before).cast("int").alias("tie"), (F.col(start) < before).cast("int").alias("back"))
    return marked.groupBy(*key).agg(F.count(F.lit(1)).alias("n_turns"), F.coalesce(F.sum("tie"), F.lit(0)).alias("n_ties"), F.coalesce(F.sum("back"), F.lit(0)).alias("n_decreases"))


def speaking_rate(turns: DataFrame, key: list[str], order: str, start: str, text: str) -> DataFrame:
    """``turns`` with n_words and words per second up to the next turn's start; null without a later start."""
    seconds = F.lead(start).over(Window.partitionBy(*key).orderBy(order)) - F.col(start)
    return turns.withColumn("n_words", n_words(text)).withColumn("rate", F.when(seconds > 0, F.col("n_words") / seconds))


def layer_ratio(a: DataFrame, b: DataFrame, key: list[str], text: str) -> DataFrame:
    """Words of layer ``b`` per word of layer ``a``, by ``key``; recordings that both have."""
    count = lambda t, name: t.groupBy(*key).agg(F.sum(n_words(text)).alias(name))
    return count(a, "words_a").join(count(b, "words_b"), key).withColumn("ratio", F.round(F.col("words_b") / F.nullif(F.col("words_a"), F.lit(0)), 6))


def with_aliases(turns: DataFrame, aliases: DataFrame, speaker: str, max_aliases: int = 100_000) -> DataFrame:
    """Speakers by their canonical names; ``aliases`` (alias, canonical) is broadcast only up to ``max_aliases`` rows."""
    small = aliases.select(F.col("alias").alias("_alias"), F.col("canonical").alias("_name")).dropDuplicates(["_alias"])
    if small.limit(max_aliases + 1).count() <= max_aliases:
        small = F.broadcast(small)
    return turns.join(small, F.col(speaker) == F.col("_alias"), "left").withColumn(speaker, F.coalesce("_name", speaker)).drop("_alias", "_name")


def coalesced(*labels: str | Column) -> Column:
    """The first label there is, in order of precedence, else the unknown speaker."""
    return F.coalesce(*[F.col(x) if isinstance(x, str) else x for x in labels], F.lit(UNKNOWN))
