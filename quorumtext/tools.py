"""Command lines over an archive.

``python -m quorumtext.tools check ROOT OUT.md [name=FILE ...]`` runs all checks over every recording
and writes the review report: a row for each recording, also a clean one. Files may be ``lexicon`` (a word a
line), ``reviewed`` (JSON lines of video_id, check, evidence, reason: harmless findings) and ``captions``
(JSON lines of video_id, t0, text).
``python -m quorumtext.tools recheck ROOT OUT.md STATE [name=FILE ...]`` does the same, but
runs the checks only for recordings whose files, or what they are checked against, have changed since STATE was written.
``python -m quorumtext.tools index ROOT PAGE LOCALE`` puts the index and the topics between
their markers in a page, in English (en) or Malay (ms).
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumtext.operators import alignment, loops, quality, turns
from quorumtext.runtime import cut, ship_package
from quorumtext.sources import archive, publish

CHECKS = ("repeat", "order", "figure", "word", "name", "credit", "length", "speaker", "missing", "model_note", "orphan")
# Neutral defaults: what has no published value.
PHRASES = ("subtitles by", "captions by", "sari kata oleh", "transcribed by")
RATIO = (0.4, 1.3)
MISSING = 0.2


def findings(files: DataFrame, reviewed: DataFrame | None = None, lexicon: DataFrame | None = None, captions: DataFrame | None = None) -> DataFrame:
    """(video_id, layer, seq, check, severity, evidence) of all checks; ``files`` with headers.

    ``lexicon``: (word); ``captions``: (video_id, t0, text); ``reviewed``: (video_id, check, evidence).
    Published layers are checked against the raw one of their recording, where there is one.
    """
    said = archive.turns(files).withColumn("start_sec", F.col("start_sec").cast("int"))
    said = cut(said)
    raw, told = said.where("layer = 'raw'"), said.where("layer <> 'raw'")
    both = told.join(raw.select("video_id").distinct(), "video_id", "left_semi")

    def of(df: DataFrame, check: str, evidence: Column) -> DataFrame:
        place = [F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in (("layer", "string"), ("seq", "int"))]
        return df.select("video_id", *place, evidence.alias("_e")).select(*quality.finding(check, "flag", "_e"))

    rated = turns.speaking_rate(said, ["video_id", "layer"], "seq", "start_sec", "text")
    looped = rated.select("video_id", "layer", "seq", "rate", F.explode(loops.loops_of("text")).alias("x"))
    decided = quality.loop_decision(F.col("x.repeats"), F.col("rate"), F.lit(None).cast("double"))
    found = looped.select("video_id", "layer", "seq", F.lit("repeat").alias("check"), decided.alias("severity"), F.concat("x.phrase", F.lit(" x "), F.col("x.repeats").cast("string")).alias("evidence"))
    faults = turns.order_faults(said.where("start_sec IS NOT NULL"), ["video_id", "layer"], "seq", "start_sec").where("n_decreases > 0")
    found = found.unionByName(of(faults, "order", F.col("n_decreases").cast("string")))
    found = found.unionByName(of(quality.figures_absent(both, raw, ["video_id"]), "figure", F.col("figure")))
    found = found.unionByName(of(quality.names_absent(both, raw, ["video_id"]), "name", F.col("name")))
    if lexicon is not None:
        found = found.unionByName(of(quality.lexicon_leaks(both, raw, lexicon, ["video_id"]), "word", F.col("word")))
    credits = said.select("video_id", "layer", "seq", F.explode(quality.credit_lines("text", list(PHRASES))).alias("line"))
    found = found.unionByName(of(credits, "credit", F.col("line")))
    ratios = turns.layer_ratio(raw.withColumn("of", F.lit(1)), both, ["video_id"], "text")
    per_layer = both.groupBy("video_id", "layer").agg(F.sum("n_words").alias("own")).join(ratios.select("video_id", "words_a"), "video_id")
    per_layer = per_layer.withColumn("ratio", F.round(F.col("own") / F.nullif(F.col("words_a"), F.lit(0)), 3))
    found = found.unionByName(of(per_layer.where(~F.coalesce(F.col("ratio").between(*RATIO), F.lit(False))), "length", F.coalesce(F.col("ratio").cast("string"), F.lit("no words"))))
    strangers = told.select("video_id", "layer", "speaker").distinct().join(said.where("layer = 'raw'").select("video_id", "speaker").distinct(), ["video_id", "speaker"], "left_anti")
    strangers = strangers.join(raw.select("video_id").distinct(), "video_id", "left_semi")
    found = found.unionByName(of(strangers, "speaker", F.col("speaker")))
    if captions is not None:
        shown = captions.withColumn("seq", F.col("t0").cast("double")).select("video_id", "seq", "text")
        shown = shown.join(raw.select("video_id").distinct(), "video_id", "left_semi")
        gone = alignment.missing_by_turn(shown, raw.withColumn("seq", F.col("seq").cast("double")), ["video_id"]).groupBy("video_id").agg((F.sum("n_missing") / F.nullif(F.sum("n_words"), F.lit(0))).alias("share"))
        found = found.unionByName(of(gone.where(F.col("share") > MISSING), "missing", F.round("share", 3)))
    found = found.unionByName(quality.model_notes(said, archive.orphans(files)))
    return quality.without_reviewed(found, reviewed) if reviewed is not None else found


def report(found: DataFrame, recordings: DataFrame) -> DataFrame:
    """A row per recording (video_id): findings of each check, all of them, and how many ask for removal; zeros where there is nothing."""
    per = quality.rollup(found, list(CHECKS)).join(found.groupBy("video_id").agg(F.count_if(F.col("severity") == "remove").alias("n_remove")), "video_id")
    names = [*CHECKS, "n_findings", "n_remove"]
    out = recordings.select("video_id").where("video_id IS NOT NULL").distinct().join(per, "video_id", "left")
    return out.select("video_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])


def report_text(rows: DataFrame) -> str:
    n, flagged = rows.agg(F.count(F.lit(1)), F.count_if(F.col("n_findings") > 0)).first()
    return f"{flagged} of {n} recordings carry a finding. A row without one means that no known failure was found, not that it is verified.\n\n{publish.report_page(rows)}\n"


def _inputs(spark: SparkSession, args: tuple[str, ...]) -> dict[str, DataFrame]:
    got = dict(a.split("=", 1) for a in args)
    if unknown := set(got) - {"lexicon", "reviewed", "captions"}:
        raise SystemExit(f"unknown: {', '.join(sorted(unknown))}\n{__doc__}")
    out = {k: spark.read.json(v) for k, v in got.items() if k != "lexicon"}
    if "lexicon" in got:
        out["lexicon"] = spark.read.text(got["lexicon"]).where("trim(value) <> ''").select(F.trim("value").alias("word"))
    return out


def check(spark: SparkSession, root: str, out: str, *args: str) -> None:
    """Write the report of all recordings under ``root``."""
    ship_package(spark)
    files = archive.with_headers(archive.scan_layers(spark, root))
    rows = report(cut(findings(files, **_inputs(spark, args))), files.select("header.video_id"))
    Path(out).write_text(report_text(rows), encoding="utf-8")


def fingerprints(files: DataFrame, against: list[DataFrame]) -> DataFrame:
    """(folder, print): a hash of each recording's files, and of all rows it is checked against."""
    other = 0
    for df in against:
        other ^= df.agg(F.bit_xor(F.xxhash64(F.to_json(F.struct(*sorted(df.columns)))))).first()[0] or 0
    folder = F.regexp_replace("path", "/[^/]*$", "")
    per = files.groupBy(folder.alias("folder")).agg(F.array_sort(F.collect_list(F.struct("layer", F.sha2("text", 256).alias("sha")))).alias("x"))
    return per.select("folder", F.sha2(F.concat(F.to_json("x"), F.lit(str(other))), 256).alias("print"))


def recheck(spark: SparkSession, root: str, out: str, state: str, *args: str) -> list[str]:
    """Bring the findings under ``state`` up to date and write the report; the folders that were checked, in order.

    Findings lie by recording; those of a checked recording replace its own and no other's. Its new
    hash is written last, in a version of its own, so a run that breaks off is done again whole.
    """
    ship_package(spark)
    given = _inputs(spark, args)
    files = cut(archive.scan_layers(spark, root))
    now = cut(fingerprints(files, [given[k] for k in sorted(given)]))
    version = _latest(spark, f"{state}/prints")
    before = spark.read.parquet(f"{state}/prints/{version}") if version else now.limit(0)
    changed = cut(now.join(before, ["folder", "print"], "left_anti").select("folder"))
    names = [r.folder for r in changed.orderBy("folder").toLocalIterator()]
    folder = F.regexp_replace("path", "/[^/]*$", "")
    if names:
        own = archive.with_headers(files.withColumn("folder", folder).join(changed, "folder", "left_semi"))
        found = findings(own.drop("folder"), **given)
        where = own.select("folder", "header.video_id").where("video_id IS NOT NULL").distinct()
        rows = where.join(found, "video_id", "left")  # a clean recording has a row without a check
        publish.write_partitioned(rows.withColumn("recording", F.md5("folder")), f"{state}/findings", ["recording"])
    if names or now.count() != before.count():
        now.write.parquet(f"{state}/prints/{version + 1}")
    rows = spark.read.parquet(f"{state}/findings").join(now, "folder", "left_semi") if _latest(spark, f"{state}/prints") else None
    if rows is not None and now.count():
        Path(out).write_text(report_text(report(rows.where("check IS NOT NULL").drop("folder", "recording"), rows)), encoding="utf-8")
    return names


def _latest(spark: SparkSession, path: str) -> int:
    """The largest version under ``path`` that was written to its end, or 0."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = there.getFileSystem(spark._jsc.hadoopConfiguration())
    done = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS")) or []
    return max((int(m[1]) for s in done if (m := re.search(r"/(\d+)/_SUCCESS$", s.getPath().toString()))), default=0)


def index(spark: SparkSession, root: str, page: str, locale: str = "en") -> None:
    """Replace the blocks INDEX and TOPICS of ``page``; doing it again changes nothing."""
    ship_package(spark)
    files = archive.with_headers(archive.scan_layers(spark, root)).persist()
    episodes, layers = archive.episodes(files), archive.layers(files)
    text = Path(page).read_text(encoding="utf-8")
    text = publish.splice(text, "INDEX", publish.index_page(episodes, layers, locale))
    text = publish.splice(text, "TOPICS", publish.topic_page(episodes))
    files.unpersist()
    Path(page).write_text(text, encoding="utf-8")


def main(args: list[str]) -> None:
    command = {"check": (check, 3), "recheck": (recheck, 4), "index": (index, 3)}.get(args[0] if args else "")
    if command is None or len(args) < command[1]:
        sys.exit(__doc__)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    command[0](spark, *args[1:])


if __name__ == "__main__":
    main(sys.argv[1:])
