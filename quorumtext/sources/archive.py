"""Readers of an archive of layered transcripts: files, headers, turns, orphans, index tables.

Layout: ``<root>/<show>/<date>-ep<NN>-<slug>/<layer>.md``. A file is a YAML header between
two ``---`` lines, perhaps a navigation block, a heading, and turns: ``[mm:ss] Speaker: text``
in the raw layer, ``**Speaker:** text`` with continuation paragraphs in the others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumtext.functions.text import clock_seconds, n_words

# The format's patterns.
RAW_TURN = r"^\[((?:\d+:)?\d{1,2}:\d{2})\] ([^:]{1,60}): (.*)$"
INTERVIEW_TURN = r"^\*\*([^*]{1,80}?):\*\* ?(.*)$"
NAV_OPEN, NAV_CLOSE = "<!-- nav -->", "<!-- /nav -->"
EPISODE_DIR = r"/([^/]+)/(\d{4}-\d{2}-\d{2})-ep(\d+)-([^/]*)/([^/]+)\.md$"

HEADER = "title string, video_id string, youtube_url string, channel string, publish_date string, duration_seconds int, duration string, view_count long, note string, model string, hosts array<string>, guests array<string>, topics array<string>, summary string, language string"
_FIELDS = [f.split(" ") for f in HEADER.split(", ")]


def scan_layers(spark: SparkSession, root: str) -> DataFrame:
    """(path, show, dir_date, ep, slug, layer, text): one row per layer file.

    The root is listed once, recursively, rather than globbed path by path.
    """
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    part = lambda i: F.regexp_extract(path, EPISODE_DIR, i)
    rows = files.select(path.alias("path"), part(1).alias("show"), F.try_to_date(part(2), "yyyy-MM-dd").alias("dir_date"), part(3).try_cast("int").alias("ep"), part(4).alias("slug"), part(5).alias("layer"), F.col("value").alias("text"))
    return rows.where("show <> ''")


def _scalar(text: str) -> str:
    text = text.strip()
    if len(text) > 1 and text[0] == text[-1] == "'":
        return text[1:-1].replace("''", "'")
    if len(text) > 1 and text[0] == text[-1] == '"':
        return text[1:-1]
    return text


def parse_header(text: str | None) -> dict[str, object]:
    """The header's fields: plain and quoted scalars, folded lines, block and flow lists."""
    found: dict[str, object] = {}
    lines = (text or "").split("\n")
    if not lines or lines[0].strip() != "---":
        return found
    key, parts = None, []

    def close() -> None:
        if key is not None and not isinstance(found.get(key), list):
            joined = ""
            for p in parts:  # a blank line inside a folded scalar stands for a line feed
                joined += "\n" if not p else ("" if not joined or joined.endswith("\n") else " ") + p
            value = _scalar(joined)
            found[key] = [_scalar(x) for x in value[1:-1].split(",") if x.strip()] if value.startswith("[") and value.endswith("]") else value

    for line in lines[1:]:
        if line.rstrip() == "---":
            break
        item = re.match(r"^\s*- (.*)$", line)
        field = re.match(r"^([A-Za-z_]+):(?: (.*))?$", line)
        if field:
            close()
            key, parts = field[1], [field[2].strip()] if field[2] else []
        elif item and key is not None and not parts:
            found.setdefault(key, []).append(_scalar(item[1]))
        elif key is not None and isinstance(found.get(key), list) and line.strip():
            found[key][-1] = _scalar(f"{found[key][-1]} {line.strip()}")
        elif key is not None:
            parts.append(line.strip())
    close()
    return found


def with_headers(files: DataFrame) -> DataFrame:
    """``files`` with the column ``header``; a field that is absent or of another kind is null."""

    def parsed(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for t in texts:
            rows = []
            for x in t:
                h = parse_header(x)
                row = []
                for name, kind in _FIELDS:
                    v = h.get(name)
                    if kind.startswith("array"):
                        v = v if isinstance(v, list) else None
                    elif kind in ("int", "long"):
                        v = int(v) if isinstance(v, str) and re.fullmatch(r"-?\d+", v) else None
                    elif not isinstance(v, str):
                        v = None
                    row.append(v)
                rows.append(row)
            yield pd.DataFrame(rows, columns=[n for n, _ in _FIELDS], dtype=object)

    return files.withColumn("header", F.pandas_udf(parsed, HEADER)("text"))


def episodes(files: DataFrame) -> DataFrame:
    """One row per recording, from its fullest header; ``files`` with headers."""
    w = Window.partitionBy("header.video_id").orderBy(F.col("header.topics").isNull(), "layer")
    one = files.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    h = "header."
    return one.select(h + "video_id", "show", "ep", h + "title", h + "youtube_url", h + "channel", F.try_to_date(F.col(h + "publish_date"), "yyyy-MM-dd").alias("publish_date"), h + "duration_seconds", h + "duration", h + "hosts", h + "guests", h + "topics", h + "summary")


def layers(files: DataFrame) -> DataFrame:
    """One row per file: what belongs to the layer and not to the recording."""
    return files.select("header.video_id", "layer", "path", "header.language", F.split("header.model", r",\s*").alias("models"), "header.note", "header.view_count", F.col("text").contains(NAV_OPEN).alias("has_nav"))


def _body(files: DataFrame) -> DataFrame:
    """(video_id, layer, line, value): body lines behind the header, without navigation, heading and blank lines."""
    keep = files.select(F.col("header.video_id").alias("video_id"), "layer", F.posexplode(F.split("text", "\n", -1)).alias("line", "value")).withColumn("line", F.col("line") + 1)
    w = Window.partitionBy("video_id", "layer").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    seen = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).over(w)
    marked = keep.withColumns({"_rule": seen(F.rtrim("value") == "---"), "_open": seen(F.trim("value") == NAV_OPEN), "_shut": seen(F.trim("value") == NAV_CLOSE)})
    inside = (F.col("_rule") >= 2) & (F.rtrim("value") != "---") & (F.col("_open") == F.col("_shut")) & (F.trim("value") != NAV_CLOSE)
    return marked.where(inside & (F.trim("value") != "") & ~F.col("value").rlike(r"^# ")).select("video_id", "layer", "line", "value")


def _grouped(files: DataFrame) -> DataFrame:
    w = Window.partitionBy("video_id", "layer").orderBy("line")
    raw, talk = F.col("value").rlike(RAW_TURN) & (F.col("layer") == "raw"), F.col("value").rlike(INTERVIEW_TURN)
    return _body(files).withColumn("_new", raw | talk).withColumn("_turn", F.sum(F.col("_new").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def turns(files: DataFrame) -> DataFrame:
    """(video_id, layer, seq, line, start_sec, speaker, text, n_paragraphs, n_words); continuations are folded in."""
    item = F.struct("line", "value")
    per = _grouped(files).where("_turn > 0").groupBy("video_id", "layer", "_turn").agg(F.min("line").alias("line"), F.array_sort(F.collect_list(item)).alias("_parts"))
    head = F.col("_parts")[0]["value"]
    raw = head.rlike(RAW_TURN) & (F.col("layer") == "raw")
    first = F.when(raw, F.regexp_extract(head, RAW_TURN, 3)).otherwise(F.regexp_extract(head, INTERVIEW_TURN, 2))
    rest = F.transform(F.slice("_parts", 2, F.size("_parts")), lambda p: p["value"])
    text = F.array_join(F.concat(F.array(first), rest), "\n\n")
    out = per.select("video_id", "layer", F.col("_turn").cast("int").alias("seq"), "line", F.when(raw, clock_seconds(F.regexp_extract(head, RAW_TURN, 1))).alias("start_sec"), F.when(raw, F.regexp_extract(head, RAW_TURN, 2)).otherwise(F.regexp_extract(head, INTERVIEW_TURN, 1)).alias("speaker"), text.alias("text"), F.size("_parts").alias("n_paragraphs"))
    return out.withColumn("n_words", n_words("text"))


def orphans(files: DataFrame) -> DataFrame:
    """(video_id, layer, line, text): body text before the first turn."""
    return _grouped(files).where("_turn = 0").select("video_id", "layer", "line", F.col("value").alias("text"))


def index_rows(text: DataFrame, locale: str) -> DataFrame:
    """Rows of Markdown indexes (column ``text``, one file a row): cells split at bars that are not escaped.

    Sections are carried down inside each file's own lines, so files never mix.
    """
    head = lambda v: v.rlike("^#+ ")
    start = F.struct(F.lit(0).alias("line"), F.lit(None).cast("string").alias("section"), F.array().cast("array<struct<line:int,section:string,value:string>>").alias("rows"))

    def grow(s: Column, v: Column) -> Column:
        section = F.when(head(v), F.regexp_replace(v, "^#+ ", "")).otherwise(s["section"])
        row = F.struct((s["line"] + 1).alias("line"), section.alias("section"), v.alias("value"))
        listed = v.rlike(r"^\| *\d+ *\|")
        return F.struct((s["line"] + 1).alias("line"), section.alias("section"), F.when(listed, F.concat(s["rows"], F.array(row))).otherwise(s["rows"]).alias("rows"))

    heads = text.select(F.explode(F.aggregate(F.split(F.coalesce("text", F.lit("")), "\n", -1), start, grow, lambda s: s["rows"])).alias("_r")).select("_r.*")
    cell = F.transform(F.split(F.regexp_replace("value", r"^\|\s*|\s*\|\s*$", ""), r"(?<!\\)\|"), lambda c: F.replace(F.trim(c), F.lit("\\|"), F.lit("|")))
    rows = heads.where(F.col("value").rlike(r"^\| *\d+ *\|")).withColumn("_c", cell)
    at = lambda i: F.try_element_at("_c", F.lit(i))
    people = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), r",\s*"), lambda x: (x != "") & (x != "-") & (x != "—"))
    link = r"\[([^\]]*)\]\(([^)]*)\)"
    last = F.element_at("_c", -1)
    pairs = F.map_from_arrays(F.regexp_extract_all(last, F.lit(link), F.lit(1)), F.regexp_extract_all(last, F.lit(link), F.lit(2)))
    return rows.select(F.lit(locale).alias("locale"), "line", "section", at(1).alias("ep"), F.try_to_date(at(2), "yyyy-MM-dd").alias("date"), F.regexp_extract(at(3), r"^\[(.*)\]\([^)]*\)$", 1).alias("title"), F.regexp_extract(at(3), r"(?:v=|youtu\.be/)([\w-]{11})", 1).alias("video_id"), at(4).alias("length"), people(at(5)).alias("hosts"), F.when(F.size("_c") > 6, people(at(6))).otherwise(F.array().cast("array<string>")).alias("guests"), pairs.alias("links"))
