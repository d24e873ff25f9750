"""Sinks: index and topic pages, navigation blocks, manifest, review report, splicing between markers.

Pages are for readers: a few rows per recording, brought to the driver in order and joined.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.functions.text import duration_label, escaped_cell, nav_title, video_url

# Headings, layer names and months in the two locales.
WORDS = {
    "en": {"head": ("Ep", "Date", "Title", "Length", "Hosts", "Guests", "Transcript"), "raw": "Raw", "interview": "Interview", "interview-en": "English", "interview-ms": "Bahasa Melayu"},
    "ms": {"head": ("Ep", "Tarikh", "Tajuk", "Tempoh", "Hos", "Tetamu", "Transkrip"), "raw": "Mentah", "interview": "Temu bual", "interview-en": "Inggeris", "interview-ms": "Bahasa Melayu"},
}
LAYERS = ("raw", "interview", "interview-en", "interview-ms")


def index_view(episodes: DataFrame, layers: DataFrame, locale: str = "en") -> DataFrame:
    """(show, publish_date, ep, row): one Markdown row per recording; links only to layers that exist."""
    names = F.create_map(*[x for k in LAYERS for x in (F.lit(k), F.lit(WORDS[locale][k]))])
    order = F.array_position(F.array(*[F.lit(k) for k in LAYERS]), F.col("layer"))
    links = layers.where(F.col("layer").isin(*LAYERS)).groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.concat(F.lit("["), names[F.col("layer")], F.lit("]("), F.col("path"), F.lit(")")).alias("link")))).alias("_links"))
    got = episodes.join(links, "video_id", "left")
    people = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), ", ")
    guests = F.array_except(F.coalesce("guests", F.array().cast("array<string>")), F.coalesce("hosts", F.array().cast("array<string>")))
    cells = [F.lpad(F.col("ep").cast("string"), 2, "0"), F.date_format("publish_date", "yyyy-MM-dd"), F.concat(F.lit("["), escaped_cell("title"), F.lit("]("), video_url("video_id"), F.lit(")")), duration_label("duration_seconds"), escaped_cell(people(F.col("hosts"))), escaped_cell(people(guests)), F.array_join(F.transform("_links", lambda x: x["link"]), " · ")]
    return got.select("show", "publish_date", "ep", F.concat(F.lit("| "), F.array_join(F.array(*[F.coalesce(c, F.lit("")) for c in cells]), " | "), F.lit(" |")).alias("row"))


def index_page(episodes: DataFrame, layers: DataFrame, locale: str = "en") -> str:
    """Sections by show, newest first."""
    head = WORDS[locale]["head"]
    out, show = [], None
    for r in index_view(episodes, layers, locale).orderBy("show", F.desc("publish_date"), F.desc("ep")).toLocalIterator():
        if r.show != show:
            show = r.show
            out += ([""] if out else []) + [f"## {show}", "", f"| {' | '.join(head)} |", f"|{'---|' * len(head)}"]
        out.append(r.row)
    return "\n".join(out)


def topic_view(episodes: DataFrame) -> DataFrame:
    """(publish_date, show, ep, topic, title): topics of all recordings, oldest first when ordered."""
    return episodes.select("publish_date", "show", "ep", F.explode("topics").alias("topic"), "title")


def topic_page(episodes: DataFrame) -> str:
    rows = topic_view(episodes).orderBy("publish_date", "show", "ep", "topic").toLocalIterator()
    return "\n".join(f"- {r.publish_date} {r.topic} ({r.title})" for r in rows)


def nav_blocks(episodes: DataFrame, layers: DataFrame) -> DataFrame:
    """(video_id, layer, nav): date, length and links to the layers that exist, the current one in bold."""
    order = F.array_position(F.array(*[F.lit(k) for k in LAYERS]), F.col("layer"))
    there = layers.where(F.col("layer").isin(*LAYERS)).groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "layer"))).alias("_all"))
    names = F.create_map(*[x for k in LAYERS for x in (F.lit(k), F.lit(WORDS["en"][k]))])
    own = layers.select("video_id", "layer").join(there, "video_id").join(episodes.select("video_id", "title", "publish_date", "duration_seconds"), "video_id")
    link = F.transform("_all", lambda x: F.when(x["layer"] == F.col("layer"), F.concat(F.lit("**"), names[x["layer"]], F.lit("**"))).otherwise(F.concat(F.lit("["), names[x["layer"]], F.lit("]("), x["layer"], F.lit(".md)"))))
    nav = F.concat_ws("\n", F.lit("<!-- nav -->"), F.concat(F.lit("**"), nav_title("title"), F.lit("**")), F.lit(""), F.concat_ws(" · ", F.date_format("publish_date", "d MMMM yyyy"), duration_label("duration_seconds"), F.array_join(link, " · ")), F.lit("<!-- /nav -->"))
    return own.select("video_id", "layer", nav.alias("nav"))


def splice(page: str, name: str, block: str) -> str:
    """``page`` with the text between ``<!-- BEGIN name -->`` and ``<!-- END name -->`` replaced; doing it again changes nothing."""
    begin, end = f"<!-- BEGIN {name} -->", f"<!-- END {name} -->"
    if begin not in page or end not in page.split(begin, 1)[1]:
        raise ValueError(f"the page has no {name} block")
    return re.sub(f"{re.escape(begin)}.*?{re.escape(end)}", lambda _: f"{begin}\n{block}\n{end}", page, count=1, flags=re.S)


def write_manifest(episodes: DataFrame, layers: DataFrame, path: str) -> None:
    """One JSON record per recording with its layers."""
    per = layers.groupBy("video_id").agg(F.sort_array(F.collect_list("layer")).alias("layers"))
    episodes.join(per, "video_id", "left").write.mode("overwrite").json(path)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet by ``by``; only the partitions that ``df`` holds are replaced."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def report_page(rollup: DataFrame) -> str:
    """The review report: a row per recording, a column per check."""
    names = rollup.columns
    rows = [f"| {' | '.join(names)} |", f"|{'---|' * len(names)}"]
    rows += [f"| {' | '.join('' if v is None else str(v) for v in r)} |" for r in rollup.orderBy(names[0]).toLocalIterator()]
    return "\n".join(rows)
