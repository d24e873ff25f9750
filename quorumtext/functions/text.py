"""Text expressions: words, clocks, figures, slugs, fillers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^ \t\n\r\f\x0B]+"

# Scale words after a figure, Malay and English, and their powers of ten.
SCALES = {
    "ribu": 3,
    "thousand": 3,
    "k": 3,
    "juta": 6,
    "million": 6,
    "mil": 6,
    "bilion": 9,
    "billion": 9,
    "bil": 9,
    "trilion": 12,
    "trillion": 12,
}


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def n_words(text: str | Column) -> Column:
    """Number of runs of non-space characters; a null text has none."""
    return F.coalesce(F.regexp_count(as_column(text), F.lit(WORD)), F.lit(0)).cast("long")


def words(text: str | Column) -> Column:
    """The runs of non-space characters, in order."""
    return F.regexp_extract_all(F.coalesce(as_column(text), F.lit("")), F.lit(WORD), F.lit(0))


def clock_seconds(clock: str | Column) -> Column:
    """``mm:ss`` or ``h:mm:ss`` as seconds; null for anything else."""
    c = as_column(clock)
    part = lambda i: F.coalesce(F.regexp_extract(c, r"^(?:(\d+):)?(\d{1,2}):(\d{2})$", i).try_cast("int"), F.lit(0))
    return F.when(c.rlike(r"^(?:\d+:)?\d{1,2}:\d{2}$"), part(1) * 3600 + part(2) * 60 + part(3))


def duration_label(seconds: str | Column) -> Column:
    """Seconds as ``Hh Mm``, both cut off, not rounded."""
    s = as_column(seconds)
    return F.concat(F.floor(s / 3600).cast("string"), F.lit("h "), F.floor(s % 3600 / 60).cast("string"), F.lit("m"))


def slug(text: str | Column, size: int = 60) -> Column:
    """Lower case, accents of Latin letters dropped, other runs as dashes, cut at ``size``."""
    accents = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
    plain = "aaaaaaceeeeiiiinooooouuuuyy"
    low = F.translate(F.lower(as_column(text)), accents, plain)
    return F.substring(F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, size)


def escaped_cell(text: str | Column) -> Column:
    """A Markdown table cell: bars escaped."""
    return F.replace(as_column(text), F.lit("|"), F.lit("\\|"))


def nav_title(title: str | Column) -> Column:
    """A title without the show's tag behind its last bar; other bars as dashes."""
    return F.regexp_replace(F.regexp_replace(as_column(title), r"\s*\|\s*[^|]*$", ""), r"\s*\|\s*", " - ")


def without_words(text: str | Column, fillers: list[str]) -> Column:
    """The text's words, single-spaced, without those that are fillers (case and trailing punctuation aside)."""
    bare = lambda w: F.lower(F.regexp_replace(w, r"^\p{Punct}+|\p{Punct}+$", ""))
    return F.array_join(F.filter(words(text), lambda w: ~bare(w).isin([f.lower() for f in fillers])), " ")


def figures(text: str | Column) -> Column:
    """Distinct normalised figures: thousands commas dropped, a scale word applied, as decimal strings.

    ``RM1,200`` is 1200, ``2.5 juta`` and ``2.5 million`` are both 2500000.
    """
    names = "|".join(sorted(SCALES, key=len, reverse=True))
    found = F.regexp_extract_all(F.lower(F.coalesce(as_column(text), F.lit(""))), F.lit(rf"[0-9][0-9,]*(?:\.[0-9]+)?(?:\s*(?:{names})\b)?"), F.lit(0))
    power = F.create_map(*[x for k, v in SCALES.items() for x in (F.lit(k), F.lit(v))])

    def value(f: Column) -> Column:
        number = F.regexp_replace(F.regexp_extract(f, r"^[0-9,]+(?:\.[0-9]+)?", 0), ",", "").try_cast("decimal(24,6)")
        scale = F.coalesce(F.try_element_at(power, F.regexp_extract(f, r"[a-z]+$", 0)), F.lit(0))
        shown = (number * F.pow(F.lit(10.0), scale).cast("decimal(14,0)")).cast("decimal(38,6)").cast("string")
        return F.regexp_replace(F.regexp_replace(shown, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")

    return F.array_distinct(F.filter(F.transform(found, value), lambda v: v.isNotNull()))


def video_url(video_id: str | Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), as_column(video_id))
