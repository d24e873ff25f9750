"""Reviewed replacements by an automaton over the whole dictionary.

A correction is a decision (ord, wrong, right, scope): whole words, in order, in one recording or
everywhere. Applied one by one they would be a pass over the text each. Here one pass of an
Aho-Corasick automaton tells which entries a text holds at all; the first of these is
applied, and as it may make or break others, the text is looked at again for those behind
it. Texts hold few entries, so the cost follows the text, not the dictionary.

A dictionary of at most ``most`` entries and ``most_chars`` characters travels whole, and texts never
shuffle. A larger one stays a table, so no task holds more of it than its texts need: an entry
meets the texts that hold its longest word (or, if it has no ASCII word, its first
characters) by a hash, and each different text gets its own entries. What replacements write may make
further entries apply; texts tell what they came to hold, and are done again with the
entries for it until nothing is new. No size is refused. Entries of recordings that are not there are
left out first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.runtime import cut, ship_package, unused

MOST, MOST_CHARS = 100_000, 8_000_000
_WORDY = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")


def whole(text: str, begin: int, end: int) -> bool:
    """Whether no ASCII word character touches text[begin:end]."""
    return (not begin or text[begin - 1] not in _WORDY) and (end == len(text) or text[end] not in _WORDY)


def replaced(text: str, wrong: str, right: str) -> str:
    """All whole occurrences from left to right, none inside another, replaced."""
    out, at, begin = [], 0, text.find(wrong)
    while begin >= 0:
        end = begin + len(wrong)
        if whole(text, begin, end):
            out += (text[at:begin], right)
            at = end
            begin = text.find(wrong, end)
        else:
            begin = text.find(wrong, begin + 1)
    return "".join(out) + text[at:] if out else text


class Dictionary:
    """Entries (wrong, right, scope) in order."""

    def __init__(self, entries: list[tuple[str, str, object]]):
        import ahocorasick

        self.entries = entries
        by: dict[str, list[int]] = {}
        for k, (wrong, _, _) in enumerate(entries):
            by.setdefault(wrong, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for wrong, own in by.items():
            self.automaton.add_word(wrong, (len(wrong), own))
        self.automaton.make_automaton()

    def first(self, text: str, scope: object, after: int) -> int | None:
        """The first entry behind ``after`` that the text holds as whole words."""
        best = None
        for last, (size, own) in self.automaton.iter(text):
            if own[-1] > after and (best is None or own[0] < best) and whole(text, last + 1 - size, last + 1):
                for k in own:
                    if k > after and (best is None or k < best) and self.entries[k][2] in (None, scope):
                        best = k
                        break
        return best

    def apply(self, text: str, scope: object) -> str:
        at = self.first(text, scope, -1)
        while at is not None:
            text = replaced(text, *self.entries[at][:2])
            at = self.first(text, scope, at)
        return text


ORDER = ("ord", "wrong", "right", "scope")


def corrected(turns: DataFrame, corrections: DataFrame, text: str = "text", scope: str = "video_id", most: int = MOST, most_chars: int = MOST_CHARS) -> DataFrame:
    """``turns`` with ``text`` corrected; ``corrections``: (ord, wrong, right, scope), scope null for everywhere.

    Ties of ``ord`` go by wrong, right and scope. An entry with a null or empty ``wrong`` does nothing, a
    null ``right`` removes. Null texts stay null; entries with a scope never touch rows without one.
    """
    ship_package(turns.sparkSession)
    kind = turns.schema[scope].dataType
    listed = corrections.where("wrong <> ''").select("ord", "wrong", F.coalesce("right", F.lit("")).alias("right"), F.col("scope").cast(kind).alias("scope"))
    there = turns.select(F.col(scope).alias("scope")).distinct()
    listed = listed.where("scope IS NULL").unionByName(listed.join(there, "scope", "left_semi").select(listed.columns))
    held = listed.select(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.char_length("wrong") + F.char_length("right")).cast("long")), F.lit(0)).alias("chars")).first()
    if not held.n:
        return turns
    if held.n <= most and held.chars <= most_chars:
        rows = listed.orderBy(*ORDER).collect()
        return _mapped(turns, text, scope, turns.sparkSession.sparkContext.broadcast([(x.wrong, x.right, x.scope) for x in rows]))
    return _joined(turns, listed, text, scope)


_WORD = re.compile("[A-Za-z0-9_]+")
_OTHER = re.compile("[^A-Za-z0-9_]+")
GRAM = 3


def anchor(wrong: str) -> str:
    """What a text must hold, as one of its ``anchors``, for an entry to apply."""
    return max(_WORD.findall(wrong), key=len, default=wrong[:GRAM])


def anchors(text: str, others: bool = True) -> set[str]:
    """The words of a text, and with ``others`` the up to ``GRAM`` characters from each place between them.

    An entry applies where no word character touches it, so its own words are whole words of the text,
    and an entry without a word lies between two of them.
    """
    between = _OTHER.findall(text) if others else []
    return {*_WORD.findall(text), *(run[i : i + n] for run in between for n in range(1, GRAM + 1) for i in range(len(run) - n + 1))}


def replaced_in_order(text: str, entries: list[tuple[str, str, int]], others: bool = True) -> tuple[str, set[str]]:
    """A text after entries (wrong, right, times), and the anchors that it came to hold on the way and had not before."""
    had, came = None, set()
    for wrong, right, times in entries:
        for _ in range(times):
            new = replaced(text, wrong, right) if wrong in text else text
            if new != text:
                had = anchors(text, others) if had is None else had
                came |= anchors(new) if others else anchors(right, others)  # its words are whole words there
                text = new
    return text, came - had if had else came


def _anchors_of(texts: DataFrame, others: bool) -> DataFrame:
    """(id, scope, anchor) of texts (id, scope, text)."""

    def each(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for c in columns:
            yield pa.array([list(anchors(x, others)) for x in c.to_pylist()], pa.list_(pa.string()))

    return texts.select("id", "scope", F.explode(F.arrow_udf(each, "array<string>")("text")).alias("anchor"))


def _entries_of(asked: DataFrame, listed: DataFrame) -> DataFrame:
    """(id, entry) of what texts hold: (id, scope, anchor); entries of a scope meet only their own recording's texts."""
    wide, own = F.xxhash64("anchor"), F.xxhash64("anchor", F.col("scope").cast("string"))
    keys = asked.select("id", F.explode(F.when(F.col("scope").isNull(), F.array(wide)).otherwise(F.array(wide, own))).alias("by"))
    entries = listed.select(F.when(F.col("scope").isNull(), wide).otherwise(own).alias("by"), F.struct(*ORDER, "times").alias("entry"))
    return keys.join(entries.hint("merge"), "by").select("id", "entry")


def _joined(turns: DataFrame, listed: DataFrame, text: str, scope: str) -> DataFrame:
    def first(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for c in columns:
            yield pa.array([anchor(x) for x in c.to_pylist()], pa.string())

    def each(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in columns:
            out = []
            for t, own in zip(texts.to_pylist(), lists.to_pylist(), strict=True):
                new, came = replaced_in_order(t, [(e["wrong"], e["right"], e["times"]) for e in own], others)
                out.append({"text": new, "came": list(came)})
            yield pa.array(out, pa.struct([("text", pa.string()), ("came", pa.list_(pa.string()))]))

    listed = listed.groupBy(*ORDER).agg(F.count(F.lit(1)).cast("int").alias("times"))
    listed = cut(listed.withColumn("anchor", F.arrow_udf(first, "string")("wrong")))
    others = not listed.where("NOT wrong RLIKE '[A-Za-z0-9_]'").isEmpty()
    own = F.col(scope).cast("string")
    key = F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.char_length(own).cast("string"), F.lit(":"), own), F.lit("-")), F.lit(" "), F.col(text))))
    texts = cut(turns.where(F.col(text).isNotNull()).select(key.alias("id"), F.col(scope).alias("scope"), F.col(text).alias("text")).dropDuplicates(["id"]))
    seen = _anchors_of(texts, others)
    held = cut(_entries_of(seen, listed).groupBy("id").agg(F.array_sort(F.collect_set("entry")).alias("own")))
    done = None
    while True:
        made = texts.join(held.hint("merge"), "id").select("id", "scope", "text", "own", F.arrow_udf(each, "text string, came array<string>")("text", F.transform("own", lambda e: F.struct(e["wrong"].alias("wrong"), e["right"].alias("right"), e["times"].alias("times")))).alias("made"))
        made = cut(made)
        more = _entries_of(made.select("id", "scope", F.explode("made.came").alias("anchor")), listed).groupBy("id").agg(F.collect_set("entry").alias("more"))
        more = cut(made.select("id", "own").join(more.hint("merge"), "id").select("id", F.array_sort(F.array_union("own", "more")).alias("all"), "own").where("size(all) > size(own)").select("id", F.col("all").alias("own")))
        last = made.join(more.select("id").hint("merge"), "id", "left_anti").select("id", F.col("made.text").alias("text"))
        done = last if done is None else done.unionByName(last)
        if more.isEmpty():
            break
        held = more
    id_, new = unused(turns.columns, "id"), unused([*turns.columns, "id"], "corrected")
    out = turns.withColumn(id_, key).join(done.select(F.col("id").alias(id_), F.col("text").alias(new)).hint("merge"), id_, "left")
    return out.withColumn(text, F.coalesce(F.col(new), F.col(text))).select(turns.columns)


def _mapped(turns: DataFrame, text: str, scope: str, sent) -> DataFrame:
    built: dict[int, Dictionary] = {}

    def each(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own = built.get(0) or built.setdefault(0, Dictionary(sent.value))
        for t, s in columns:
            yield pa.array([None if x is None else own.apply(x, k) for x, k in zip(t.to_pylist(), s.to_pylist(), strict=True)], pa.string())

    name = unused(turns.columns, "corrected")
    return turns.withColumn(name, F.arrow_udf(each, "string")(F.col(text), F.col(scope))).withColumn(text, F.col(name)).drop(name)
