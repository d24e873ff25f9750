"""Operators against results worked out by hand, on thresholds, nulls and empty tables."""

import pytest
from pyspark.sql import functions as F

from quorumtext.functions import text as T
from quorumtext.operators import naming, quality, speakers, turns
from quorumtext.operators.corrections import corrected


def one(spark, column, *values):
    kinds = {str: "string", int: "int"}
    df = spark.createDataFrame([(v,) for v in values], f"v {kinds[type(next(x for x in values if x is not None))]}")
    return [r.x for r in df.select(column(F.col("v")).alias("x")).collect()]


def test_clock_and_duration(spark):
    assert one(spark, T.clock_seconds, "01:43", "1:51:01", "0:00", "1:2", "", None) == [103, 6661, 0, None, None, None]
    assert one(spark, T.duration_label, 6671, 3599, 0, None) == ["1h 51m", "0h 59m", "0h 0m", None]


def test_figures(spark):
    got = one(spark, T.figures, "RM1,200 dan 2.5 juta; 2.5 million, 3 bilion 40", "", None, "1.50 and 1.5")
    assert got == [["1200", "2500000", "3000000000", "40"], [], [], ["1.5"]]


def test_slug_title_cell(spark):
    assert one(spark, T.slug, " Hari Éid | 2024!! ", None) == ["hari-eid-2024", None]
    assert one(spark, T.nav_title, "A | B | Show", "A") == ["A - B", "A"]
    assert one(spark, T.escaped_cell, "a|b") == ["a\\|b"]
    assert one(spark, lambda c: T.without_words(c, ["uh", "eh"]), "Uh, so eh what", None) == ["so what", ""]


@pytest.mark.parametrize(
    "repeats,rate,speech,want",
    [(9, 9.0, 0.1, "flag"), (10, 7.0, 0.2, "flag"), (10, 7.1, None, "remove"), (10, None, 0.19, "remove"), (24, None, None, "flag"), (25, None, None, "remove"), (25, 1.0, 0.9, "remove")],
)
def test_loop_decision(spark, repeats, rate, speech, want):
    df = spark.createDataFrame([(repeats, rate, speech)], "n int, r double, s double")
    assert df.select(quality.loop_decision(F.col("n"), F.col("r"), F.col("s"))).first()[0] == want


def test_loops_are_found_and_cut_with_the_part_repeat(spark):
    df = spark.createDataFrame([(1, "x " + "a b c " * 5 + "a b y"), (2, "p q r"), (3, None), (4, "n n n n n n")], "k int, text string")
    got = sorted((r.k, r.n, r.first, r.repeats, r.phrase) for r in quality.ngram_loops(df, ["k"]).collect())
    assert (1, 3, 1, 5, "a b c") in got and (4, 1, 0, 6, "n") in got and not [g for g in got if g[0] in (2, 3)]
    cut = df.where("k = 1").select(F.array_join(quality.without_loop(T.words("text"), F.lit(1), F.lit(3), F.lit(5)), " "))
    assert cut.first()[0] == "x a b c y"


def test_islands_and_turns(spark):
    rows = [(1, 1, "A", "a", 0), (1, 2, "A", "b", 1), (1, 3, None, "c", 2), (1, 4, None, "d", 3), (1, 5, "A", "e", 3)]
    df = spark.createDataFrame(rows, "v int, pos int, speaker string, word string, t int")
    got = turns.build_turns(df, ["v"], ["pos"], "speaker", "t", "word").orderBy("seq").collect()
    assert [(r.speaker, r.t, r.word, r.n_words) for r in got] == [("A", 0, "a b", 2), ("Speaker ?", 2, "c d", 2), ("A", 3, "e", 1)]
    assert turns.build_turns(df.limit(0), ["v"], ["pos"], "speaker", "t", "word").count() == 0


def words(spark, labels, text=None):
    text = text or ["w"] * len(labels)
    rows = [("v", i, w, float(i), i + 1.0, s) for i, (s, w) in enumerate(zip(labels, text, strict=True))]
    return spark.createDataFrame(rows, "video_id string, pos int, word string, t0 double, t1 double, speaker string")


def test_assignment_and_precedence(spark):
    w = words(spark, ["P"] * 5)
    seg = spark.createDataFrame([("v", 0.0, 2.0, "X"), ("v", 1.0, 2.0, "Y"), ("v", 3.0, 3.0, "Z")], "video_id string, t0 double, t1 double, spk string")
    got = speakers.assign_speakers(w, seg, width=1.0, fallback="speaker").orderBy("pos")
    assert [r.speaker for r in got.collect()] == ["X", "Y", "P", "P", "P"]
    rule = spark.createDataFrame([("v", 1.0, 3.0, "Audience")], "video_id string, t0 double, t1 double, speaker string")
    assert [r.speaker for r in speakers.with_rulings(w, rule).orderBy("pos").collect()] == ["P", "Audience", "Audience", "P", "P"]
    assert [r.speaker for r in speakers.assign_speakers(w, seg.limit(0)).collect()] == ["Speaker ?"] * 5


def test_snap_to_sentence_end(spark):
    text = ["a", "b.", "c", "d", "e", "f.", "g"]
    got = speakers.snap_to_sentences(words(spark, list("AAAABBB"), text)).orderBy("pos")
    assert [r.speaker for r in got.collect()] == list("AABBBBB")  # two words back to the end behind b.
    got = speakers.snap_to_sentences(words(spark, list("AAAAABB"), text)).orderBy("pos")
    assert [r.speaker for r in got.collect()] == list("AAAAAAB")  # one word on
    got = speakers.snap_to_sentences(words(spark, list("AAABBBB"), ["a", "b", "c", "d", "e", "f", "g"])).orderBy("pos")
    assert [r.speaker for r in got.collect()] == list("AAABBBB")


def test_camera_keeps_short_turns(spark):
    w = words(spark, list("AAAABBAAAA"))
    seg = spark.createDataFrame([("v", 0.0, 10.0, "C")], "video_id string, t0 double, t1 double, spk string")
    assert [r.speaker for r in speakers.by_camera(w, seg).orderBy("pos").collect()] == list("CCCCBBCCCC")


def test_profiles_and_errors(spark):
    voices = spark.createDataFrame([("v", "s0", [1.0, 0.1]), ("v", "s1", [0.0, 2.0])], "video_id string, spk string, embedding array<float>")
    known = spark.createDataFrame([("Ali", [3.0, 0.0]), ("Abu", [0.0, 1.0])], "speaker string, embedding array<float>")
    assert sorted((r.spk, r.speaker) for r in naming.nearest_profile(voices, known).collect()) == [("s0", "Ali"), ("s1", "Abu")]
    assert sorted((r.spk, r.speaker) for r in naming.nearest_profile(voices, known, max_profiles=1).collect()) == [("s0", "Ali"), ("s1", "Abu")]
    r = speakers.label_errors(words(spark, list("AB")), words(spark, list("AA"))).first()
    assert (r.n_wrong, r.n_words, r.rate) == (1, 2, 0.5)


def test_leaks_names_credits(spark):
    pub = spark.createDataFrame([(1, "the Bad word. Ali Hassan met Siti Aminah"), (2, None)], "k int, text string")
    raw = spark.createDataFrame([(1, "the word ali Ali Hasan"), (2, "x")], "k int, text string")
    lex = spark.createDataFrame([("bad",), ("word",)], "word string")
    assert [(r.k, r.word) for r in quality.lexicon_leaks(pub, raw, lex, ["k"]).collect()] == [(1, "bad")]
    assert [r.name for r in quality.names_absent(pub, raw, ["k"]).collect()] == ["Siti Aminah"]
    lines = one(spark, lambda c: quality.credit_lines(c, ["thanks to"]), "Thanks to www.x.org\nthanks to you\nsee https://a", None)
    assert lines == [["Thanks to www.x.org"], []]


def test_reviewed_rollup_corrections(spark):
    f = spark.createDataFrame([("v", "raw", 1, "a", "flag", "e"), ("v", "raw", 2, "b", "flag", "e"), ("w", "raw", 1, "a", "flag", "z")], "video_id string, layer string, seq int, check string, severity string, evidence string")
    ok = spark.createDataFrame([("v", "a", "e", "known")], "video_id string, check string, evidence string, reason string")
    left = quality.without_reviewed(f, ok)
    assert sorted((r.video_id, r.a, r.b, r.n_findings) for r in quality.rollup(left, ["a", "b"]).collect()) == [("v", 0, 1, 1), ("w", 1, 0, 1)]
    t = spark.createDataFrame([("v", "Jon met Jonas, $1"), ("w", "Jon")], "video_id string, text string")
    c = spark.createDataFrame([(2, "John", "J$n", "v"), (1, "Jon", "John", None)], "ord int, wrong string, right string, scope string")
    assert sorted(r.text for r in corrected(t, c).collect()) == ["J$n met Jonas, $1", "John"]


def test_coverage_captions_gates(spark):
    t = spark.createDataFrame([("v", "raw", 1, 10, "A", "one 5"), ("v", "raw", 2, 70, "B", "two")], "video_id string, layer string, seq int, start_sec int, speaker string, text string")
    c = spark.createDataFrame([("v", 9.0), ("v", 130.0), ("w", 1.0)], "video_id string, t0 double")
    assert sorted((r.video_id, r.n_shown, r.n_both) for r in quality.coverage(t, c).collect()) == [("v", 2, 1), ("w", 1, 0)]
    assert [r.caption_t0 for r in quality.nearest_caption(t, c).orderBy("seq").collect()] == [9.0, 9.0]
    gate = quality.segment_gates(t.withColumn("text", F.replace("text", F.lit("5"), F.lit("6"))), t).first()
    assert (gate.figures_kept, gate.speakers_kept, gate.passes) == (False, True, False)
    assert quality.segment_gates(t, t).first().passes


def test_queries_equal_their_sql(spark):
    """All named queries of this library on the small tables, value by value."""
    import duckdb

    from quorumtext.plans import registry

    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("benchmark", "conversations", "documents", "embeddings", "events", "labels", "orders"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    plain = lambda v: "null" if v is None or v != v else f"{v:.6f}" if isinstance(v, float) else str(v)
    for name, query in registry.QUERIES.items():
        df = query(spark, d)
        cols = sorted(df.columns)
        if name not in registry.ORACLE_SQL:
            assert df.count() >= 0
            continue
        rel = c.execute(registry.ORACLE_SQL[name])
        at = [[x[0] for x in rel.description].index(k) for k in cols]
        want = sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
        got = sorted(tuple(plain(r[k]) for k in cols) for r in df.collect())
        assert got == want, name
