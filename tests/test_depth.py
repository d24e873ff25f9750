"""Alignment, loops, near names and corrections against full dynamic programmes, quadratic searches and the unrolled form."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumtext.operators import alignment, fuzzy, loops, quality
from quorumtext.operators.corrections import Dictionary, corrected


def full_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def check_path(a, b, path):
    assert [i for i, _ in path if i >= 0] == list(range(len(a))) and [j for _, j in path if j >= 0] == list(range(len(b)))
    return sum(i < 0 or j < 0 or a[i] != b[j] for i, j in path)


@pytest.mark.parametrize("cells", [1 << 23, 64])  # the small one halves its gaps
def test_gap_alignment_is_a_best_one(cells):
    rng = random.Random(1)
    for _ in range(150):
        a = [rng.randrange(4) for _ in range(rng.randrange(25))]
        b = [rng.randrange(4) for _ in range(rng.randrange(25))]
        path = alignment.edit_path(np.array(a, np.int64), np.array(b, np.int64), cells)
        assert check_path(a, b, path) == full_distance(a, b)


def test_rising_chain_is_longest():
    rng = random.Random(2)
    for _ in range(200):
        b = [rng.randrange(12) for _ in range(rng.randrange(10))]
        got = alignment.rising(b)
        assert all(x < y and b[x] < b[y] for x, y in zip(got, got[1:]))
        best = [0] * (len(b) + 1)
        for i, x in enumerate(b):
            best[i] = 1 + max([best[j] for j in range(i) if b[j] < x], default=0)
        assert len(got) == max(best, default=0)


def as_turns(spark, rows):
    return spark.createDataFrame(rows, "video_id string, seq int, text string")


def test_edits_equal_a_full_dynamic_programme(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    left, right = {}, {}
    for v in range(25):
        a = [rng.choice(words) for _ in range(rng.randrange(60))]
        b = [w for w in a if rng.random() > 0.1]
        b = [rng.choice(words) if rng.random() < 0.1 else w for w in b]
        left[f"v{v}"], right[f"v{v}"] = a, b
    left["alone"], right["other"] = ["x", "y"], ["z"]
    rows = lambda side: as_turns(spark, [(v, i // 10, " ".join(ws[i : i + 10])) for v, ws in side.items() for i in range(0, len(ws), 10)])
    a, b = (alignment.placed_words(rows(s), ["video_id"], ["seq"]) for s in (left, right))
    got = {r.video_id: (r.n_a, r.n_b, r.n_edits) for r in alignment.distances(a, b, ["video_id"]).collect()}
    for v in left | right:
        x, y = left.get(v, []), right.get(v, [])
        if x or y:
            assert got[v][:2] == (len(x), len(y))
            best = full_distance(x, y)
            assert best <= got[v][2] <= best + 1, v  # a chain of unique runs may miss a best one
    exact = sum(got[v][2] == full_distance(left[v], right[v]) for v in left if v in right and left[v])
    assert exact >= 23


def test_a_hole_is_found_where_every_minute_has_words(spark):
    """41 in 100 of the words are missing, but no stretch of time is empty."""
    rng = random.Random(4)
    said = [f"word{rng.randrange(400)}" for _ in range(3000)]
    captions = as_turns(spark, [("v", i // 10, " ".join(said[i : i + 10])) for i in range(0, 3000, 10)] + [("v", 999, None), (None, 1, "only here")])
    hole = range(900, 2130)
    left = [w for i, w in enumerate(said) if i not in hole]
    told = as_turns(spark, [("v", i // 10, " ".join(left[i : i + 10])) for i in range(0, len(left), 10)])
    got = {(r.video_id, r.seq): (r.n_words, r.n_missing, r.n_changed) for r in alignment.missing_by_turn(captions, told, ["video_id"]).collect()}
    assert got["v", 999] == (0, 0, 0) and got[None, 1] == (2, 2, 0)
    missing = {s: m for (v, s), (_, m, _) in got.items() if v == "v"}
    assert sum(missing.values()) == 1230 and sum(c for *_, c in got.values()) == 0
    assert all(missing[s] == 10 for s in range(92, 211)) and not any(missing[s] for s in [*range(0, 88), *range(215, 300)])
    timed = told.withColumns({"start_sec": (F.col("seq") * 300 / 177 * 10).cast("int")})
    shown = captions.where("seq < 300").select("video_id", (F.col("seq") * 10).cast("double").alias("t0"))
    assert quality.coverage(timed, shown).where("video_id = 'v'").first().share > 0.95  # what time alone sees


def test_labels_are_compared_word_by_word_not_place_by_place(spark):
    rows = [("v", i, w, s) for i, (w, s) in enumerate(zip("the quick brown fox jumps over the lazy dog again".split(), "AAABBBBBCC", strict=True))]
    gold = [("v", i, w, s) for i, (w, s) in enumerate(zip("well the quick brown fox jumps over lazy dog again".split(), "AAAABBBBCC", strict=True))]
    kinds = "video_id string, pos int, word string, speaker string"
    r = alignment.aligned_label_errors(spark.createDataFrame(rows, kinds), spark.createDataFrame(gold, kinds)).first()
    assert (r.n_wrong, r.n_words, r.n_unmatched) == (0, 9, 1)
    gold[3] = ("v", 3, "brown", "X")
    assert alignment.aligned_label_errors(spark.createDataFrame(rows, kinds), spark.createDataFrame(gold, kinds)).first().n_wrong == 1


def slow_repetitions(s, least):
    found = set()
    for p in range(1, len(s) // least + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            if j + p - i >= least * p:
                found.add((i, j + p, p))
            i = max(j, i) + 1
    least_of = {}
    for a, e, p in found:
        least_of[a, e] = min(p, least_of.get((a, e), p))
    return sorted((a, p, e) for (a, e), p in least_of.items())


@pytest.mark.parametrize("least", [3, 5])
def test_repetitions_equal_a_quadratic_search(least):
    rng = random.Random(least)
    rows = []
    for _ in range(300):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        unit = [rng.randrange(3) for _ in range(rng.randrange(1, 9))]
        s += unit * rng.randrange(1, 9) + unit[: rng.randrange(len(unit))] + [rng.randrange(3) for _ in range(rng.randrange(9))]
        rows.append(s)
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    got = [[] for _ in rows]
    for r, s, p, e in loops.repetitions(np.array([x for r in rows for x in r], np.int64), bounds, least):
        got[r].append((s, p, e))
    assert got == [slow_repetitions(r, least) for r in rows]


def test_loops_inside_a_number_and_of_long_phrases(spark):
    phrase = [f"p{i}" for i in range(40)]
    texts = ["it cost 5" + ",000" * 216 + " in all", " ".join(["x", *phrase * 12, *phrase[:7], "y"]), "Ada ada, ADA ada ada! ada ada ada ada end", "aaa bbb ccc", None, "", "é" * 30 + " z"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {(r.k, r.unit): (r["first"], r.period, r.repeats, r.phrase) for r in loops.loop_rows(df, ["k"]).collect()}
    assert got == {(0, "char"): (9, 4, 216, ",000"), (1, "word"): (1, 40, 12, " ".join(phrase)), (2, "word"): (0, 1, 9, "ada"), (6, "char"): (0, 1, 30, "é")}
    out = {r.k: (r.text, r.n_removed, r.n_flagged) for r in loops.without_loops(df, speech=F.lit(0.1)).collect()}
    assert out[0] == ("it cost 5,000 in all", 1, 0) and out[1] == (" ".join(["x", *phrase, "y"]), 1, 0)
    assert out[2] == (texts[2], 0, 1) and out[3] == (texts[3], 0, 0) and out[4] == (None, 0, 0) and out[5] == ("", 0, 0) and out[6] == ("é z", 1, 0)
    assert {r.n_removed for r in loops.without_loops(df.where("k = 1")).collect()} == {0}  # twelve repeats alone prove nothing
    assert loops.without_loops(df.limit(0)).count() == 0


def test_overlapping_stretches_are_cut_once(spark):
    df = spark.createDataFrame([("0123456789",)], "t string")
    spans = F.array(*[F.struct(F.lit(a).alias("begin"), F.lit(e).alias("end")) for a, e in ((1, 4), (2, 3), (3, 6), (8, 20))])
    assert df.select(loops.without_spans(F.col("t"), spans)).first()[0] == "067"


def edits(a, b):
    return full_distance(a, b)


@pytest.mark.parametrize("most,q", [(1, 2), (2, 2), (2, 3), (3, 2)])
def test_near_names_equal_all_pairs(spark, most, q):
    rng = random.Random(most * 10 + q)
    base = ["Kassim Ali", "Siti Aminah", "Ng", "A", "", "Muthu a/l Raja", "Éé La", "aaaa aaaa", "abab abab"]
    noisy = lambda s: "".join(c for c in s if rng.random() > 0.1) + rng.choice(["", "x", "é"])
    sides = [[(k, noisy(rng.choice(base))) for k in (1, 2) for _ in range(60)] + [(1, None), (None, "Ng"), (1, "Ng")] for _ in range(2)]
    a, b = (spark.createDataFrame(s, "k int, s string") for s in sides)
    got = {(r.k, r.s, r.t): r.distance for r in fuzzy.within_edits(a, b, ["k"], most, q).collect()}
    want = {}
    for k, s in set(sides[0]):
        for m, t in set(sides[1]):
            if k is not None and k == m and s is not None and t is not None and edits(s, t) <= most:
                want[k, s, t] = edits(s, t)
    assert got == want


def test_a_wrong_first_letter_is_found(spark):
    pub = spark.createDataFrame([(1, "we met Kassim Ali and Lim Guan"), (2, "Kassim Ali")], "k int, text string")
    raw = spark.createDataFrame([(1, "said Qassim Ali"), (2, None)], "k int, text string")
    assert sorted((r.k, r.name) for r in quality.names_absent(pub, raw, ["k"]).collect()) == [(1, "Lim Guan"), (2, "Kassim Ali")]


def test_alignment_goes_along_the_shorter_side(monkeypatch):
    """A gap of many words against few takes a step for each of the few, and none for one against one."""
    steps, own = [], alignment.banded
    monkeypatch.setattr(alignment, "banded", lambda a, b, k: steps.append(len(a)) or own(a, b, k))
    a, b = np.arange(200), np.array([-1, 50, -2])
    assert len([1 for i, j in alignment.edit_path(a, b) if i >= 0 and j >= 0 and a[i] == b[j]]) == 1
    assert set(steps) == {3}
    assert alignment.edit_path(a[:1], b[:1]) == [(0, 0)] and set(steps) == {3}


def test_names_in_a_run_of_very_many_words(spark):
    """A run of capitalised words is one name, however long it is."""
    run = " ".join(["Ab"] * 30_000)
    df = spark.createDataFrame([(1, f"and {run} or Siti Aminah")], "k int, text string")
    assert {r.name for r in quality.names_in(df, ["k"]).collect()} == {run, "Siti Aminah"}


def test_names_absent_counts_bytes_as_its_sql_does(spark, tmp_path):
    """Two changed letters beyond ASCII are up to four bytes."""
    import duckdb

    from quorumtext.plans import text_queries

    said = [("Der Enö", "Der Enas"), ("Jörg Weiß", "Jorg Weiß"), ("Jörg Weiß", "Jorg Weis"), ("Ärne Öst", "Érne Òst"), ("Max Groß", "Max Gross"), ("Ali Hassan", "Ali Hasan")]
    rows = [(i, k, role, text) for i, pair in enumerate(said) for k, (role, text) in enumerate(zip(("assistant", "user"), pair, strict=True))]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = sorted(con.execute(text_queries.ORACLE_SQL["names_absent"]).fetchall())
    got = sorted((r.conv_id, r.name) for r in text_queries.names_absent(spark, str(tmp_path)).collect())
    assert got == want and got


def test_large_dictionaries_are_not_sent_to_the_workers(spark, monkeypatch):
    """Each text gets its own entries, those that replacements make apply too; between words as well."""
    from quorumtext.operators import corrections

    monkeypatch.setattr(corrections, "_mapped", None)
    entries = [(i, f"w{i}", f"w{i + 1}", None) for i in range(6)] + [(9, "é", "", None), (10, "--", "#", None), (11, "w6 #", "end", "v"), (12, " ", "_", None)] + [(20, f"x{i}", "y", "v") for i in range(500)]
    rows = [("v", "w0 -é- x7"), ("w", "w3 -é- x7"), (None, "w5 é é"), ("v", None), (None, "v"), ("v", "w0 -é- x7")]
    turns = spark.createDataFrame(rows, "video_id string, text string")
    got = corrected(turns, spark.createDataFrame(entries, "ord int, wrong string, right string, scope string"), most=100)
    key = lambda v, t: (v or "", t or "")
    assert sorted(key(*r) for r in got.collect()) == sorted(key(v, t and unrolled(t, v, entries)) for v, t in rows)


def unrolled(text, video, entries):
    for _, wrong, right, scope in sorted(entries, key=lambda e: (e[0], e[1] or "", e[2] or "", e[3] or "")):
        if wrong and scope in (None, video):
            text = re.sub(rf"(?<![A-Za-z0-9_]){re.escape(wrong)}(?![A-Za-z0-9_])", lambda _: right or "", text)  # noqa: B023
    return text


def test_corrections_equal_the_unrolled_form(spark):
    rng = random.Random(9)
    token = lambda: "".join(rng.choice("ab") for _ in range(rng.randrange(1, 5)))
    entries = [(rng.randrange(400), " ".join(token() for _ in range(rng.randrange(1, 3))), rng.choice([token(), token(), token() + " " + token(), None, None]), rng.choice([None, None, "v", "w"])) for _ in range(2000)]
    entries += [(1, "", "x", None), (2, None, "x", None), (3, "b", "q", "nobody"), (4, "a.b", "dot", None)]
    rows = [(rng.choice(["v", "w", None]), " ".join(rng.choice([token(), token() + "é", token() + "_", "a.b", "."]) for _ in range(rng.randrange(30)))) for _ in range(200)] + [("v", None), ("v", "")]
    turns = spark.createDataFrame(rows, "video_id string, text string").withColumn("corrected", F.lit(1))
    listed = spark.createDataFrame(entries, "ord int, wrong string, right string, scope string")
    want = sorted((v or "", "" if t is None else unrolled(t, v, entries)) for v, t in rows)
    for most in (100_000, 300):  # at once, and in seven passes
        got = corrected(turns, listed, most=most)
        assert got.columns == turns.columns
        assert sorted((r.video_id or "", r.text or "") for r in got.collect()) == want
    assert corrected(turns, listed.limit(0)).count() == len(rows) and corrected(turns.limit(0), listed).count() == 0


def test_a_hundred_thousand_corrections_are_one_pass(spark):
    listed = spark.range(100_000).select(F.col("id").cast("int").alias("ord"), F.concat(F.lit("name"), "id").alias("wrong"), F.concat(F.lit("Name "), "id").alias("right"), F.lit(None).cast("string").alias("scope"))
    turns = spark.createDataFrame([("v", "name7 and name99999, not name100000 or xname7")], "video_id string, text string")
    out = corrected(turns, listed)
    assert out.first().text == "Name 7 and Name 99999, not name100000 or xname7"
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_an_earlier_entry_that_appears_later_is_not_applied():
    assert Dictionary([("x", "y", None), ("z", "x", None)]).apply("x z", None) == "y x"


def test_densities_of_patterns_and_of_a_table(spark):
    texts = [(1, "The, the (THE) then of-the of. the\tof"), (2, ""), (3, None), (4, "... the"), (5, "é the\nthe")]
    df = spark.createDataFrame(texts, "k int, text string")
    share = lambda ws: {r.k: r.d for r in df.select("k", quality.language_density("text", ws).alias("d")).collect()}
    assert share(["The", "of"]) == {1: 6 / 8, 2: None, 3: None, 4: 0.5, 5: 2 / 3}
    assert share(["...", "a b", ""]) == {1: 0.0, 2: None, 3: None, 4: 0.0, 5: 0.0}
    words = spark.createDataFrame([("THE", "en"), ("of", "en"), ("é", "fr"), (None, "xx"), ("the", None)], "word string, lang string")
    got = {(r.k, r.lang): (r.n_listed, r.n_words) for r in quality.lexicon_densities(df, ["k"], words).collect()}
    assert got == {(1, "en"): (6, 8), (1, "fr"): (0, 8), (4, "en"): (1, 2), (4, "fr"): (0, 2), (5, "en"): (2, 3), (5, "fr"): (1, 3)}


def test_longest_run(spark):
    rows = [(1, ["a", "b", "b", "b", "a", "a"]), (2, []), (3, ["x"]), (4, None)]
    df = spark.createDataFrame(rows, "k int, w array<string>")
    assert {r.k: r.n for r in df.select("k", quality.longest_run(F.col("w")).alias("n")).collect()} == {1: 3, 2: 0, 3: 1, 4: None}
