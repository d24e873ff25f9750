"""The sweep, one-to-one matching and pruned profile search against all pairs and all permutations."""

import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumtext.operators import naming, speakers, sweep


@pytest.mark.parametrize("width", [0.5, 60.0])
def test_the_sweep_sees_all_that_a_nested_loop_does(spark, width):
    rng = random.Random(1)
    places = [(rng.choice(["a", "b", None]), rng.choice([None, *range(40)]), i) for i in range(300)]
    held = [(rng.choice(["a", "b", None]), *sorted((rng.randrange(-5, 40), rng.randrange(-5, 40))), f"s{rng.randrange(5)}") for _ in range(80)] + [("a", None, 3, "x"), ("a", 3, None, "x"), ("b", -100, 900, "long")]
    points = spark.createDataFrame([(k, None if t is None else float(t), i) for k, t, i in places], "k string, t double, active int").repartition(3)
    intervals = spark.createDataFrame([(k, None if s is None else float(s), None if e is None else float(e), n) for k, s, e, n in held], "k string, s double, e double, name string")
    out = sweep.active_at(points, intervals, ["k"], "t", "s", "e", ["name"], width / 64)
    assert out.columns == ["k", "t", "active", "_active"] and out.count() == 300
    got = {r["active"]: sorted((x.start, x.end, x.name) for x in r["_active"]) for r in out.collect()}
    for k, t, i in places:
        assert got[i] == sorted((s, e, n) for j, s, e, n in held if k is not None and j == k and None not in (s, e, t) and s <= t < e)
    best = speakers.point_in_interval(points.withColumnRenamed("active", "i"), intervals, ["k"], "t", "s", "e", width, ["name"])
    for r in best.collect():
        assert r["name"] == max(((s, -e, n) for s, e, n in got[r.i]), default=(None,))[-1]
    assert sweep.active_at(points.limit(0), intervals, ["k"], "t", "s", "e", ["name"]).count() == 0
    assert {len(r["_active"]) for r in sweep.active_at(points, intervals.limit(0), ["k"], "t", "s", "e", ["name"]).collect()} == {0}


def test_crosstalk_names_everyone_who_speaks(spark):
    w = spark.createDataFrame([("v", 0, "a", 0.5), ("v", 1, "b", 1.5), ("v", 2, "c", 3.0)], "video_id string, pos int, word string, t0 double")
    seg = spark.createDataFrame([("v", 0.0, 2.0, "B"), ("v", 1.0, 3.0, "A"), ("v", 1.0, 2.5, "A"), ("v", 1.0, 2.5, None)], "video_id string, t0 double, t1 double, spk string")
    assert [r.speakers for r in speakers.crosstalk(w, seg).orderBy("pos").collect()] == [["B"], ["A", "B"], []]


def test_matching_equals_all_permutations():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n, m = rng.integers(1, 6, 2)
        gain = rng.integers(0, 9, (n, m)).astype(float)
        if rng.random() < 0.5:
            gain *= rng.random((n, m)) < 0.5
        to = naming.best_matching(gain)
        used = to[to >= 0]
        assert len(set(used)) == len(used)
        wide = np.zeros((n, max(n, m)))
        wide[:, :m] = gain
        assert sum(gain[i, k] for i, k in enumerate(to) if k >= 0) == max(sum(wide[i, p[i]] for i in range(n)) for p in permutations(range(wide.shape[1]), int(n)))


def test_voices_take_one_name_each(spark):
    rows = [("v", "s0", "Ali", 9.0), ("v", "s1", "Ali", 8.0), ("v", "s1", "Abu", 7.0), ("v", "s2", None, 5.0), ("w", "s0", "Ali", 1.0), ("w", "s0", "Ali", 1.0), ("w", None, "Abu", 1.0), ("w", "s9", "Abu", None)]
    df = spark.createDataFrame(rows, "video_id string, spk string, speaker string, weight double")
    got = sorted((r.video_id, r.spk, r.speaker, r.weight) for r in naming.matched_names(df).collect())
    assert got == [("v", "s0", "Ali", 9.0), ("v", "s1", "Abu", 7.0), ("v", "s2", None, 0.0), ("w", "s0", "Ali", 2.0), ("w", "s9", None, 0.0)]
    assert naming.matched_names(df.limit(0)).count() == 0


def test_errors_of_voices_whatever_they_are_called(spark):
    text = [f"w{i}" for i in range(40)]
    kinds = "video_id string, pos int, word string, speaker string"
    gold = [("v", i, w, "Ali" if i < 25 else "Abu") for i, w in enumerate(text)]
    told = [("v", i, w, "spk7" if j < 23 else "spk3") for i, (j, w) in enumerate((j, w) for j, w in enumerate(text) if not 5 <= j < 10)] + [("v", 99, "more", "spk3")]
    r = naming.diarisation_errors(spark.createDataFrame(told, kinds), spark.createDataFrame(gold, kinds)).first()
    assert (r.n_wrong, r.n_words, r.n_unmatched) == (2, 35, 1)  # two words before the change, by their text
    assert speakers.label_errors(spark.createDataFrame(told, kinds), spark.createDataFrame(gold, kinds)).first().n_wrong == 35


@pytest.mark.parametrize("most", [10_000, 50])  # in one block, and in many
def test_profiles_equal_brute_force_and_most_are_not_compared(spark, most):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    known = [(f"p{i:03}", (centres[i % 12] + rng.normal(size=8) * 0.05).tolist()) for i in range(200)]
    known += [("twin", known[5][1]), ("scaled", [7 * x for x in known[6][1]]), (None, known[0][1]), ("zero", [0.0] * 8), ("none", None), ("nan", [float("nan")] * 8), ("flat", [1.0, 2.0])]
    voices = [("v", f"s{i}", (centres[i % 12] + rng.normal(size=8) * 0.05).tolist()) for i in range(60)] + [("v", "same", known[5][1]), ("v", "none", None), ("v", "zero", [0.0] * 8), ("v", "flat", [2.0, 4.0]), ("v", "long", [1.0] * 9)]
    v = spark.createDataFrame(voices, "video_id string, spk string, embedding array<double>")
    p = spark.createDataFrame(known, "speaker string, embedding array<double>")
    got = {r.spk: r for r in naming.nearest_profile(v, p, most).collect()}
    unit = lambda x: np.array(x) / np.linalg.norm(x)
    sound = [(n, unit(e)) for n, e in known if n and e and len(e) == 8 and np.isfinite(e).all() and any(e)]
    for _, spk, e in voices[:61]:
        best = max((round(float(unit(e) @ u), 9), n) for n, u in sound)
        assert abs(got[spk].similarity - best[0]) < 1e-8 and got[spk].speaker == best[1], spk
    assert got["same"].speaker == "twin" and got["flat"].speaker == "flat"
    assert {got[s].speaker for s in ("none", "zero", "long")} == {None}
    if most > 200:
        assert sum(got[f"s{i}"].n_compared for i in range(60)) / 60 < 0.4 * 202
    assert {r.speaker for r in naming.nearest_profile(v, p.limit(0)).collect()} == {None}
    assert naming.nearest_profile(v.limit(0), p).count() == 0


def test_a_task_holds_one_block_of_profiles(spark):
    """Blocks follow each other in jobs of their own, so the workers of many never run at once."""
    rng = np.random.default_rng(4)
    rows = lambda n: [(f"p{i:03}", rng.normal(size=4).tolist()) for i in range(n)]
    p = spark.createDataFrame(rows(90), "speaker string, embedding array<double>")
    v = spark.createDataFrame([("v", *r) for r in rows(20)], "video_id string, spk string, embedding array<double>")
    many, one = (naming.nearest_profile(v, p, most) for most in (20, 100))
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") <= 1
    found = lambda x: sorted((r.spk, r.speaker, round(r.similarity, 12)) for r in x.collect())
    assert found(many) == found(one)


def test_clashing_columns_of_points(spark):
    points = spark.createDataFrame([("k", 1.0, 7)], "k string, t double, row int").withColumns({c: F.lit(3) for c in ("part", "item", "k0", "found", "_active")})
    intervals = spark.createDataFrame([("k", 0.0, 2.0, "n")], "k string, s double, e double, name string")
    out = speakers.point_in_interval(points, intervals, ["k"], "t", "s", "e", 1.0, ["name"])
    assert out.columns == [*points.columns, "name"] and tuple(out.first()) == ("k", 1.0, 7, 3, 3, 3, 3, 3, "n")
