"""Nearest neighbours, filter audit and conversation trie against brute force and their SQL."""

import hashlib
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumtext.llm import convtrie, filteraudit, multiindex
from quorumtext.runtime import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def brute_nearest(rows, k, every):
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for i, q in rows:
        if i % every == 0:
            found = sorted((-(q * v).sum(), j) for j, v in rows if j != i)
            out[i] = [(j, -s) for s, j in found[:k]]
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def nearest_of(df, **how):
    out = {}
    for r in multiindex.nearest(df, **how).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_nearest_keeps_its_recall_and_its_scores(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16)).astype(np.float32) * rng.uniform(0.2, 3, (3000, 1)).astype(np.float32)  # lengths differ, as inner products allow
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    want, got = brute_nearest([r for r in rows], 10, 20), nearest_of(vectors(spark, rows), k=10)
    assert set(got) == set(want)
    kept = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(abs(s - float((x[q].astype(float) * x[v].astype(float)).sum())) < 1e-12 and v != q for _, v, s in found)
        assert [s for *_, s in found] == sorted((s for *_, s in found), reverse=True)
        kept += len({v for _, v, _ in found} & {v for v, _ in want[q]})
    assert kept / (10 * len(want)) >= 0.9


def test_nearest_visits_a_part_of_clustered_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 16))[rng.integers(0, 60, 4000)] * 3 + rng.normal(size=(4000, 16)) * 0.2
    nodes = vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]).select(F.col("vec_id").alias("node"), F.col("embedding").alias("e"), F.array("vec_id").alias("ids"))
    index = multiindex.fit(nodes, 4000)
    nodes = multiindex.placed(nodes, index).cache()
    index = multiindex.with_sizes(index, nodes)
    assert index.sizes.sum() == 4000
    visits = multiindex.visits_for(index, nodes, nodes.where("node % 20 = 0").select("node", "e"), 200, 20)
    assert 21 <= visits < 800


def test_heap_stops_where_sorted_pairs_do():
    rng = np.random.default_rng(7)
    index = multiindex.Index(np.zeros((5, 1)), np.zeros((7, 1)), rng.integers(0, 4, (5, 7)))
    for visits in (1, 10, 30, int(index.sizes.sum()), 1000):
        d1, d2 = rng.normal(size=5), rng.normal(size=7)
        total = (d1[:, None] + d2[None]).ravel()
        order = np.argsort(total)
        held = np.cumsum(index.sizes.ravel()[order])
        want = total[order[np.searchsorted(held, visits)]] if held[-1] >= visits else np.inf
        assert index.stop(d1, d2, visits) == pytest.approx(want)


def test_nearest_on_copies_ties_and_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    same = [(i, [1.0, 2.0, 0.0]) for i in range(40, 100)]
    odd = [(0, [0.0, 0.0, 0.0]), (1, None), (2, [nan, 1.0, 1.0]), (3, [1.0, inf, 1.0]), (4, [1.0, None, 1.0]), (5, []), (6, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    rest = [(7, [2.0, 4.0, 0.0]), (8, [-1.0, 0.0, 1.0]), (20, [0.0, 0.0, 1.0]), (20, [0.0, 0.0, 1.0])]
    df = vectors(spark, [*same, *odd, *rest]).withColumns({"e": F.lit(1), "node": F.lit(2), "q": F.lit(3)})
    got = nearest_of(df, k=5)
    want = brute_nearest([*same, (7, [2.0, 4.0, 0.0]), (8, [-1.0, 0.0, 1.0]), (20, [0.0, 0.0, 1.0])], 5, 20)
    assert {q: [(v, s) for _, v, s in f] for q, f in got.items()} == want and set(got) == {20, 40, 60, 80}
    few = vectors(spark, [(20, [1.0]), (1, [2.0]), (2, [-3.0])])
    assert nearest_of(few) == {20: [(1, 1, 2.0), (2, 2, -3.0)]}
    assert nearest_of(few.limit(0)) == {} and nearest_of(few.where("vec_id <> 20")) == {}
    assert nearest_of(few.where("vec_id = 20")) == {}


def plain_audit(docs, labels):
    words = lambda t: t.translate({c: " " for c in range(9, 14)}).split(" ")
    good, toxic = ({d for d, *v in labels if v[k] == 1} for k in (0, 1))
    rows = []
    for d, text, source in docs:
        text = text or ""
        w = [x for x in words(text) if x]
        fails = set()
        if len(w) < 50:
            fails.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            fails.add("C")
        if any(c in "#$%&*|" for c in text):
            fails.add("D")
        if d is not None and any(o is not None and o < d and (t or "") == text for o, t, _ in docs):
            fails.add("E")
        rows.append((source or "", fails, d in good and d is not None, d in toxic and d is not None))
    out, lost = {}, {}
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in rows if r[0] == part and f in r[1]]
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in failing), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                lost[part, f] = lost.get((part, f), 0) + len(gone)
    return {k: (*v, lost[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_of(docs, labels):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filteraudit.audit(docs, labels).collect()}


def test_audit_equals_filters_run_in_every_order(spark):
    plenty = " ".join(f"w{i}" for i in range(60))
    docs = [(1, plenty, "s"), (2, plenty, "s"), (3, plenty.upper(), "t"), (4, "a " * 80, "s"), (5, plenty + " 50% #", "t"), (6, None, None), (7, "", ""), (8, "A B", None), (None, plenty, "s"), (1, plenty, "s"), (9, "x y​" + plenty, "t"), (10, "a\tb\x0bc\x0cd\r\n" * 20, "t"), (11, plenty + " word" * 60_000, "u"), (12, "É" * 30, "t"), (13, "a " * 80 + "$", "s")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (4, 0, 1), (6, 1, 1), (None, 1, 1), (13, 1, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit("x") for c in ("part", "sha", "word", "mask", "good", "n", "id")})
    got = audit_of(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(0)))
    assert got == plain_audit(docs, labels) and len(got) == 4 * 600
    assert audit_of(df.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")) == {}


def plain_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    new = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        new[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = {}
    for c, path in new.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
    out = set()
    for path, members in nodes.items():
        below = {p: m for p, m in nodes.items() if p[: len(path)] == path}
        children = [p for p in nodes if len(p) == len(path) + 1 and p[:-1] == path]
        leaves = sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in nodes) for p in below)
        saved = sum((len(m) - 1) * len(p[-1][1]) for p, m in below.items() if p)
        ends = ",".join(str(c) for c in sorted(members) if len(new[c]) == len(path))
        out.add((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_of(df):
    return [tuple(r) for r in convtrie.trie(convtrie.rebuilt(convtrie.turns_in_order(df))).collect()]


def test_trie_equals_a_plain_one(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "_PIECE", 8)  # ids of one node are packed in several strings
    rng = np.random.default_rng(8)
    rows = []
    for c in [-150, -7, 3, 50, *range(100, 130), 200, 201, 250, 999, 1000, 1001]:
        for turn in range(int(rng.integers(1, 9))):
            rows.append((c, turn, ["user", "assistant"][turn % 2], "".join(rng.choice(list("aé"), int(rng.integers(0, 2))))))
    rows += [(5, None, None, None), (5, 1, "user", "x" * 300_000), (None, 0, "user", "lost"), (2000, 0, "user", "")]
    rng.shuffle(rows)
    df = spark.createDataFrame([tuple(None if v is None else v if isinstance(v, str) else int(v) for v in r) for r in rows], "conv_id long, turn long, role string, text string").withColumns({c: F.lit(9) for c in ("pos", "depth", "p", "a", "h", "base", "tokens", "owner", "leaf")})
    got = trie_of(df)
    assert len(got) == len(set(got)) and set(got) == plain_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert trie_of(df.limit(0)) == []


def test_repeated_turns_and_ties_have_one_result(spark):
    rows = [(7, 1, "user", "b"), (7, 1, "user", "a"), (7, 1, "user", "a"), (7, None, "user", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    once = sorted(trie_of(df), key=str)
    assert once == sorted(trie_of(df.orderBy("text")), key=str) and max(r[1] for r in once) == 4 - min(4, zlib.crc32(b"7") % 6)


@pytest.mark.parametrize("name,module", [("op12_filter_audit", filteraudit), ("op13_conversation_trie", convtrie)])
def test_queries_equal_their_sql(spark, name, module):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    df = getattr(module, name)(spark, d)
    rel = con.execute(module.ORACLE)
    at = [[x[0] for x in rel.description].index(c) for c in df.columns]
    assert sorted(map(str, ([r[i] for i in at] for r in rel.fetchall()))) == sorted(str(list(r)) for r in df.collect())


@pytest.mark.parametrize("siblings", [15, 20, 2000])
def test_a_bad_section_is_blocked_beside_any_number_of_others(spark, siblings):
    """A section's verdict rests on its own labels; what else the site has changes nothing."""
    from quorumtext.llm import urlfilter

    names = spark.range(siblings).select(F.concat(F.lit("s"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("s"), F.col("id").alias("n"))
    pages = names.select("s", "n", F.explode(F.sequence(F.lit(1), F.lit(40))).alias("i"))
    pages = pages.select((F.col("n") * 100 + F.col("i")).alias("page_id"), F.concat(F.lit("http://site.org/"), "s", F.lit("/"), "i").alias("url"), (F.col("n") == 3).cast("int").alias("bad"))
    got = urlfilter.filter_urls(pages.select("page_id", "url"), labels=pages.select("page_id", "bad"))
    bad = got.join(pages.select("page_id", "bad"), "page_id").groupBy("bad", "verdict").count().collect()
    assert {(r.bad, r.verdict): r["count"] for r in bad} == {(1, "block"): 40, (0, "allow"): 40 * (siblings - 1)}


def test_deep_and_long_paths_are_read_to_their_ends(spark):
    from quorumtext.llm import urlfilter

    deep = "/".join(f"d{chr(97 + i % 26)}" for i in range(12))
    rows = [(i, f"http://a.org/{deep}/{'bad' if i % 2 else 'good'}/{i}") for i in range(40)] + [(90, "http://b.org/" + "x/" * 1000), (91, "http://c.org/" + "y" * 300_000)] + [(92 + i, "http://d.org/" + "z/" * 500 + "e") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id int, url string")
    got = {r.page_id: r for r in urlfilter.filter_urls(pages, labels=pages.where("page_id < 40").select("page_id", (F.col("page_id") % 2).alias("bad"))).collect()}
    assert len(got) == 48
    assert {got[i].verdict for i in range(1, 40, 2)} == {"block"} and {got[i].verdict for i in range(0, 40, 2)} == {"allow"}
    assert got[1].template == f"/{deep}/bad/<n>" and got[90].template == "/" + "*/" * 1000 and got[91].template == "/*" and got[92].template == "/" + "z/" * 500 + "e"
