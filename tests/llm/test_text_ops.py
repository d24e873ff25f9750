"""Decontamination, line dedup, passages and near copies against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quorumtext.llm import decontam, linededup, simhash, substring
from quorumtext.runtime import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def frame(spark, texts):
    """Documents with extra columns whose names the operators use inside."""
    rows = [(i, t, i, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, line int, key string, first string")


def bench_words(t):
    low = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode()
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow_hits(docs, items, window=10):
    out = {}
    for i, t in enumerate(docs):
        w, hit, names = bench_words(t), set(), set()
        for item, x in items:
            v = bench_words(x)
            n = min(window, len(v))
            for a in range(len(v) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[a : a + n]:
                        hit |= set(range(p, p + n))
                        names.add(str(item))
        out[i] = (len(w), len(hit), sorted(names))
    return out


@pytest.mark.parametrize("block", [200_000, 12])
def test_decontamination(spark, block):
    r = random.Random(3)
    words = [f"w{i}" for i in range(12)] + ["É", "ñ9"]
    item = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, item(n)) for i, n in enumerate([14, 10, 3, 1, 25, 12])] + [(7, None), (8, ""), (9, "--- !"), (10, "Zz " * 11)]
    texts = [None, "", "... ", items[0][1].upper(), "x " + items[4][1] + " y", items[1][1] + "!" + items[1][1], items[2][1], "zz-" * 30, items[4][1][:-4], item(3000)]
    got = decontam.decontaminate(frame(spark, texts), spark.createDataFrame(items, "item_id int, text string"), block_windows=block)
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got.collect()} == slow_hits(texts, items)


def test_decontamination_is_the_same_for_any_block(spark):
    """Repeated and null ids, an item without id, one item of very many windows."""
    item = " ".join(f"u{i}" for i in range(300))
    items = [(1, item), (2, "one two three four five six seven eight nine ten eleven"), (None, "p q r"), (2, "lone")]
    docs = [(1, "four words stand here"), (1, "x one two three four five six seven eight nine ten eleven y"), (None, "one two three four five six seven eight nine ten eleven"), (None, "p q r lone"), (None, None), (3, item), (3, item), (4, "")]
    frames = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
    got = [sorted((str(r.doc_id), r.n_words, r.n_hit, str(r["items"]), str([tuple(x) for x in r.ranges])) for r in decontam.decontaminate(*frames, block_windows=b).collect()) for b in (200_000, 120)]
    assert got[0] == got[1]
    assert [g[:4] for g in got[0]] == sorted([("1", 4, 0, "[]"), ("1", 13, 11, "['2']"), ("None", 11, 11, "['2']"), ("None", 4, 4, "['2']"), ("None", 0, 0, "[]"), ("3", 300, 300, "['1']"), ("3", 300, 300, "['1']"), ("4", 0, 0, "[]")])


@pytest.mark.parametrize("block", [200_000, 1])
def test_a_window_of_very_many_items(spark, block):
    """One window in 300,000 items, beside one of its own in a few."""
    n = 300_000 if block > 1 else 40
    items = spark.range(n).select(F.col("id").alias("item_id"), F.when(F.col("id") < 3, F.concat(F.lit("x"), "id")).otherwise(F.lit("p q r")).alias("text"))
    docs = spark.createDataFrame([(1, "a p q r"), (2, "X1 p q r b"), (3, "p q"), (4, "x0, x2")], "doc_id int, text string")
    digest = lambda ids: hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256) for r in decontam.decontaminate(docs, items, block_windows=block, with_items=False).collect()}
    assert got == {1: (3, n - 3, digest(range(3, n))), 2: (4, n - 2, digest([1, *range(3, n)])), 3: (0, 0, digest([])), 4: (2, 2, digest([0, 2]))}
    assert [r.doc_id for r in decontam.without_items(docs, items, block_windows=block).collect()] == [3]


def test_joined_digest_of_sorted_strings(spark, monkeypatch):
    from quorumtext.llm import digest

    monkeypatch.setattr(digest, "PIECE", 10)
    rows = [(k, f"é{i}" if i % 7 == 0 else str(i)) for k in ("a", "b") for i in range(200)] + [("c", "")]
    got = {r.k: (r.n, r.sha256) for r in digest.joined_sha256(spark.createDataFrame(rows, "k string, x string"), "k", "x").collect()}
    for k in ("a", "b", "c"):
        own = sorted(x for j, x in rows if j == k)
        assert got[k] == (len(own), hashlib.sha256(",".join(own).encode()).hexdigest())


def test_decontamination_without_rows(spark):
    docs, none = frame(spark, ["a b"]), spark.createDataFrame([], "item_id int, text string")
    assert [(r.n_words, r.n_hit) for r in decontam.decontaminate(docs, none).collect()] == [(2, 0)]
    assert decontam.decontaminate(docs.limit(0), none).collect() == []


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_line_dedup(texts, least):
    first = {}
    for d, t in enumerate(texts):
        for i, x in enumerate(t.split("\n") if t is not None else []):
            if x:
                first.setdefault(x, (d, i))
    near = {x for x in first for y in first if min(len(x), len(y)) >= least and first[y] < first[x] and distance_one(x, y)}
    out = []
    for d, t in enumerate(texts):
        if t is None:
            out.append(None)
            continue
        out.append("\n".join(x for i, x in enumerate(t.split("\n")) if not x or (first[x] == (d, i) and x not in near)))
    return out


def test_line_dedup(spark):
    r = random.Random(5)
    base = ["".join(r.choice("abé ") for _ in range(r.randrange(20, 40))) for _ in range(12)] + ["a" * 30, "ab" * 15, "x" * 2000]

    def edited(x):
        i = r.randrange(len(x))
        return r.choice([x, x[:i] + x[i + 1 :], x[:i] + "z" + x[i:], x[:i] + "q" + x[i + 1 :], x[::-1], x + "ab"])

    texts = [None, "", "\n", "short\nshort", "shor\nshort\n", base[0] + "\n" + base[0]] + ["\n".join(edited(r.choice(base)) for _ in range(r.randrange(1, 6))) for _ in range(60)]
    got = linededup.remove_lines(frame(spark, texts)).orderBy("doc_id").collect()
    want = slow_line_dedup(texts, 20)
    assert [g.text for g in got] == want
    assert [(g.n_lines, g.n_removed) for g in got[:6]] == [(0, 0), (1, 0), (2, 0), (2, 1), (3, 1), (2, 1)]
    assert got[0].key == "x"
    assert linededup.remove_lines(frame(spark, ["a"]).limit(0)).collect() == []


def test_line_dedup_of_repeated_rows_and_null_ids(spark):
    x = "a line of more than twenty characters"
    docs = spark.createDataFrame([(1, x), (1, x), (None, x + "\n" + x), (2, x + "!"), (None, None)], "doc_id int, text string")
    got = sorted((str(r.doc_id), str(r.text)) for r in linededup.remove_lines(docs).collect())
    assert got == [("1", x), ("1", x), ("2", ""), ("None", "None"), ("None", x)]  # a null id comes before or after no other


def test_keys_of_both_bases_tell_the_same_lines_apart():
    lines = linededup.Lines.of(["abcd", "abxd", "abd", "zbcd"])
    at, a = np.array([0, 1, 2, 3, 0]), np.array([2, 2, 0, 0, 0])
    for turn in (0, 1):
        key = lines.without(at, a, np.array([3, 3, 0, 1, 1]), np.zeros(5, np.int64), turn)
        assert key[0] == key[1] == key[2] and key[3] == key[4] != key[0]


def passages(seed):
    r = random.Random(seed)
    words = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    hot, near = words(60), words(120).split()
    texts = [None, "", words(30), words(400), words(4000)]
    texts += [words(r.randrange(5, 200)) + " " + hot + " " + words(r.randrange(5, 200)) for _ in range(30)]
    for _ in range(6):
        own = list(near)
        for i in r.sample(range(120), 2):
            own[i] = "zzzzz"
        texts.append(words(50) + " " + " ".join(own) + " " + words(50))
    texts += [words(40) + " " + " ".join(hot.split()[:40]) + " " + words(40), "do re mi " * 100, "do re mi " * 60]
    return texts


def test_passages(spark):
    texts = passages(11)
    got = {r.doc_id: r.class_id for r in substring.repeated_passages(frame(spark, texts)).collect()}
    hot, near, loop = range(5, 35), range(35, 41), (42, 43)
    assert {got.get(i) for i in hot} == {5} and {got.get(i) for i in near} == {35} and {got.get(i) for i in loop} == {42}
    assert set(got) == {*hot, *near, *loop}
    assert substring.repeated_passages(frame(spark, texts).limit(0)).collect() == []


def test_exact_windows_behind_another_representative(spark):
    """A shared signature whose representative holds another passage still links the rest."""
    r = random.Random(1)
    words = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    p = words(55)
    docs = spark.createDataFrame([(i, words(80) + " " + p + " " + words(80)) for i in range(3)] + [(9, words(300))], "doc_id long, text string")
    t = substring.MIN_WORDS - substring.SHINGLE + 1
    cells = spark.createDataFrame([(i, 76, 86) for i in range(3)] + [(9, 0, 5)], "doc_id long, x0 int, x1 int")
    h = substring._whole_windows(cells, docs, t).groupBy("h").agg(F.count("*").alias("n")).where("n = 3")
    assert h.count() == 6  # 51 tokens hold six windows of 46


def test_exact_passage_beside_a_verified_one(spark):
    """u has P and Q, its representative v most of P's words and Q, w only P: w is linked to u by P."""
    r = random.Random(8)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    texts = []
    for _ in range(40):
        p, q = words(50), words(50)
        texts += [" ".join(p[:42] + words(1) + q), " ".join(q + words(60) + p + words(30)), " ".join(words(120) + p + words(60))]
    got = {x.doc_id: x.class_id for x in substring.repeated_passages(frame(spark, texts)).collect()}
    assert [got.get(3 * i + 2) for i in range(40)] == [3 * i for i in range(40)]


def test_recall_of_changed_passages(spark):
    """Passages of 50 words at a token similarity of about 0.8, in long texts of their own."""
    r = random.Random(9)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    texts = []
    for _ in range(100):
        p = words(50)
        changed = p[:25] + ["zz"] + p[26:]  # 5 of 46 tokens differ: 41 / 51 = 0.804
        texts += [" ".join(words(80) + x + words(80)) for x in (p, changed)]
    got = {x.doc_id: x.class_id for x in substring.repeated_passages(frame(spark, texts)).collect()}
    assert sum(got.get(2 * i + 1) == 2 * i for i in range(100)) >= 95


@pytest.mark.parametrize("size,groups", [(6, 40), (30, 6)])
def test_recall_in_groups_of_changed_passages(spark, size, groups):
    """A passage and variants of it with one word changed, in texts of their own; links are all pairs at a similarity of 0.8."""
    r = random.Random(size)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    texts, own = [], []
    for _ in range(groups):
        base = words(50)
        for k in range(size):
            p = list(base)
            if k:
                p[r.randrange(50)] = words(1)[0]
            own.append(p)
            texts.append(" ".join(words(r.randrange(20, 120)) + p + words(r.randrange(20, 120))))
    order = list(range(len(texts)))
    r.shuffle(order)
    got = {order[x.doc_id]: x.class_id for x in substring.repeated_passages(frame(spark, [texts[i] for i in order])).collect()}
    sets = [{tuple(p[i : i + 5]) for i in range(46)} for p in own]
    links = [(i, j) for g in range(groups) for i in range(g * size, (g + 1) * size) for j in range(i) if j >= g * size and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    kept = sum(got.get(i, -1) == got.get(j, -2) for i, j in links)
    assert kept >= 0.95 * len(links) and len(links) >= groups * (size - 1)
    for i, c in got.items():  # none joined wrongly
        assert order[c] // size == i // size


def test_sliding_minima():
    v = np.random.default_rng(0).integers(0, 1000, 300).astype(np.uint64)
    for t in (1, 2, 7, 46, 64, 300):
        assert (substring.sliding_minima(v, t) == [v[i : i + t].min() for i in range(len(v) - t + 1)]).all()


def test_no_pair_of_a_signature_is_left_out(spark):
    """Chains of texts of which only neighbours are similar: all pairs with a common signature and a passage are of one class."""
    r = random.Random(5)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    texts = []
    for _ in range(25):
        p = words(50)
        for k in range(10):
            texts.append(" ".join(words(r.randrange(20, 120)) + p + words(r.randrange(20, 120))))
            p = [*p[: 5 * k + 2], *words(1), *p[5 * k + 3 :]]
    r.shuffle(texts)
    docs = frame(spark, texts)
    got = {x.doc_id: x.class_id for x in substring.repeated_passages(docs).collect()}
    t = substring.MIN_WORDS - substring.SHINGLE + 1
    met = set()
    for band in substring.BANDS:
        for x in substring._windows(docs, t, band).groupBy("key").agg(F.collect_set("doc_id").alias("own")).where("size(own) > 1").collect():
            met |= {(a, b) for a in x.own for b in x.own if a > b}
    pairs = spark.createDataFrame(sorted(met), "u long, v long")
    links = {(x.u, x.v) for x in substring._compared(pairs, docs, t).collect()}
    assert len(links) > 200 and [(u, v) for u, v in sorted(links) if got.get(u, -1) != got.get(v, -2)] == []


@pytest.mark.parametrize("block", [512, 32])
def test_texts_of_runs_are_not_compared_in_pairs(spark, monkeypatch, block):
    """Texts of repeated words share signatures in great number, passages of 50 words seldom: just the pairs with tokens enough are compared."""
    monkeypatch.setattr(substring, "BLOCK", block)
    r = random.Random(13)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(40)]
    texts = [" ".join(w for _ in range(5) for w in [r.choice(vocabulary)] * r.randrange(24, 36)) for _ in range(150)]
    t = substring.MIN_WORDS - substring.SHINGLE + 1
    members = spark.createDataFrame([(7, i, i // 2, len(x)) for i, x in enumerate(texts)], "key long, doc_id long, c long, size int")
    got = sorted((x.u, x.v) for x in substring._alike(members, frame(spark, texts), t).collect())
    counts = [Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (x.split() for x in texts)]
    all_pairs = [(u, v) for u in range(150) for v in range(u) if u // 2 != v // 2]
    assert got == [(u, v) for u, v in all_pairs if sum(min(t, n, counts[v][x]) for x, n in counts[u].items()) >= 41]
    assert 0 < len(got) < len(all_pairs) / 5


def test_common_tokens():
    r = random.Random(3)
    texts = [" ".join(w for _ in range(r.randrange(1, 7)) for w in [r.choice("abcde")] * r.randrange(1, 70)) for _ in range(60)] + ["", None]
    words = [(x or "").split() for x in texts]
    counts = [Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in words]
    got = substring.common_tokens(pa.array(texts), 46)
    assert all(got[i, j] == sum(min(46, n, counts[j][x]) for x, n in counts[i].items()) for i in range(len(texts)) for j in range(i))


def test_near_copies(spark):
    r = random.Random(2)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    base = [words(300) for _ in range(15)]
    texts, group = [], []
    for k, b in enumerate(base):
        texts.append(" ".join(b))
        group.append(k)
        for _ in range(3):
            own = list(b)
            for i in r.sample(range(300), 3):  # at most 15 of 296 shingles: a similarity of 0.9
                own[i] = "zz"
            texts.append(" ".join(own))
            group.append(k)
    texts += ["", None]
    got = {r.doc_id: r.component_id for r in simhash.near_copies(frame(spark, texts)).collect()}
    n = len(group)
    assert all(got[i] // 4 == group[i] for i in range(n))
    assert np.mean([got[i] == 4 * group[i] for i in range(n)]) >= 0.95
    assert got[n] == got[n + 1] == n


def test_no_pair_of_a_fingerprint_is_left_out(spark):
    """Variants of a text that is not there, few of them similar: all pairs at 0.8 with a common fingerprint are of one component."""
    r = random.Random(6)
    words = lambda n: ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    own = []
    for _ in range(10):
        base = words(70)
        for _ in range(40):
            own.append(list(base))
            for i in r.sample(range(70), 1):
                own[-1][i] = words(1)[0]
    r.shuffle(own)
    docs = frame(spark, [" ".join(w) for w in own])
    got = {x.doc_id: x.component_id for x in simhash.near_copies(docs).collect()}
    bands = {x.doc_id: set(x.bands) for x in simhash._set_prints_of(docs.select("doc_id", "text")).collect()}
    sets = [shingles(w) for w in own]
    links = [(i, j) for i in range(len(own)) for j in range(i) if bands[i] & bands[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(links) > 200 and [(i, j) for i, j in links if got[i] != got[j]] == []


def near_pairs(seed):
    """Pairs of texts with the Jaccard similarity of their five-word shingles: blocks added and cut, words changed."""
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    words = lambda n: [r.choice(vocabulary) for _ in range(n)]
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    out = []
    for n in (100, 200, 600):
        for _ in range(25):
            base, at = words(n), r.randrange(n)
            changed = list(base)
            for i in r.sample(range(n), n // 50):
                changed[i] = "zz"
            for other in (base[:at] + words(n // 6) + base[at:], base + words(n // 10), base[n // 7 :], changed, base + words(n // 2), base[: n * 7 // 10]):
                a, b = shingles(base), shingles(other)
                out.append((" ".join(base), " ".join(other), len(a & b) / len(a | b)))
    return out


def test_near_copies_by_true_similarity(spark):
    """Added, cut and changed blocks at 0.8 and more are linked; pairs at 0.6 to 0.75 stay apart."""
    pairs = near_pairs(4)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(frame(spark, [t for a, b, _ in pairs for t in (a, b)])).collect()}
    # each base comes in six pairs, once as a text of its own: equal texts are one node
    linked = [got[2 * i] == got[2 * i + 1] for i in range(len(pairs))]
    near = [x for x, (_, _, j) in zip(linked, pairs, strict=True) if j >= 0.8]
    far = [x for x, (_, _, j) in zip(linked, pairs, strict=True) if 0.6 <= j <= 0.75]
    assert len(near) > 200 and np.mean(near) >= 0.98
    assert len(far) > 50 and not any(far)


def test_contract_digest_of_no_items(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.array_join(F.array().cast("array<string>"), ","), 256)).first()[0]


def test_passages_whose_tokens_lie_far_apart():
    """A window matched half at one end of the other text and half at the other is no passage."""
    r = np.random.default_rng(3)
    x, gap = r.integers(1, 1 << 60, 46).astype(np.uint64), r.integers(1, 1 << 60, 500).astype(np.uint64)
    other = np.concatenate([x[:23], gap, x[23:]])
    assert substring.shared_passages(x, other, 46) == []
    assert substring.shared_passages(x, np.concatenate([gap, x, gap]), 46) == [(0, 45, 500, 545)]
