import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quorumtext.llm import simhash as S
from quorumtext.llm.graph import connected_components
from quorumtext.runtime import ship_package


def slow_fingerprint(text):
    import re

    low = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    sh = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def slow_components(fps, radius=4):
    top = {i: i for i in fps}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(fps)
    for x in ids:
        for y in ids:
            if x < y and (fps[x] ^ fps[y]).bit_count() <= radius:
                a, b = sorted((find(x), find(y)))
                top[b] = a
    return {i: find(i) for i in ids}


TEXTS = ["", None, "one", "A b\tC\nd", "a b c d", "a  b c d e", "É é A", "word " * 9000, " \x0b\x0c ", "a b c"]


def test_fingerprint_equals_its_definition():
    for t in TEXTS:
        assert S.fingerprint(t) == slow_fingerprint(t)


def test_fingerprint_hash_is_sparks_own(spark):
    h = spark.createDataFrame([("a b c é",)], "t string").select(F.xxhash64("t").alias("h")).first().h
    assert h & (1 << 64) - 1 == xxhash.xxh64_intdigest("a b c é".encode(), 42)


def families(seed, n, flips):
    r = random.Random(seed)
    fps = {}
    for i in range(n):
        base = r.getrandbits(64) if i % 3 == 0 or not fps else fps[r.choice(list(fps))]
        for _ in range(r.randrange(flips)):
            base ^= 1 << r.randrange(64)
        fps[i + 7] = base
    return fps


@pytest.mark.parametrize("seed,max_shard", [(1, 8192), (2, 5)])
def test_components_equal_brute_force(spark, seed, max_shard):
    fps = families(seed, 300, 7)
    rows = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in fps.items()], "doc_id long, fp long")
    ship_package(spark)
    got = {r.doc_id: r.component_id for r in S.near_duplicates(rows, max_shard=max_shard).collect()}
    assert got == slow_components(fps)


def test_forest_finds_all_pairs():
    fps = np.array(sorted(set(families(5, 500, 6).values())), np.uint64)
    want = {(i, j) for i in range(len(fps)) for j in range(len(fps)) if i != j and int(fps[i] ^ fps[j]).bit_count() <= 4}
    got = {(int(a), int(b)) for q, at in S.Forest(np.zeros(len(fps), np.int64), fps).within(4) for a, b in zip(q, at)}
    assert got == want


def test_whole_path_with_odd_rows(spark):
    ship_package(spark)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "A b\tC\nd"), (None, "one")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, fp int, node string")
    got = S.near_duplicates(S.fingerprints(docs)).collect()
    assert len(got) == len(rows)
    want = slow_components({i: slow_fingerprint(t) for i, t in enumerate(TEXTS)})
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    empty = S.near_duplicates(S.fingerprints(docs.limit(0)))
    assert empty.collect() == []


def test_components_of_a_chain(spark):
    n = 40
    e = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5, 5), (100, 90), (None, 3)], "u long, v long")
    got = {r.node: r.component for r in connected_components(e).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {100: 90, 90: 90}
