"""Columns that are called like the operators' own, null and repeated ids, empty tables; pseudonyms by a plain Feistel network."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quorumtext.llm import linededup, pii, quality, toxicity
from quorumtext.runtime import ship_package

NAMES = ("id", "_id", "found", "new", "gone", "gone_id", "done", "scores", "toxicity", "copy_id", "_gone_id", "_found", "_out", "n_hit", "items", "c0")


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, null and empty and long texts, and clashing columns."""
    ship_package(spark)
    rows = [(1, "me@x.org writes\na line of more than twenty characters", "en", "s", 50), (1, "me@x.org writes\na line of more than twenty characters", "en", "s", 50), (None, "4539148803436467", None, None, None), (None, None, "en", "s", 0), (2, "", "de", "s", 0), (3, "word " * 60_000, "en", "t", 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit(i) for i, c in enumerate(NAMES)}).cache()


@pytest.mark.parametrize("name", ["op3", "op7", "op8", "op10"])
def test_operators_pass_clashing_columns_on(spark, odd, name):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, toxic int").withColumn("quality", F.col("toxic"))
    run = {
        "op3": lambda d: quality.score(d, quality.train(d, labels)),
        "op7": pii.pseudonymise,
        "op8": linededup.remove_lines,
        "op10": lambda d: toxicity.score(d, toxicity.train(d, labels)),
    }[name]
    out = run(odd)
    assert out.columns[: len(odd.columns)] == odd.columns
    assert out.select(*NAMES).distinct().collect() == [tuple(range(len(NAMES)))] and out.count() == 6
    assert run(odd.limit(0)).count() == 0


def plain_string(value, key, kind):
    half = (len(value) + 1) // 2
    sides = [value[:half], value[half:]]
    for turn in range(pii.ROUNDS):
        own, other, out = sides[turn % 2], sides[1 - turn % 2], ""
        for i, c in enumerate(own):
            stream = hashlib.sha256(f"{key}|{kind}|{turn}|{i // 16}|{other}".encode()).hexdigest()
            by = int(stream[i % 16 * 4 : i % 16 * 4 + 4], 16)
            if c in "0123456789":
                c = "0123456789"[(int(c) + by) % 10]
            elif c.lower() in "abcdefghijklmnopqrstuvwxyz":
                low = "abcdefghijklmnopqrstuvwxyz"[(ord(c.lower()) - 97 + by) % 26]
                c = low if c == c.lower() else low.upper()
            out += c
        sides[turn % 2] = out
    return "".join(sides)


def plain_number(value, left, right, key, kind):
    sides = [value // right, value % right]
    for turn in range(pii.ROUNDS):
        drawn = int(hashlib.sha256(f"{key}|{kind}|{turn}|0|{sides[1 - turn % 2]}".encode()).hexdigest()[:12], 16)
        sides[turn % 2] = (sides[turn % 2] + drawn) % (left, right)[turn % 2]
    return sides[0] * right + sides[1]


def test_pseudonyms_equal_a_plain_feistel_network(spark):
    values = ["a", "Ab9", "me.x9", "4539148803436467", "0123456789", "Zz.-9" * 9]
    got = spark.createDataFrame([(v,) for v in values], "v string").select("v", pii.permute_string(F.col("v"), "k", "t").alias("x"))
    assert {r.v: r.x for r in got.collect()} == {v: plain_string(v, "k", "t") for v in values}
    got = spark.range(0, 146_097, 997).select("id", pii.permute_number(F.col("id"), 189, 773, "k", "date").alias("x"))
    assert {r.id: r.x for r in got.collect()} == {i: plain_number(i, 189, 773, "k", "date") for i in range(0, 146_097, 997)}


def test_stages_pass_clashing_columns_on(spark, odd, tmp_path):
    import corpus_pipeline as P

    d = str(tmp_path)
    spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "not in any text of these")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    for name, stage in P.STAGES:
        out = stage(spark, odd, d)
        if name != "sentencepiece":
            assert out.columns == odd.columns and {r[0] for r in out.select("c0").collect()} == {len(NAMES) - 1}, name
        assert stage(spark, odd.limit(0), d).count() == 0, name


def test_columns_to_keep_may_not_be_called_like_results(spark):
    from quorumtext.llm import media, spiece

    docs = spark.createDataFrame([(1, "a", b"")], "doc_id int, text string, media binary").withColumns({"Tokens": F.array(F.lit(1)), "payload": F.lit(1)})
    for make in (lambda: spiece.encode(docs, keep=("doc_id", "Tokens")), lambda: spiece.decode(docs, keep=("text",), column="Tokens"), lambda: media.encode_media(docs, keep=("media",)), lambda: media.decode_media(docs, keep=("payload",))):
        with pytest.raises(ValueError):
            make()
