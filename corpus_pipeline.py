"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

toxicity, line dedup, near-dedup of verified shingle similarity, benchmark decontamination, SentencePiece encoding
and decoding. All stages but the last return the columns of ``documents``; rows leave by a
stage's decision only.

Edge cases: a null text is never toxic, cut or contaminated, and in near-dedup it counts as
empty. Empty texts, also those that line dedup has emptied, are copies of each other, so one
of them stays. Rows with one doc_id are one document in line dedup and near-dedup; rows
without one stay there. Toxicity and decontamination judge each row by itself. Extra columns,
whatever they are called, are passed on by the first four stages; the last returns a fixed
set. An empty table passes through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumtext.llm import decontam, linededup, simhash, spiece, toxicity
from quorumtext.runtime import shared_checkpoint_dir, ship_package, table, unused


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the classifier, trained on the labelled ones, does not call toxic."""
    ship_package(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    to = unused(docs.columns, "toxicity")
    return toxicity.score(docs, model, to=to).where(F.col("text").isNull() | (F.col(to) < 0.5)).drop(to)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one has (long ones up to one edit apart); n_chars follows the text."""
    ship_package(spark)
    out = linededup.remove_lines(docs, counts=False)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; rows without an id stay."""
    ship_package(spark)
    name = unused(docs.columns, "copy_id")
    out = simhash.near_copies(docs).where("doc_id <> component_id").select(F.col("doc_id").alias(name))
    return docs.join(out.hint("merge"), F.col("doc_id") == F.col(name), "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    ship_package(spark)
    return decontam.without_items(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, and whether its text comes back from them."""
    ship_package(spark)
    keep = ("doc_id", "lang", "source", "n_chars", "_sha")
    coded = spiece.encode(docs.withColumn("_sha", F.sha2("text", 256)), keep=keep)
    back = spiece.decode(coded.withColumn("_ids", F.col("tokens")), keep=(*keep, "_ids"))
    return back.select("doc_id", "lang", "source", "n_chars", F.col("_ids").alias("tokens"), F.size("_ids").alias("n_tokens"), F.sha2("text", 256).eqNullSafe(F.col("_sha")).alias("lossless"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: SQL cannot train the classifier or run the agendas; tests hold each stage against brute force.
ORACLE_SQL = None


def _delete(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written under the shared checkpoint folder.

    A stage's table goes when the next one's is written, and all of them if a stage fails; the
    last table stays, as the result reads it.
    """
    folder = f"{shared_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    done = None
    try:
        for name, stage in STAGES[:-1]:
            path = f"{folder}/{name}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            if done:
                _delete(spark, done)
            done = path
        return STAGES[-1][1](spark, docs, sf_dir)
    except BaseException:
        _delete(spark, folder)
        raise
