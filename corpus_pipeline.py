"""A corpus from raw documents to tokens: each stage works on what the one before it kept.

Stages take (spark, docs, sf_dir) and return documents with their columns, but for the last one, which returns token ids.
``run`` writes every stage's result to the shared folder as Parquet and reads it again, so a lost executor
costs no more than the stage it worked on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import byte_bpe, decontaminate, line_templates, simhash, toxicity
from tidemark.llm.queries import PATTERN, TOXIC_FROM, VOCABULARY, table
from tidemark.session import scratch_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a classifier learned from the labelled ones among them."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_scores(docs, model, score_col="__score").where(F.col("__score") < TOXIC_FROM).drop("__score")


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; all documents stay."""
    kept = line_templates.drop_recurring_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles with 60 of 64 fingerprint bits alike or Jaccard 0.8."""
    return simhash.keep_one_per_group(docs, shingle=5, radius=4, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again as a check."""
    return byte_bpe.token_digests(docs, VOCABULARY, PATTERN, with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_recurring_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

ORACLE_SQL = None  # training, fingerprints and tokens lie outside SQL; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
