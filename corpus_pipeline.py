"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import bpe, decontaminate, jaccard_join, line_dedup, toxicity
from contrail.llm.common import table
from contrail.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Whole texts travel to Python workers in batches of so many bytes and rows at most, so that a worker and its
#: executor hold a few megabytes of texts at a time, however long these are.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def _bounded(stage: Stage) -> Stage:
    """A stage whose Python workers get bounded batches."""
    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCHES.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return bounded


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the classifier rejects go."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: lines of recurring templates go; every document stays, n_chars follows its text."""
    return line_dedup.dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of near copies stays (five-word sets, similarity 0.8 or more)."""
    return jaccard_join.keep_one(docs, n=5, percent=80)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a copy of a test item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token ids of every document that is left, and the digests of ids and decoded text."""
    return bpe.encode(docs, bpe.tokenizer_path("word_bpe_49k.json"), kept_chars=2_000_000).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _bounded(remove_toxic)),
    ("line_dedup", _bounded(drop_recurring_lines)),
    ("near_duplicates", _bounded(keep_one_of_similar)),
    ("decontamination", _bounded(remove_leaks)),
    ("bpe", _bounded(encode)),
]

#: SQL cannot express these stages (a trained classifier, tries, alignment); tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out, path = stage(spark, docs, sf_dir), scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
