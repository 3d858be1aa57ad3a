"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import scratch_path

#: Ids and other narrow rows are broadcast up to this size, else shuffled.
BROADCAST_BYTES = 32 << 20
#: A word: a run of characters other than blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty), and the named extra columns; others are dropped."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *extra)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(keys: DataFrame, row_bytes: int = 48) -> bool:
    """May these narrow rows be broadcast? Their size is counted; beyond the bound the caller shuffles."""
    return keys.count() * row_bytes <= BROADCAST_BYTES


def narrow(keys: DataFrame, lists: str) -> bool:
    """May rows with a list of 8-byte elements be broadcast? Rows and elements are counted."""
    return (keys.agg(F.sum(F.size(lists) * 8 + 64)).first()[0] or 0) <= BROADCAST_BYTES


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name_1``, ``name_2``, .. : the first that no column of ``df`` bears (in either case)."""
    taken, k, found = {c.lower() for c in df.columns}, 0, name
    while found.lower() in taken:
        k += 1
        found = f"{name}_{k}"
    return found


def lower_az(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
