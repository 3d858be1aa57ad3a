"""Surrogate keys that outlive a load: an append-only key registry.

Facts that are already loaded refer to members by key, so a member's key must
never change. The registry holds ``(dim, code, key)`` of every member ever
seen; a load looks its codes up and numbers only the unknown ones, after the
largest key of their dimension, in code order and without gaps. The rows of a
load become visible with the warehouse's manifest (``sources/warehouse.py``),
together with the load's other tables; a load that was committed before changes
nothing, and one that broke before its commit numbers anew.

Scale: codes are distinct by partial aggregation before anything moves; unknown
ones are found by an anti-join on (dim, code) and numbered by ranges
(``rank_rows``): no task sees all codes, and the driver sees a row a dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.ranking import rank_rows
from contrail.session import scratch_path
from contrail.sources.warehouse import Load, Warehouse

REGISTRY = "key_registry"
SCHEMA = "dim string, code string, key int, load_version long"


def registry(warehouse: Warehouse, version: int | None = None) -> DataFrame:
    """(dim, code, key, load_version) of all members known as of a version; empty before the first load."""
    if REGISTRY not in warehouse._folders(version):
        return warehouse.spark.createDataFrame([], SCHEMA)
    return warehouse.read(REGISTRY, version).select("dim", "code", "key", F.col("load_version").cast("long").alias("load_version"))


def numbered(new: DataFrame, known: DataFrame, rows: int | None = None) -> DataFrame:
    """(dim, code, key) of unknown members (dim, code; distinct): they follow the largest known key of their
    dimension in code order. ``new`` is a written table; ``rows``: their number, if counted."""
    largest = known.groupBy("dim").agg(F.max("key").alias("largest"))
    place = rank_rows(new, ["dim", "code"], "row_number", "place", bound=rows, is_table=True)  # one numbering for all dimensions
    first = place.groupBy("dim").agg((F.min("place") - 1).alias("before")).join(largest, "dim", "left")
    return (place.join(F.broadcast(first), "dim")  # a row a dimension
            .select("dim", "code", (F.col("place") - F.col("before") + F.coalesce("largest", F.lit(0))).cast("int").alias("key")))


def register(load: Load, members: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Stages the registry of a load: its members (dim, code; distinct) looked up or numbered.

    Returns the whole registry as of this load (dim, code, key) and the number of members by dimension.
    """
    warehouse, spark = load.warehouse, load.warehouse.spark
    known = registry(warehouse)
    new = members.select("dim", "code").filter(F.col("code").isNotNull())
    if load.before:
        new = new.join(known.select("dim", "code"), ["dim", "code"], "left_anti")
    path = scratch_path(spark, "new-members")  # numbered from a written table, so that a retried task sees the same rows
    new.write.parquet(path)
    new = spark.read.schema("dim string, code string").parquet(path)
    count = {r["dim"]: r["n"] for r in new.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row a dimension
    rows = sum(count.values())
    # a partition a load: what earlier loads wrote stays as it is
    written = load.write(REGISTRY, numbered(new, known, rows).withColumn("load_version", F.lit(load.before + 1)), "load_version")
    current = written.select("dim", "code", "key")
    if load.before:
        current = current.unionByName(known.select("dim", "code", "key"))
    for r in known.groupBy("dim").agg(F.count("*").alias("n")).collect() if load.before else []:
        count[r["dim"]] = count.get(r["dim"], 0) + r["n"]
    return current, count
