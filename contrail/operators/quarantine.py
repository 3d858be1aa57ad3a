"""Quarantine (C3, C4, A2): one parse that parts good rows from rejected cells.

Rows of text cells are parsed once. A row of which every cell parses is good; any
other goes to the quarantine with each rejected cell's column, text and reason, the
row as it was read and the file it came from, so that it can be mended and loaded
again. Both come from one scan and one write, in the order in which rows are read:
a good row is written as its values, a rejected one as its text cells, packed by
column; the JSON is made when rejected rows are read. Good rows and quarantined
rows add up to the input.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.scalar import numeric_text_ok, to_number
from contrail.session import scratch_path
from contrail.sources.io import parsed, read_text_columns

UNPARSABLE, MISSING, OUT_OF_RANGE = "unparsable", "missing", "out of range"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)
_LOCK = threading.Lock()


@dataclass
class Quarantine:
    """``good``: parsed rows; ``cells``: (row_id, file, column_name, value, reason), a row a rejected cell;
    ``rows``: (row_id, file, row), the rejected rows as they were read (JSON of the text cells)."""

    good: DataFrame
    cells: DataFrame
    rows: DataFrame

    def counts(self) -> DataFrame:
        """(column_name, reason, cells) of the rejected cells."""
        return self.cells.groupBy("column_name", "reason").agg(F.count(F.lit(1)).alias("cells"))


def _value(text: Column, kind: T.DataType) -> tuple[Column, Callable[[Column, Column], Column]]:
    """The parsed value of a text cell, and whether a text with that value is refused. Real numbers follow C3/C4:
    blanks around them are dropped and 'nan' is no value."""
    if isinstance(kind, _REAL):
        return to_number(text).cast(kind), lambda t, v: t.isNotNull() & ~numeric_text_ok(t)
    return parsed(F.trim(text) if isinstance(kind, _WHOLE) else text, kind), lambda t, v: t.isNotNull() & v.isNull()


@contextmanager
def _split_code(spark):
    """Rows are judged by many small compiled functions: one for whole rows of many columns is larger than the JVM
    compiles and would be interpreted."""
    key = "spark.sql.codegen.wholeStage"
    with _LOCK:
        old = spark.conf.get(key)
        spark.conf.set(key, "false")
        try:
            yield
        finally:
            spark.conf.set(key, old)


def split(raw: DataFrame, schema: T.StructType, required=(), ranges: dict | None = None) -> Quarantine:
    """Parts rows of text cells (columns of ``schema``; ``_file`` if known) into good rows and rejected cells.

    ``required``: columns that must hold a value; ``ranges``: column -> (least, most), ends included, None for open.
    """
    ranges = ranges or {}
    unknown = [c for c in [*required, *ranges] if c not in schema.names]
    if unknown:
        raise ValueError(f"no such column(s): {unknown}")
    file = F.col("_file") if "_file" in raw.columns else F.lit(None).cast("string")
    values, reasons = [], []
    for i, f in enumerate(schema.fields):
        # each step reads the columns of the one before, so that no cell is parsed more than once
        value, refused = _value(F.col(f"t{i}"), f.dataType)
        values.append(value.alias(f"v{i}"))
        value, reason = F.col(f"v{i}"), F.when(refused(F.col(f"t{i}"), F.col(f"v{i}")), UNPARSABLE)
        if f.name in required:
            reason = reason.when(value.isNull(), MISSING)
        least, most = ranges.get(f.name, (None, None))
        for outside in ([value < F.lit(least)] if least is not None else []) + ([value > F.lit(most)] if most is not None else []):
            reason = reason.when(outside, OUT_OF_RANGE)
        reasons.append(reason.alias(f"r{i}"))
    names = list(enumerate(schema.names))
    judged = (raw.select(file.alias("file"), *[F.col(f"`{n}`").cast("string").alias(f"t{i}") for i, n in names])
              .select("*", *values).select("*", *reasons)
              .withColumn("rejected", F.coalesce(*[F.col(f"r{i}") for i, _ in names]).isNotNull()))
    none = F.array().cast("array<struct<column_name:string,value:string,reason:string>>")
    rejects = F.concat(*[F.when(F.col(f"r{i}").isNull(), none).otherwise(F.array(F.struct(
        F.lit(n).alias("column_name"), F.col(f"t{i}").alias("value"), F.col(f"r{i}").alias("reason")))) for i, n in names])
    judged = judged.select(
        F.when(~F.col("rejected"), F.struct(*[F.col(f"v{i}").alias(n) for i, n in names])).alias("parsed"),
        F.when(F.col("rejected"), F.struct(*[F.col(f"t{i}").alias(n) for i, n in names])).alias("cells"),
        F.when(F.col("rejected"), rejects).alias("rejects"),
        F.when(F.col("rejected"), F.col("file")).alias("file"),
        F.when(F.col("rejected"), F.monotonically_increasing_id()).alias("number"),  # written once, so that it stands
        "rejected")
    spark, path = raw.sparkSession, scratch_path(raw.sparkSession, "quarantine")
    with _split_code(spark):
        judged.write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema(judged.schema).parquet(path)
    bad = kept.where("rejected").withColumn("row_id", F.concat(F.lit(f"{uuid.uuid4()}-"), F.col("number").cast("string")))
    return Quarantine(
        good=kept.where("NOT rejected").select("parsed.*"),
        cells=bad.select("row_id", "file", F.inline("rejects")),
        rows=bad.select("row_id", "file", F.to_json("cells").alias("row")))


def read_csv_split(spark, path, schema: T.StructType, required=(), ranges: dict | None = None, encoding: str = "utf-8") -> Quarantine:
    """CSV files (each by its own header) as good rows and rejected cells; one scan of the files' rows."""
    return split(read_text_columns(spark, path, schema, encoding), schema, required, ranges)
