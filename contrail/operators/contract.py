"""Schema contract between a DataFrame and a target table.

These operate on schemas (metadata), not rows: no job runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.spec import AUTO_COLUMNS


def _fields(target) -> T.StructType:
    return target.schema if isinstance(target, DataFrame) else target


def table_schema(target) -> dict:
    """Column name -> type of a table (DataFrame or StructType)."""
    return {f.name: f.dataType.simpleString() for f in _fields(target).fields}


def schema_diff(df: DataFrame, target, exclude=(), auto=AUTO_COLUMNS) -> DataFrame:
    """One row: missing_from_table (df columns the target lacks),
    extra_in_table (target columns df lacks, auto columns ignored), counts and
    ``is_valid`` = nothing missing. ``exclude`` drops df columns from the check
    (e.g. natural keys replaced by ids)."""
    tcols = [f.name for f in _fields(target).fields if f.name not in auto]
    dcols = [c for c in df.columns if c not in exclude]
    missing = [c for c in dcols if c not in tcols]
    extra = [c for c in tcols if c not in dcols]
    spark = df.sparkSession
    schema = ("missing_from_table array<string>, extra_in_table array<string>, "
              "missing_count int, extra_count int, is_valid boolean")
    return spark.createDataFrame([(missing, extra, len(missing), len(extra), not missing)], schema)


def select_compatible(df: DataFrame, target, exclude=()) -> DataFrame:
    """Keep the df columns the target has, in df order; none -> ValueError."""
    tcols = {f.name for f in _fields(target).fields}
    keep = [c for c in df.columns if c in tcols and c not in exclude]
    if not keep:
        raise ValueError("no column of the DataFrame exists in the target table")
    return df.select(*[F.col(c) for c in keep])
