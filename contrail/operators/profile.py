"""Profiling and quality scoring.

All column-wise measures are computed in ONE aggregate over the data
(``count_if`` per column), then reshaped to long form with ``unpivot``.
Duplicate counts hash rows first (``distinct_row_count``): only 8-byte hashes
shuffle, and only rows with a repeated hash are compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.ranking import written
from contrail.functions.scalar import one_row, to_number
from contrail.spec import (DELAY_COLUMNS, DUPLICATE_MAX, DUPLICATE_MULTIPLIER, GRADES,
                           MISSING_MAX, MISSING_MULTIPLIER, TYPE_ISSUE_FRACTION_WEIGHT,
                           TYPE_ISSUE_PER_COLUMN_MAX, TYPE_ISSUES_MAX)

_FLOATS = (T.DoubleType, T.FloatType)


def is_missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN for floating columns (pandas ``isnull``, S12)."""
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, _FLOATS):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def profile(df: DataFrame, name: str) -> DataFrame:
    """Dataset, row count, column count, column names and types (one row)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("dataset"), "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
        F.array(*[F.lit(t) for _, t in df.dtypes]).alias("dtypes"))


def type_report(df: DataFrame) -> list[tuple[str, str]]:
    """Column -> type, from the schema (metadata, no job)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def missing_counts(df: DataFrame) -> DataFrame:
    """One-row wide aggregate: ``_rows`` and one missing count per column."""
    return df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])


def missing_report(df: DataFrame, digits: int | None = None) -> DataFrame:
    """B2: per column missing count and percent, long form."""
    wide = missing_counts(df)
    long = wide.unpivot(["_rows"], df.columns, "column_name", "missing_count")
    pct = F.try_divide(F.col("missing_count").cast("double"), F.col("_rows").cast("double")) * 100
    return long.select("column_name", "missing_count",
                       (F.round(pct, digits) if digits is not None else pct).alias("missing_pct"))


def missing_summary(df: DataFrame) -> DataFrame:
    """B2 totals: total missing cells, total cells, overall percent."""
    wide = missing_counts(df)
    total = sum((F.col(c) for c in df.columns), F.lit(0))
    cells = F.col("_rows") * F.lit(len(df.columns))
    return wide.select(total.cast("bigint").alias("total_missing"),
                       cells.cast("bigint").alias("total_cells"),
                       F.coalesce(F.try_divide(total.cast("double"), cells.cast("double")) * 100,
                                  F.lit(0.0)).alias("total_missing_percentage"))


def distinct_row_count(df: DataFrame, alias: str = "_uniq") -> DataFrame:
    """Exact number of distinct rows as a one-row DataFrame, hash first.

    ``distinct().count()`` shuffles every column of every row. Here only an
    8-byte ``xxhash64`` of the row is shuffled (with partial aggregation);
    rows whose hash occurs once are distinct by definition, and only rows
    whose hash repeats (true duplicates or rare collisions) are compared
    exactly. The repeated hashes are written and counted first: while they are
    few, they are broadcast and no other row moves. A hot duplicated row
    collapses map-side in both steps.
    """
    repeated, n = repeated_hashes(df)
    all_rows = df.agg(F.count(F.lit(1)).alias("__a"))
    among = repeated.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__m"))
    rows = df if n is None else row_hash(df).join(F.broadcast(repeated), "__h", "left_semi").drop("__h")
    exact = rows.distinct().agg(F.count(F.lit(1)).alias("__r"))
    if n is None:  # most of the data would have to move in any case
        return exact.withColumnRenamed("__r", alias)
    return one_row(all_rows, among, exact).select((F.col("__a") - F.col("__m") + F.col("__r")).alias(alias))


def row_hash(df: DataFrame, cols=None) -> DataFrame:
    """``df`` with ``__h``, the hash of the row or of ``cols``."""
    return df.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in cols or df.columns]))


#: Hashes that are broadcast at most (8 bytes each and as many again for their count).
REPEATED_MAX = 1_000_000


def repeated_hashes(df: DataFrame, cols=None) -> tuple[DataFrame, int | None]:
    """(__h, __n): hashes of rows (of ``cols``) that occur more than once, as a written table, and their number; None
    if they are more than can be broadcast."""
    found = row_hash(df, cols).groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    table = written(found, "repeated")
    n = table.agg(F.count(F.lit(1))).first()[0]
    return table, n if n <= REPEATED_MAX else None


def duplicate_report(df: DataFrame, keys=None) -> DataFrame:
    """Total rows, unique rows, duplicate rows (beyond the first) and percent.

    ``keys``: duplicates judged on a column subset instead of whole rows.
    """
    base = df if keys is None else df.select(*keys)
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    uniq = distinct_row_count(base, "unique_rows")
    return one_row(total, uniq).select(
        "total_rows", "unique_rows",
        (F.col("total_rows") - F.col("unique_rows")).alias("duplicate_rows"),
        F.coalesce(F.try_divide((F.col("total_rows") - F.col("unique_rows")).cast("double"),
                                F.col("total_rows").cast("double")) * 100,
                   F.lit(0.0)).alias("duplicate_percentage"))


def _text_columns(df: DataFrame, numeric_cols) -> list[str]:
    """Delay columns that arrived as text (only those can carry type issues)."""
    return [c for c in numeric_cols
            if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]


def grade(score: Column) -> Column:
    """>= 90 Excellent, >= 75 Good, >= 60 Fair, else Poor."""
    expr = None
    for threshold, label in GRADES:
        expr = (F.when(score >= threshold, label) if expr is None
                else expr.when(score >= threshold, label))
    return expr


def quality_inputs(df: DataFrame, numeric_cols=DELAY_COLUMNS) -> DataFrame:
    """One-row measures behind B2/B3/B6: rows, missing cells per column, text
    delay values that do not coerce (NULLs count too, S23) -- one aggregate --
    and the distinct row count (one ``distinct``)."""
    text_cols = _text_columns(df, numeric_cols)
    cells = df.agg(F.count(F.lit(1)).alias("_rows"),
                   *[F.count_if(is_missing(df, c)).alias(f"_m_{c}") for c in df.columns],
                   *[F.count_if(to_number(c).isNull()).alias(f"_bad_{c}") for c in text_cols])
    return one_row(cells, distinct_row_count(df, "_uniq"))


def score_from_inputs(inputs: DataFrame, columns: list, text_cols: list) -> DataFrame:
    """B6/B7 from ``quality_inputs``: ``100 - min(30, miss%*0.5)
    - min(20, dup%*0.5) - min(10, sum over text delay columns of
    min(2, bad_fraction*10))``, truncated and clipped to [0, 100]."""
    rows = F.col("_rows").cast("double")
    miss = sum((F.col(f"_m_{c}") for c in columns), F.lit(0)).cast("double")
    miss_pct = F.coalesce(F.try_divide(miss, rows * len(columns)) * 100, F.lit(0.0))
    dup_pct = F.coalesce(F.try_divide((F.col("_rows") - F.col("_uniq")).cast("double"), rows)
                         * 100, F.lit(0.0))
    type_ded = F.lit(0.0)
    for c in text_cols:
        frac = F.coalesce(F.try_divide(F.col(f"_bad_{c}").cast("double"), rows), F.lit(0.0))
        type_ded = type_ded + F.least(F.lit(float(TYPE_ISSUE_PER_COLUMN_MAX)),
                                      frac * TYPE_ISSUE_FRACTION_WEIGHT)
    score = (F.lit(100.0)
             - F.least(F.lit(float(MISSING_MAX)), miss_pct * MISSING_MULTIPLIER)
             - F.least(F.lit(float(DUPLICATE_MAX)), dup_pct * DUPLICATE_MULTIPLIER)
             - F.least(F.lit(float(TYPE_ISSUES_MAX)), type_ded))
    final = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))).cast("int")
    return inputs.select(
        F.col("_rows").alias("total_rows"), miss.cast("bigint").alias("total_missing"),
        (F.col("_rows") - F.col("_uniq")).alias("duplicate_rows"),
        miss_pct.alias("missing_percentage"), dup_pct.alias("duplicate_percentage"),
        F.least(F.lit(float(TYPE_ISSUES_MAX)), type_ded).alias("type_deduction"),
        final.alias("quality_score")).withColumn("grade", grade(F.col("quality_score")))


def quality_score(df: DataFrame, numeric_cols=DELAY_COLUMNS) -> DataFrame:
    """Quality score and grade of ``df`` (one aggregate + one distinct)."""
    text_cols = _text_columns(df, numeric_cols)
    return score_from_inputs(quality_inputs(df, numeric_cols), df.columns, text_cols).select(
        "total_rows", "missing_percentage", "duplicate_percentage", "type_deduction",
        "quality_score", "grade")
