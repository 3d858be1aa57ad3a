"""Exact order statistics at any cardinality.

``median`` and ``percentile`` gather every value of a column, with its count, in one
task. Here the rows collapse to distinct values with their counts (partial
aggregation, all columns in one scan) and are written once; values are dealt to ranges and get the number of
rows before them as prefix sums over the ranges (``ranking.prefix_counts``), and the
values at the wanted positions are picked. A column with as many distinct values as
rows is sorted by ranges like any other data.

Results equal Spark's ``percentile`` (linear interpolation between the two nearest
positions); a column without values has NULLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.ranking import prefix_counts, written


def quantiles(df: DataFrame, columns: dict[str, Column], probabilities, partitions: int | None = None) -> DataFrame:
    """(metric, p, value): the exact quantiles of named columns; a row for each metric and probability."""
    ps = [float(p) for p in probabilities]
    if not all(0 <= p <= 1 for p in ps):
        raise ValueError("probabilities lie between 0 and 1")
    values = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), c.cast("double").alias("x")) for n, c in columns.items()])).alias("v")).select("v.*")
    located = written(values.where(F.col("x").isNotNull()).groupBy("metric", "x").agg(F.count(F.lit(1)).alias("_n")), "quantile-values")
    placed = prefix_counts(located, ["metric", "x"], partitions)
    others = Window.orderBy("metric").rowsBetween(Window.unboundedPreceding, -1)  # a row a column
    totals = located.groupBy("metric").agg(F.sum("_n").alias("n")).select("metric", "n", F.coalesce(F.sum("n").over(others), F.lit(0)).alias("_skip"))
    wanted = (totals.withColumn("p", F.explode(F.array(*map(F.lit, ps)))).withColumn("_at", (F.col("n") - 1) * F.col("p"))
              .withColumn("_lo", F.floor("_at")).withColumn("_hi", F.ceil("_at")))  # a row a column and probability
    first = F.col("_rows_before") - F.col("_skip")

    def holds(c: str) -> Column:
        return (F.col(c) >= first) & (F.col(c) < first + F.col("_n"))

    picked = (placed.join(F.broadcast(wanted), "metric").where(holds("_lo") | holds("_hi")).groupBy("metric", "p", "_at", "_lo", "_hi")
              .agg(F.max(F.when(holds("_lo"), F.col("x"))).alias("_low"), F.max(F.when(holds("_hi"), F.col("x"))).alias("_high")))
    value = F.when((F.col("_lo") == F.col("_hi")) | F.col("_low").eqNullSafe(F.col("_high")), F.col("_low")).otherwise(
        (F.col("_hi") - F.col("_at")) * F.col("_low") + (F.col("_at") - F.col("_lo")) * F.col("_high"))
    return picked.select("metric", "p", value.alias("value"))


def medians(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row: the exact median of each column, under its name."""
    found = quantiles(df, columns, [0.5])
    return found.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in columns])
