"""Delay distributions (F35-F38) and their filters.

Histograms use equal-width bins over the observed [min, max] of the filtered
values (``numpy.histogram`` semantics: last bin right-closed). The min/max are
a one-row (or one-row-per-group) aggregate joined back, so the operator stays
lazy and distributed: no value reaches the driver. Exact median and percentile
are selected by ranges of values (``functions.quantiles``), whatever their number;
``approx=True`` switches to ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.quantiles import quantiles
from contrail.functions.scalar import all_of, one_row, rnd, with_scalars
from contrail.spec import FLIGHT_SPEC, FactSpec


def completed(df: DataFrame, spec: FactSpec = FLIGHT_SPEC) -> DataFrame:
    """D3: not cancelled, not diverted, both delays present."""
    return df.where((F.col(spec.cancelled) != 1) & (F.col(spec.diverted) != 1)
                    & F.col(spec.dep_delay).isNotNull() & F.col(spec.arr_delay).isNotNull())


def in_range(c: str, lo: float, hi: float) -> Column:
    """``c BETWEEN lo AND hi``."""
    return F.col(c).between(lo, hi)


def delay_stats(df: DataFrame, cols, approx: bool = False, digits: int | None = None
                ) -> DataFrame:
    """n, mean, median, sample std, p90 per column, long form."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
        if approx:
            aggs += [F.percentile_approx(c, p).cast("double").alias(f"{c}__{n}") for n, p in (("median", 0.5), ("p90", 0.9))]
    wide = df.agg(*aggs)
    if not approx:
        found = quantiles(df, {c: F.col(c) for c in cols}, [0.5, 0.9])
        wide = one_row(wide, found.agg(*[F.max(F.when((F.col("metric") == c) & (F.col("p") == p), F.col("value"))).alias(f"{c}__{n}")
                                         for c in cols for n, p in (("median", 0.5), ("p90", 0.9))]))
    return wide.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("metric"), F.col(f"{c}__n").alias("n"),
        rnd(f"{c}__mean", digits).alias("mean"), rnd(f"{c}__median", digits).alias("median"),
        rnd(f"{c}__std", digits).alias("std"), rnd(f"{c}__p90", digits).alias("p90"))
        for c in cols])).alias("s")).select("s.*")


def histogram(df: DataFrame, col: str, bins: int = 50, lo: float | None = -20,
              hi: float | None = 180, where: Column | None = None, by=None,
              digits: int | None = None) -> DataFrame:
    """equal-width histogram, all ``bins`` bins (empty ones count 0).

    ``lo``/``hi``: optional range filter (D2) applied before binning.
    ``by``: optional group column(s): one histogram per group, in parallel.
    """
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    x = df.where(all_of([F.col(col).isNotNull(), where,
                         in_range(col, lo, hi) if lo is not None and hi is not None else None]))
    # values with their counts: all that follows is on this small table, from one scan of the fact
    x = x.groupBy(*by, F.col(col).cast("double").alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    stats = x.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    # per-group stats: one row per group (Spark/AQE choose the join); global: one row
    j = x.join(stats, by) if by else with_scalars(x, stats)
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) / width * bins).cast("int") + 1,
                F.lit(bins)))
    counts = j.groupBy(*by, b.alias("bin")).agg(F.sum("_n").alias("frequency"))
    grid = stats.select(*by, "_lo", "_hi", F.explode(F.sequence(F.lit(1), F.lit(bins)))
                        .alias("bin"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return grid.join(counts, [*by, "bin"], "left").select(
        *by, "bin",
        rnd(F.col("_lo") + (F.col("bin") - 1) * w, digits).alias("bin_lo"),
        rnd(F.col("_lo") + F.col("bin") * w, digits).alias("bin_hi"),
        F.coalesce(F.col("frequency"), F.lit(0)).cast("bigint").alias("frequency"))
