"""Shared plan shapes over a Star.

The recurring shape of the catalogue is "aggregate the fact by a dimension
key, then attach dimension attributes". We aggregate on the key first (partial
aggregation on the map side; only per-key partials shuffle, so a key holding a
third of the fact costs one row per task) and join the dimension to the
aggregate, which is bounded by the dimension size. Grouping by an attribute
(e.g. name) re-aggregates the per-key partials, so NULL attributes of
unmatched members collapse into one group as in the reference (S10).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalar import all_of, count_when, is_flag
from contrail.operators.model import bounded
from contrail.plans.aggregates import sums
from contrail.spec import ARR, CANC, CAUSES, DEP, DIST, DIVR, Star  # noqa: F401  for the plans


def dim(star: Star, name: str, *cols) -> DataFrame:
    """Projected dimension with a broadcast hint when its counted size allows."""
    d = star.dim(name)
    return bounded(d.select(*cols) if cols else d, star.rows.get(name))


def partials(value_cols=(DEP, ARR), flags=(CANC, DIVR), extra=()) -> list[Column]:
    """Re-aggregatable partial aggregates: counts, flag counts, sums, non-null counts."""
    out = [F.count(F.lit(1)).alias("_n")]
    out += [count_when(is_flag(f)).alias(f"_f_{f}") for f in flags]
    for v in value_cols:
        out += [F.sum(v).alias(f"_s_{v}"), F.count(v).alias(f"_c_{v}")]
    return out + list(extra)


def merge_partials(value_cols=(DEP, ARR), flags=(CANC, DIVR)) -> list[Column]:
    out = [F.sum("_n").alias("_n")]
    out += [F.sum(f"_f_{f}").alias(f"_f_{f}") for f in flags]
    for v in value_cols:
        out += [F.sum(f"_s_{v}").alias(f"_s_{v}"), F.sum(f"_c_{v}").alias(f"_c_{v}")]
    return out


def mean(v: str) -> Column:
    """AVG from merged partials; NULL when no non-null value."""
    return F.try_divide(F.col(f"_s_{v}"), F.col(f"_c_{v}").cast("double"))


def by_key_then_attr(star: Star, fact_key: str, dim_name: str, dim_key: str,
                     attrs: list, value_cols=(DEP, ARR), flags=(CANC, DIVR), arr_gt: float | None = None,
                     where: Column | None = None) -> DataFrame:
    """Sum up per key, inner-join the dimension, regroup by ``attrs``. ``where``: a filter on
    the fact, which the aggregates can't answer."""
    per_key = (sums(star.fact, star.agg, [fact_key], value_cols, flags, arr_gt) if where is None
               else sums(star.fact.where(where), None, [fact_key], value_cols, flags, arr_gt)).withColumnRenamed(fact_key, "_k")
    d = dim(star, dim_name, F.col(dim_key).alias("_k"), *attrs)
    j = per_key.join(d, "_k")
    return j.groupBy(*attrs).agg(*merge_partials(value_cols, flags))


def dated(star: Star, predicates, *attrs) -> DataFrame:
    """The fact with attributes of ``dim_date``, of the dates that fulfil ``predicates`` (on its columns). The
    join is on date and year, so that the years of the dates found prune the fact's directories at run time."""
    on = ["date_key", "year"] if "year" in star.fact.columns else ["date_key"]
    d = dim(star, "dim_date").where(all_of(predicates)).select(*dict.fromkeys([*on, *attrs]))
    return star.fact.join(d, on)


def on_date(fact: DataFrame, date_key) -> Column | None:
    """``date_key = k`` plus the implied ``year = k / 10000`` when the fact is
    partitioned by year, so the scan prunes every other year's directory."""
    if date_key is None:
        return None
    pred = F.col("date_key") == F.lit(date_key)
    if "year" in fact.columns:
        pred = pred & (F.col("year") == F.lit(int(date_key) // 10000))
    return pred
