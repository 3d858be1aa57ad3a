"""Exact order statistics by ranges (C1, F35) and calendar windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contrail.functions.quantiles import medians, quantiles
from contrail.operators import clean
from contrail.plans import dist, kpi


@pytest.mark.parametrize("rows", [1, 2, 5, 1000])
def test_quantiles_equal_percentile(spark, rows):
    df = spark.range(rows).select(F.col("id").alias("a"), (F.xxhash64("id") % 1000 / 7).alias("b"),
                                  F.when(F.col("id") % 3 == 0, 1.5).alias("c"), F.lit(None).cast("double").alias("d"))
    ps = [0.0, 0.1, 0.5, 0.77, 0.9, 1.0]
    want = df.agg(*[F.percentile(c, p).alias(f"{c}{p}") for c in "abc" for p in ps]).first()
    got = {f"{r.metric}{r.p}": r.value for r in quantiles(df, {c: F.col(c) for c in "abcd"}, ps, partitions=5).collect()}
    assert got == want.asDict()  # d has no values and no rows


def test_as_many_values_as_rows(spark):
    """Half a million distinct values: no map of values in any task, the same median."""
    df = spark.range(500_000).select((F.xxhash64("id") / 3.0).alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    q = medians(df, {"x": F.col("x"), "y": F.col("y")})
    assert "ObjectHashAggregate" not in q._jdf.queryExecution().executedPlan().toString()
    want = df.agg(F.median("x").alias("x"), F.median("y").alias("y")).first()
    assert q.first() == want


def test_imputation_and_stats_without_value_maps(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (None, 2.0, None), (4.0, 4.0, "b"), (10.0, float("nan"), "c")], "x double, y double, s string")
    got = clean.impute(df)
    assert "ObjectHashAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(1.0, 3.0, "a"), (4.0, 2.0, "UNKNOWN"), (4.0, 4.0, "b"), (10.0, 3.0, "c")]
    s = dist.delay_stats(df, ["x"]).first()
    assert (s.n, s["mean"], s["median"], round(s.p90, 6)) == (3, 5.0, 4.0, 8.8)
    with pytest.raises(ValueError):
        quantiles(df, {"x": F.col("x")}, [1.5])


def day(n):
    return dt.date(2020, 2, 27) + dt.timedelta(days=n)


def test_missing_days_do_not_shift_the_window(spark):
    s = spark.createDataFrame([("a", day(0), 7), ("a", day(1), 14), ("a", day(9), 70), ("b", day(3), 1), (None, day(3), 2), (None, day(5), 4)], "g string, d date, v int")
    full = kpi.fill_calendar(s, "d", "day", "g", {"v": 0})
    assert sorted((str(r.g), r.d, r.v) for r in full.collect()) == sorted(
        [("a", day(n), {0: 7, 1: 14, 9: 70}.get(n, 0)) for n in range(10)] + [("b", day(3), 1)] + [("None", day(3), 2), ("None", day(4), 0), ("None", day(5), 4)])
    ma = {(r.g, r.d): r.v_ma7 for r in kpi.moving_average_by_date(full, "v", "d", 7, "g").collect()}
    assert ma["a", day(6)] == 3.0 and ma["a", day(8)] == 0.0 and ma["a", day(9)] == 10.0 and ma["b", day(3)] == 1.0
    # without the spine a missing day is no row of the window, and older days stay out
    assert {r.d: r.v_ma7 for r in kpi.moving_average_by_date(s.where("g = 'a'"), "v", "d", 7).collect()}[day(9)] == 70.0


def test_changes_compare_the_right_periods(spark):
    s = spark.createDataFrame([(dt.date(2020, 1, 1), 10), (dt.date(2020, 2, 1), 20), (dt.date(2020, 4, 1), 5)], "m date, v int")
    got = {r.m.month: (r.prev_v, r.v_change, r.v_change_pct) for r in kpi.calendar_change(s, "v", "m").collect()}
    assert got == {1: (None, None, None), 2: (10, 10, 100.0), 4: (None, None, None)}
    full = kpi.fill_calendar(s, "m", "month", fill={"v": 0})
    assert [(r.m.month, r.prev_v) for r in kpi.calendar_change(full, "v", "m").orderBy("m").collect()] == [(1, None), (2, 10), (3, 20), (4, 0)]
    assert kpi.fill_calendar(s.limit(0), "m", "month").count() == 0
    with pytest.raises(ValueError):
        kpi.fill_calendar(s, "m", "fortnight")
