"""Shared steps at size: what they shuffle, write and read grows with the input only (findings of round 3)."""

import random

import pytest
from pyspark.sql import functions as F

from contrail.functions import quantiles, ranking
from contrail.operators import clean, profile
from contrail.plans import aggregates, catalog, metrics
from contrail.sources import io
from contrail.spec import Star
from tests.test_aggregates import COLUMNS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def fact(spark, airlines=600):
    r = random.Random(5)
    rows = [(r.choice([20140105, 20150203, 20151231, None]), 0 if i % 3 == 0 else r.choice([*range(1, airlines), None]), r.randint(1, 5), r.randint(1, 5),
             r.choice([None, -3.0, 20.0]), r.choice([None, -8.0, 1.0, 40.0]), r.choice([0, 1]), 0) for i in range(3000)]
    return spark.createDataFrame(rows, "date_key int, airline_key int, origin_airport_key int, dest_airport_key int, DEPARTURE_DELAY double, ARRIVAL_DELAY double, "
                                       "CANCELLED int, DIVERTED int")


@pytest.mark.parametrize("order", [["a", "b"], [("a", False), ("b", True)], [("b", False), "a"]])
def test_places_by_halving_equal_a_window(spark, order):
    r = random.Random(2)
    df = spark.createDataFrame([(r.choice([None, float("nan"), *map(float, range(40))]), r.choice([None, "x", "y", "z"])) for _ in range(900)], "a double, b string")
    for parts in (2, 3, 8):
        got = ranking.rank_rows(df, order, "rank", "r", partitions=parts)
        want = ranking.rank_rows(df, order, "rank", "r", bound=900)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_quantiles_read_their_values_from_a_table(spark):
    df = spark.createDataFrame([(float(i * 37 % 1000),) for i in range(1000)], "x double")
    got = quantiles.quantiles(df, {"x": F.col("x")}, [0.0, 0.25, 0.5, 1.0], partitions=8)
    assert {r.p: r.value for r in got.collect()} == {0.0: 0.0, 0.25: 249.75, 0.5: 499.5, 1.0: 999.0}
    assert "quantile-values" in plan(got) and "Scan ExistingRDD" not in plan(got)


def test_duplicates_move_hashes_only(spark):
    rows = [(i, f"t{i}", float(i)) for i in range(500)] + [(7, "t7", 7.0)] * 3 + [(None, None, None)] * 2
    df = spark.createDataFrame(rows, "k int, s string, x double")
    assert profile.distinct_row_count(df).first()[0] == 501
    assert df.dropDuplicates().exceptAll(clean.dedupe(df)).isEmpty() and clean.dedupe(df).count() == 501
    for got in (profile.distinct_row_count(df), clean.dedupe(df), clean.dedupe(df, ["k"], ["x"])):
        assert "SortMergeJoin" not in plan(got) and "BroadcastHashJoin" in plan(got)


def test_many_repeated_hashes_take_the_plain_way(spark, monkeypatch):
    monkeypatch.setattr(profile, "REPEATED_MAX", 1)
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "b"), (2, "c"), (3, None)], "k int, s string")
    assert profile.distinct_row_count(df).first()[0] == 4
    assert sorted(map(tuple, clean.dedupe(df).collect()), key=str) == sorted([(1, "a"), (2, "b"), (2, "c"), (3, None)], key=str)
    assert sorted(map(tuple, clean.dedupe(df, ["k"], ["s"]).collect()), key=str) == sorted([(1, "a"), (2, "b"), (3, None)], key=str)


def test_airline_sums_of_small_groups_are_dealt_as_rows(spark):
    f = fact(spark)
    assert aggregates._hot_airlines(f) == [0]  # a third of the rows; the others have few
    agg = aggregates.aggregate(f)
    got = {(r.year, r.month_key, r.airline_key): (r._n, r["_s_ARRIVAL_DELAY"], r["_c_ARRIVAL_DELAY"], r["_f_CANCELLED"])
           for r in agg.where("grain = 'airline'").collect()}
    want = f.groupBy((F.col("date_key") / 10000).cast("int").alias("y"), (F.col("date_key") / 100).cast("int").alias("m"), "airline_key").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("ARRIVAL_DELAY"), F.lit(0.0)).alias("s"), F.count("ARRIVAL_DELAY").alias("c"), F.sum("CANCELLED").alias("f"))
    assert got == {(r.y, r.m, r.airline_key): (r.n, r.s, r.c, r.f) for r in want.collect()}
    assert agg.count() == agg.dropDuplicates(["year", "grain", *aggregates.KEYS]).count()
    assert "REPARTITION_BY_COL" in plan(agg)


def test_headers_read_a_large_file_by_splits(spark, tmp_out):
    with open(tmp_out + ".csv", "w") as f:
        f.write("id,name\n" + "".join(f"{i},n{i}\n" for i in range(50_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        heads = io.headers(spark, tmp_out + ".csv")
        assert [r.header for r in heads.collect()] == ["id,name"]
        assert heads.rdd.getNumPartitions() > 3 and "MapInArrow" not in plan(heads)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_published_layer_is_dealt_by_key(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(catalog, "raw", lambda *a: spark.createDataFrame([], COLUMNS))
    monkeypatch.setattr(catalog.quality, "reconcile_content", lambda layers, key: seen.update(layers) or (layers["raw"].withColumn("differing_buckets", F.lit(0)), None))
    catalog.q_k08_status(spark, "")
    assert "REPARTITION_BY_COL" in plan(seen["published"]) and "RoundRobin" not in plan(seen["published"])


def test_flights_by_day_and_airline_are_counted_once(spark):
    rows = [(20150101, 1), (20150101, 2), (20150101, 3), (20150102, 1), (None, 1), (20150101, None), (20150101, 9)]
    f = spark.createDataFrame(rows, "date_key int, airline_key int")
    days = spark.createDataFrame([(20150101, "Thursday"), (20150102, "Friday")], "date_key int, day_name string").withColumn(
        "full_date", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
    airlines = spark.createDataFrame([(1, "Same"), (2, "Same"), (3, None), (4, None)], "airline_key int, airline_name string")
    got = metrics.carrier_by_day(Star(fact=f, dim_airline=airlines, dim_airport=airlines, dim_date=days, rows={}))
    assert plan(got).count("partial_count(1)") == 1
    assert [(r.day_name, r.airline_name, r.flights) for r in got.collect()] == [("Thursday", None, 1), ("Thursday", "Same", 2), ("Friday", "Same", 1)]
