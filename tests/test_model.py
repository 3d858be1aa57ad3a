"""Modelling (C6-C14) and the distributed ranking primitive."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from contrail.functions.ranking import rank_rows
from contrail.operators import model
from contrail.spec import Tables


def test_members_one_scan_two_roles(spark):
    df = spark.createDataFrame([("A", "B"), ("B", "C"), (None, "A")], "o string, d string")
    assert sorted(r.code for r in model.members(df, ["o", "d"]).collect()) == ["A", "B", "C"]


def test_surrogate_keys_by_code_order(spark):
    m = spark.createDataFrame([("ZZ",), ("AA",), ("MM",)], "code string")
    keys = {r.code: r.key for r in model.surrogate_keys(m, "code", "key").collect()}
    assert keys == {"AA": 1, "MM": 2, "ZZ": 3}


def test_map_keys_raise_on_unmatched(spark):
    f = spark.createDataFrame([("AA",), ("XX",)], "AIRLINE string")
    keyed = spark.createDataFrame([("AA", 1)], "AIRLINE string, AIRLINE_ID int")
    with pytest.raises(ValueError, match="AIRLINE_ID"):
        model.map_keys(f, [("AIRLINE", keyed, "AIRLINE", "AIRLINE_ID", "AIRLINE_ID", 1)],
                       on_unmatched="raise")
    kept = model.map_keys(f, [("AIRLINE", keyed, "AIRLINE", "AIRLINE_ID", "AIRLINE_ID", 1)])
    assert sorted((r.AIRLINE, r.AIRLINE_ID) for r in kept.collect()) == [("AA", 1), ("XX", None)]
    assert [r.code for r in model.unmatched(f, "AIRLINE", keyed, "AIRLINE").collect()] == ["XX"]


def test_dimension_unmatched_members_get_null_attributes(spark):
    members = spark.createDataFrame([(1, "AA"), (2, "ZZ")], "AIRLINE_ID int, AIRLINE string")
    ref = spark.createDataFrame([("AA", "Alpha Air")], "IATA_CODE string, AIRLINE string")
    rows = {r.airline_key: (r.airline_code, r.airline_name)
            for r in model.dim_airline(members, ref).collect()}
    assert rows == {1: ("AA", "Alpha Air"), 2: (None, None)}


def test_date_dimension_iso_week_and_weekend(spark):
    f = spark.createDataFrame([(20160101,), (20160102,), (20160104,)], "date_key int")
    rows = {r.date_key: r for r in model.date_dim(f).collect()}
    assert rows[20160101].week == 53 and rows[20160101].day_name == "Friday"
    assert rows[20160102].is_weekend and not rows[20160104].is_weekend
    assert rows[20160101].month_name == "January" and rows[20160101].quarter == 1
    assert rows[20160101].full_date == dt.date(2016, 1, 1)


def test_normalize_and_star(spark, tmp_out):
    f = spark.createDataFrame(
        [(2015, 1, 1, "AA", "JFK", "LAX", 5.0, 1.0, 0, 0),
         (2015, 1, 2, "UA", "LAX", "JFK", -3.0, None, 1, 0)],
        "YEAR int, MONTH int, DAY int, AIRLINE string, ORIGIN_AIRPORT string, "
        "DESTINATION_AIRPORT string, DEPARTURE_DELAY double, ARRIVAL_DELAY double, "
        "CANCELLED int, DIVERTED int")
    t = model.normalize_written(spark, f, tmp_out)
    assert isinstance(t, Tables) and t.counts == {"airlines": 2, "airports": 2}
    airlines = spark.createDataFrame([("AA", "American")], "IATA_CODE string, AIRLINE string")
    airports = spark.createDataFrame([("JFK", "Kennedy", "NY", "NY", "USA", 40.6, -73.8)],
                                     "IATA_CODE string, AIRPORT string, CITY string, "
                                     "STATE string, COUNTRY string, LATITUDE double, "
                                     "LONGITUDE double")
    model.write_star(model.build_star(t, airlines, airports), tmp_out + "/star")
    star = model.read_star(spark, tmp_out + "/star")
    assert star.rows == {"dim_airline": 2, "dim_airport": 2, "dim_date": 2}
    fact = star.fact.collect()
    assert {r.date_key for r in fact} == {20150101, 20150102}
    assert "YEAR" not in star.fact.columns and "airline_key" in star.fact.columns


@pytest.mark.parametrize("kind", ["rank", "dense_rank"])
def test_distributed_rank_matches_window(spark, kind):
    random.seed(7)
    rows = [(i, random.choice([None, 1.0, 2.0, 2.0, 3.5]), random.randint(0, 5))
            for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b int")
    order = [("a", True), ("b", False)]
    got = {r.id: r.rk for r in rank_rows(df, order, kind, "rk", partitions=5)
           .collect()}
    fn = {"rank": F.rank, "dense_rank": F.dense_rank}[kind]
    w = Window.orderBy(F.col("a").asc_nulls_first(), F.col("b").desc_nulls_last())
    want = {r.id: r.rk for r in df.withColumn("rk", fn().over(w)).collect()}
    assert got == want


def test_distributed_row_number_unique_order(spark):
    df = spark.createDataFrame([(f"k{i:04d}",) for i in range(1000)], "code string")
    got = rank_rows(df, ["code"], "row_number", "rn", partitions=7).collect()
    assert sorted(r.rn for r in got) == list(range(1, 1001))
    assert all(r.rn == int(r.code[1:]) + 1 for r in got)


@pytest.mark.parametrize("reuse, adaptive", [("true", "true"), ("false", "true"), ("false", "false")])
def test_rank_is_the_window_under_any_plan(spark, reuse, adaptive):
    """400,000 rows, one order key with a third of them, with and without exchange reuse and AQE."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(400_000).withColumn("x", F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.xxhash64("id") % 1_000_000) / 7.0))
        w = Window.orderBy(F.col("x").asc_nulls_first())
        for kind, fn in (("rank", F.rank), ("dense_rank", F.dense_rank)):
            got = rank_rows(df, ["x"], kind, "rk", partitions=8)
            assert got.join(df.select("id", fn().over(w).alias("want")), "id").filter("rk = want").count() == 400_000
        got = rank_rows(df.select("id"), [("id", False)], "row_number", "rk", partitions=8)
        assert got.filter("rk = 400000 - id").count() == 400_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_row_number_refuses_ties(spark):
    with pytest.raises(ValueError, match="ties"):
        rank_rows(spark.createDataFrame([(1,), (1,)], "a int"), ["a"], "row_number", "rn")
