"""Additive aggregates of the fact: equal to the fact, kept up by signed deltas, read instead of it."""

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from contrail.operators import model
from contrail.plans import aggregates, kpi, metrics
from contrail.sources.warehouse import Warehouse
from tests.test_warehouse import refs  # noqa: F401  a fixture

COLUMNS = ("YEAR int, MONTH int, DAY int, AIRLINE string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, DEPARTURE_DELAY double, "
           "ARRIVAL_DELAY double, DISTANCE double, CANCELLED int, DIVERTED int, FLIGHT_NUMBER string, AIR_SYSTEM_DELAY double, SECURITY_DELAY double, "
           "AIRLINE_DELAY double, LATE_AIRCRAFT_DELAY double, WEATHER_DELAY double")


def flights(spark, seed, n, years):
    r = random.Random(seed)
    pick = lambda *x: r.choice(x)
    rows = [(r.choice(years), r.randint(1, 12), r.randint(1, 28), pick("AA", "BB", "MM", None), pick("JFK", "LAX", "ATL"), pick("JFK", "LAX", None),
             pick(None, -3.0, 0.0, 20.0, 31.0), pick(None, -8.0, 1.0, 40.0), pick(None, 100.0, 250.0), pick(0, 0, 1), pick(0, 0, 0, 1), f"{seed}-{i}",
             *[pick(None, None, 1.0, 5.0) for _ in range(5)]) for i in range(n)]
    return spark.createDataFrame(rows, COLUMNS)


#: Every query that the aggregates answer.
STAR = [kpi.carrier_reliability, kpi.airport_efficiency, kpi.route_intelligence, kpi.monthly_trend, kpi.delay_risk, kpi.scorecard, kpi.insights, kpi.geo_density,
        kpi.daily_volume, kpi.monthly_volume, metrics.executive_kpis, metrics.top_carriers, metrics.top_airports, metrics.airport_rankings, metrics.cause_averages,
        metrics.carrier_kpis, metrics.carrier_daily, metrics.carrier_comparison, metrics.airport_kpis, metrics.top_destinations, metrics.routes, metrics.carrier_delay,
        metrics.daily_trend, metrics.day_type]
TABLES = [metrics.executive_summary, metrics.carrier_performance, metrics.airport_traffic, metrics.delay_analysis, metrics.top_carriers_by_code]


def rows(df):
    return sorted(map(str, df.collect()))


def same_answers(spark, path, star):
    bare, tables = dataclasses.replace(star, agg=None), model.normalized(spark, path, star)
    for q in STAR:
        assert rows(q(star)) == rows(q(bare)), q.__name__
        assert "fact_flights" not in q(star)._jdf.queryExecution().executedPlan().toString(), q.__name__
    for q in TABLES:
        assert rows(q(tables)) == rows(q(dataclasses.replace(tables, agg=None))), q.__name__
        assert "fact_flights" not in q(tables)._jdf.queryExecution().executedPlan().toString(), q.__name__


def test_queries_from_the_aggregates_equal_those_from_the_fact(spark, tmp_out, refs):  # noqa: F811
    star = model.load_star(spark, flights(spark, 1, 600, [2014, 2015]), tmp_out, *refs, "one")
    same_answers(spark, tmp_out, star)
    # thresholds that the aggregates don't hold are answered from the fact
    for q in (lambda s: kpi.airport_efficiency(s, 10, delayed_gt=25), lambda s: kpi.delay_risk(s, arr_gt=10), lambda s: metrics.carrier_delay(s, date_key=20150101)):
        assert rows(q(star)) == rows(q(dataclasses.replace(star, agg=None)))


def held(spark, path):
    """The aggregates as published, and made anew from the whole fact."""
    w = Warehouse(spark, path)
    return rows(w.read(aggregates.TABLE).select(sorted(w.read(aggregates.TABLE).columns))), rows(
        aggregates.aggregate(w.read("fact_flights").drop("year")).select(sorted(w.read(aggregates.TABLE).columns)))


def test_loads_keep_the_aggregates_up(spark, tmp_out, refs):  # noqa: F811
    model.load_star(spark, flights(spark, 1, 200, [2014, 2015]), tmp_out, *refs, "one")
    model.load_star(spark, flights(spark, 2, 100, [2015, 2016]), tmp_out, *refs, "replaces 2015")
    a, b = held(spark, tmp_out)
    assert a == b
    fourteen = sorted(f for f in Warehouse(spark, tmp_out).read(aggregates.TABLE).inputFiles() if "year=2014" in f)
    model.append_flights(spark, flights(spark, 3, 80, [2015, 2017]), tmp_out, *refs, "adds")
    a, b = held(spark, tmp_out)
    assert a == b
    # a signed delta: some flights of 2015 go, all of 2017 do, others come
    gone = flights(spark, 3, 80, [2015, 2017])
    star = model.append_flights(spark, flights(spark, 4, 30, [2015, 2018]), tmp_out, *refs, "corrects", removed=gone)
    a, b = held(spark, tmp_out)
    assert a == b
    assert star.fact.where("year = 2017").count() == 0 and not any("2017" in x for x in Warehouse(spark, tmp_out)._folders()[aggregates.TABLE])
    assert sorted(f for f in Warehouse(spark, tmp_out).read(aggregates.TABLE).inputFiles() if "year=2014" in f) == fourteen
    want = flights(spark, 1, 200, [2014, 2015]).where("YEAR = 2014").count() + 100 + 30
    assert star.fact.count() == want
    same_answers(spark, tmp_out, star)
    # committed before: nothing changes
    model.append_flights(spark, flights(spark, 4, 30, [2015, 2018]), tmp_out, *refs, "corrects", removed=gone)
    assert Warehouse(spark, tmp_out).read("fact_flights").count() == want


def test_first_load_by_append(spark, tmp_out, refs):  # noqa: F811
    star = model.append_flights(spark, flights(spark, 5, 50, [2015]), tmp_out, *refs, "one")
    assert star.fact.count() == 50
    a, b = held(spark, tmp_out)
    assert a == b


@pytest.mark.parametrize("grain", sorted(aggregates.GRAINS))
def test_no_grain_for_other_keys(spark, grain):
    fact = spark.createDataFrame([(20150101, 1, 2, 3, 5.0, 1.0, 0, 0)], "date_key int, airline_key int, origin_airport_key int, dest_airport_key int, "
                                 "DEPARTURE_DELAY double, ARRIVAL_DELAY double, CANCELLED int, DIVERTED int")
    agg = aggregates.aggregate(fact)
    assert agg.where(F.col("grain") == grain).count() == 1
    by_both = aggregates.sums(fact, agg, ["date_key", "airline_key"])
    assert [r._n for r in by_both.collect()] == [1]
