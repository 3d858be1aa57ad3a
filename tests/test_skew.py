"""A hot key holding a third of the rows: results stay whole and exact.

Brute force in pandas on the same rows is the oracle.
"""

import random

import pandas as pd
import pytest

from contrail.operators import model
from contrail.plans import dist, kpi, metrics
from contrail.spec import Star


@pytest.fixture(scope="module")
def skewed(spark):
    random.seed(3)
    n = 6000
    rows = []
    for i in range(n):
        o = 1 if i % 3 == 0 else random.randint(2, 40)   # airport 1: a third of departures
        d = random.randint(1, 40)
        a = 1 if i % 2 == 0 else random.randint(2, 9)    # airline 1: half of the flights
        dep = float(random.randint(-20, 150))
        rows.append((a, o, d, 20150101 + (i % 28), dep, dep - 5, int(i % 17 == 0), 0))
    fact = spark.createDataFrame(rows, "airline_key int, origin_airport_key int, "
                                       "dest_airport_key int, date_key int, DEPARTURE_DELAY double, "
                                       "ARRIVAL_DELAY double, CANCELLED int, DIVERTED int")
    airports = spark.createDataFrame(
        [(k, f"A{k:02d}", f"Airport {k}", f"City {k}", "ST") for k in range(1, 41)],
        "airport_key int, airport_code string, airport_name string, city string, state string")
    airlines = spark.createDataFrame([(k, f"C{k}", f"Carrier {k}") for k in range(1, 10)],
                                     "airline_key int, airline_code string, airline_name string")
    dates = model.date_dim(fact)
    star = Star(fact=fact, dim_airline=airlines, dim_airport=airports, dim_date=dates,
                rows={"dim_airline": 9, "dim_airport": 40, "dim_date": 28})
    return star, pd.DataFrame(rows, columns=fact.columns)


def test_traffic_with_hot_airport(skewed):
    star, pdf = skewed
    got = {r.airport_code: r.traffic for r in metrics.top_airports(star, k=40).collect()}
    want = pd.concat([pdf.origin_airport_key, pdf.dest_airport_key]).value_counts()
    assert got == {f"A{k:02d}": int(v) for k, v in want.items()}
    assert got["A01"] > len(pdf) / 3


def test_rankings_distributed_equal_window(skewed):
    star, _ = skewed
    small = {r.airport_code: r.rank for r in metrics.airport_rankings(star, k=None).collect()}
    unbounded = Star(star.fact, star.dim_airline, star.dim_airport, star.dim_date,
                     rows={"dim_airline": 9, "dim_date": 28})  # no bound -> distributed path
    big = {r.airport_code: r.rank for r in metrics.airport_rankings(unbounded, k=None).collect()}
    assert small == big and small["A01"] == 1


def test_reliability_hot_airline(skewed):
    star, pdf = skewed
    got = {r.airline_name: (r.total_flights, r.cancelled_flights)
           for r in kpi.carrier_reliability(star).collect()}
    g = pdf.groupby("airline_key").agg(n=("CANCELLED", "size"), c=("CANCELLED", "sum"))
    assert got == {f"Carrier {k}": (int(r.n), int(r.c)) for k, r in g.iterrows()}


def test_histogram_per_airline(skewed):
    star, pdf = skewed
    h = dist.histogram(star.fact, "DEPARTURE_DELAY", 10, -30, 120, by="airline_key").collect()
    for key, grp in pdf.groupby("airline_key"):
        vals = grp.DEPARTURE_DELAY[(grp.DEPARTURE_DELAY >= -30) & (grp.DEPARTURE_DELAY <= 120)]
        import numpy as np
        counts, _ = np.histogram(vals, bins=10)
        got = [r.frequency for r in sorted((r for r in h if r.airline_key == key),
                                           key=lambda r: r.bin)]
        assert got == list(counts)


def test_drilldowns_for_one_key_equal_the_all_keys_rows(skewed):
    star, _ = skewed

    def rows(df, key=None):
        return sorted(map(tuple, df.collect()), key=repr)

    one = metrics.carrier_kpis(star, carrier_key=1)
    allk = metrics.carrier_kpis(star).where("airline_key = 1")
    assert rows(one) == rows(allk)
    one = metrics.airport_kpis(star, airport_key=1)
    allk = metrics.airport_kpis(star).where("airport_key = 1")
    assert rows(one) == rows(allk)
    one = metrics.top_destinations(star, airport_key=1)
    allk = metrics.top_destinations(star).where("hub_key = 1")
    assert rows(one) == rows(allk) and len(rows(one)) == 10
    daily = {r.full_date: r.flights for r in metrics.carrier_daily(star, carrier_key=1).collect()}
    assert sum(daily.values()) == star.fact.where("airline_key = 1").count()
