"""Formula notes of SURVEY 2.6.1 on small inline stars."""

import pandas as pd

from contrail.operators import model
from contrail.plans import kpi, metrics
from contrail.spec import Star


def _star(spark, rows):
    fact = spark.createDataFrame(rows, "airline_key int, origin_airport_key int, "
                                       "dest_airport_key int, date_key int, DEPARTURE_DELAY double, "
                                       "ARRIVAL_DELAY double, CANCELLED int, DIVERTED int, "
                                       "DISTANCE double")
    apt = spark.createDataFrame([(k, f"P{k}", f"Port {k}") for k in range(1, 5)],
                                "airport_key int, airport_code string, airport_name string")
    air = spark.createDataFrame([(1, "AA", "Alpha"), (2, "BB", "Beta")],
                                "airline_key int, airline_code string, airline_name string")
    return Star(fact=fact, dim_airline=air, dim_airport=apt, dim_date=model.date_dim(fact),
                rows={"dim_airline": 2, "dim_airport": 4, "dim_date": 10})


def test_airport_efficiency_filter_before_rank(spark):
    rows = ([(1, 1, 2, 20150101, 30.0, 1.0, 0, 0, 100.0)] * 3      # P1: 3 departures, worst
            + [(1, 2, 1, 20150101, 20.0, 1.0, 0, 0, 100.0)] * 2    # P2: 2 departures (filtered)
            + [(1, 3, 1, 20150102, 10.0, None, 0, 0, 100.0)] * 3   # P3: best
            + [(1, 4, 1, 20150102, None, None, 1, 0, 100.0)])       # P4: 1 departure
    s = _star(spark, rows)
    got = {r.airport_code: (r.total_departures, r.efficiency_rank, r.delay_rate)
           for r in kpi.airport_efficiency(s, min_departures=2).collect()}
    # strictly more than 2 departures; the filtered airports take no rank positions
    assert got == {"P3": (3, 1, 0.0), "P1": (3, 2, 100.0)}


def test_route_threshold_inclusive_and_limit(spark):
    rows = ([(1, 1, 2, 20150101, 0.0, 10.0, 0, 0, 500.0)] * 3
            + [(1, 2, 3, 20150101, 0.0, 20.0, 1, 0, 700.0)] * 2
            + [(1, 3, 4, 20150101, 0.0, 5.0, 0, 0, 900.0)])
    s = _star(spark, rows)
    r = metrics.routes(s, min_flights=2, limit=None).collect()
    assert [(x.route, x.flights, x.cancel_rate) for x in r] == [("P1 -> P2", 3, 0.0),
                                                                ("P2 -> P3", 2, 100.0)]
    assert r[1].avg_distance_mi == 700.0
    assert len(metrics.routes(s, min_flights=1, limit=1).collect()) == 1
    batch = kpi.route_intelligence(s, min_flights=3).collect()
    assert [x.route for x in batch] == ["P1 → P2"]


def test_moving_average_and_period_change(spark):
    pdf = pd.DataFrame({"d": pd.date_range("2015-01-01", periods=10).date,
                        "v": [3, 1, 4, 1, 5, 9, 2, 6, 5, 3]})
    df = spark.createDataFrame(pdf)
    ma = [r.v_ma3 for r in kpi.moving_average(df, "v", "d", 3).orderBy("d").collect()]
    assert ma == list(pdf.v.rolling(3, min_periods=1).mean())
    ch = kpi.period_change(df, "v", "d").orderBy("d").collect()
    assert ch[0].prev_v is None and ch[1].v_change == -2 and ch[2].v_change_pct == 300.0


def test_lazy_normalize_matches_written(spark, tmp_out):
    f = spark.createDataFrame([("UA", "SFO", "JFK"), ("AA", "JFK", "LAX"), ("AA", "LAX", "SFO")],
                              "AIRLINE string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string")
    lazy = model.normalize(f)  # no bounds: distributed surrogate keys, joins chosen by Spark
    written = model.normalize_written(spark, f, tmp_out)
    key = ["AIRLINE_ID", "ORIGIN_AIRPORT_ID", "DESTINATION_AIRPORT_ID"]
    assert sorted(map(tuple, lazy.flights.select(key).collect())) == \
        sorted(map(tuple, written.flights.select(key).collect()))
    assert {r.AIRPORT: r.AIRPORT_ID for r in lazy.airports.collect()} == \
        {"JFK": 1, "LAX": 2, "SFO": 3}


def test_reliability_groups_unmatched_names(spark):
    # two airline keys without a reference name collapse into one NULL-name group
    rows = [(1, 1, 2, 20150101, 0.0, 1.0, 0, 0, 1.0), (3, 1, 2, 20150101, 0.0, 3.0, 1, 0, 1.0),
            (4, 1, 2, 20150101, 0.0, 5.0, 0, 0, 1.0)]
    s = _star(spark, rows)
    s.dim_airline = spark.createDataFrame([(1, "AA", "Alpha"), (3, None, None), (4, None, None)],
                                          "airline_key int, airline_code string, airline_name string")
    got = {r.airline_name: (r.total_flights, r.cancelled_flights, r.avg_delay_mins)
           for r in kpi.carrier_reliability(s).collect()}
    assert got == {"Alpha": (1, 0, 1.0), None: (2, 1, 4.0)}


def test_normalize_written_keys_by_code(spark, tmp_out):
    f = spark.createDataFrame([("UA", "SFO", "JFK"), ("AA", "JFK", "LAX"), ("AA", "LAX", "SFO")],
                              "AIRLINE string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string")
    got = model.normalize_written(spark, f, tmp_out + "/a")
    assert sorted(map(tuple, got.airlines.collect())) == [("AA", 1), ("UA", 2)]
    assert sorted(r.AIRPORT for r in got.airports.collect()) == ["JFK", "LAX", "SFO"]
    assert got.counts == {"airlines": 2, "airports": 3}


def test_day_filter_and_year_pruning_predicate(spark):
    from pyspark.sql import functions as F
    from contrail.plans.common import on_date
    rows = [(1, 1, 2, 20150101, 0.0, 10.0, 0, 0, 1.0), (2, 1, 2, 20150102, 0.0, 30.0, 0, 0, 1.0),
            (1, 1, 2, 20150102, 0.0, 20.0, 0, 0, 1.0)]
    s = _star(spark, rows)
    got = {r.airline_name: r.avg_delay for r in metrics.carrier_delay(s, date_key=20150102)
           .collect()}
    assert got == {"Beta": 30.0, "Alpha": 20.0}
    with_year = s.fact.withColumn("year", F.lit(2015))
    assert with_year.where(on_date(with_year, 20150102)).count() == 2
    assert "year" in str(on_date(with_year, 20150102)) and "year" not in str(on_date(s.fact, 1))


def test_monthly_trend_by_year_and_running_total(spark):
    rows = [(1, 1, 2, 20141201, 10.0, 1.0, 0, 0, 1.0), (1, 1, 2, 20150101, 20.0, 1.0, 1, 0, 1.0),
            (1, 1, 2, 20151205, 30.0, 1.0, 0, 0, 1.0)]
    s = _star(spark, rows)
    merged = [(r.month, r.total_flights, r.running_total_flights)
              for r in kpi.monthly_trend(s).collect()]
    assert merged == [(1, 1, 1), (12, 2, 3)]  # years merge by default (S21)
    split = [(r.year, r.month, r.running_total_flights)
             for r in kpi.monthly_trend(s, by_year=True).collect()]
    assert split == [(2014, 12, 1), (2015, 1, 2), (2015, 12, 3)]


def test_map_keys_drop_and_partitioned_write(spark, tmp_out):
    from contrail.sources import io
    f = spark.createDataFrame([("AA", 2015), ("XX", 2016)], "AIRLINE string, YEAR int")
    keyed = spark.createDataFrame([("AA", 1)], "AIRLINE string, AIRLINE_ID int")
    out = model.map_keys(f, [("AIRLINE", keyed, "AIRLINE", "AIRLINE_ID", "AIRLINE_ID", 1)],
                         on_unmatched="drop")
    assert [(r.AIRLINE, r.AIRLINE_ID) for r in out.collect()] == [("AA", 1)]
    io.write_table(f, f"{tmp_out}/by_year", partition_by=("YEAR",))
    back = io.read_table(spark, f"{tmp_out}/by_year")
    assert sorted((r.AIRLINE, r.YEAR) for r in back.collect()) == [("AA", 2015), ("XX", 2016)]


def test_column_counts_exact_and_approx(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "x string, y int")
    for approx in (False, True):
        got = {r.column_name: (r.non_null_count, r.distinct_count)
               for r in metrics.column_counts(df, ["x", "y"], approx).collect()}
        assert got == {"x": (2, 1), "y": (2, 2)}
