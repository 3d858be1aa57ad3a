"""Histograms vs numpy, readers/writers, run-log JSON."""

import json
import os

import numpy as np
import pytest
from pyspark.errors import AnalysisException

from contrail.plans import dist
from contrail.sources import io, runlog
from contrail.spec import AIRLINES_SCHEMA


def test_histogram_matches_numpy(spark):
    vals = [-20.0, -5.0, 0.0, 0.0, 3.0, 17.5, 60.0, 179.0, 180.0, 250.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = dist.histogram(df, "x", 50, -20, 180).orderBy("bin").collect()
    inside = [v for v in vals if -20 <= v <= 180]
    counts, edges = np.histogram(inside, bins=50)
    assert [r.frequency for r in got] == list(counts)
    assert np.allclose([r.bin_lo for r in got], edges[:-1])


def test_histogram_single_value_and_groups(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("b", 1.0), ("b", 3.0)], "g string, x double")
    got = dist.histogram(df, "x", 4, None, None, by="g").collect()
    a = {r.bin: r.frequency for r in got if r.g == "a"}
    b = {r.bin: r.frequency for r in got if r.g == "b"}
    assert a == {1: 2, 2: 0, 3: 0, 4: 0} and b == {1: 1, 2: 0, 3: 0, 4: 1}


def test_delay_stats(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 10]], "d double")
    r = dist.delay_stats(df, "d").first()
    assert r.n == 5 and r.median == 3.0 and np.isclose(r.p90, np.percentile([1, 2, 3, 4, 10], 90))
    assert np.isclose(r.std, np.std([1, 2, 3, 4, 10], ddof=1))


def test_reference_csv_roundtrip_and_errors(spark, tmp_out):
    df = spark.createDataFrame([("AA", "American"), ("UA", "United")], AIRLINES_SCHEMA)
    io.write_table(df, f"{tmp_out}/air", fmt="csv")
    back = io.read_reference(spark, f"{tmp_out}/air", AIRLINES_SCHEMA)
    assert sorted(r.IATA_CODE for r in back.collect()) == ["AA", "UA"]
    open(f"{tmp_out}/empty.csv", "w").write("IATA_CODE,AIRLINE\n")
    with pytest.raises(ValueError):
        io.read_reference(spark, f"{tmp_out}/empty.csv", AIRLINES_SCHEMA)
    with pytest.raises(AnalysisException):
        io.read_reference(spark, f"{tmp_out}/missing.csv", AIRLINES_SCHEMA)
    with pytest.raises(ValueError):
        io.read_fact(spark, f"{tmp_out}/air", row_limit=0)


def test_source_checks_and_contract(spark, tmp_out):
    open(f"{tmp_out}/a.csv", "w").write("IATA_CODE,AIRLINE\nAA,x\n")
    st = {r.name: r.status for r in io.check_sources(
        spark, {"airlines": f"{tmp_out}/a.csv", "flights": f"{tmp_out}/nope.csv"}).collect()}
    assert st == {"airlines": "PASS", "flights": "FAIL"}
    df = spark.createDataFrame([("AA",)], "IATA_CODE string")
    r = io.check_contract(df, "airlines", ["IATA_CODE", "AIRLINE"]).first()
    assert r.status == "FAIL" and "AIRLINE" in r.detail


def test_run_metadata_json(spark, tmp_out):
    doc = {"pipeline_name": "p", "pipeline_version": "1", "run_id": "r1",
           "run_timestamp": "2024-01-02T03:04:05", "total_duration_seconds": 3.5,
           "overall_status": "SUCCESS",
           "phases": [{"phase_name": "extract", "status": "SUCCESS", "start_time": "a",
                       "end_time": "b", "duration_seconds": 1.5, "error_message": None},
                      {"phase_name": "load", "status": "FAILED", "start_time": "c",
                       "end_time": "d", "duration_seconds": 2.0, "error_message": "x"}]}
    os.makedirs(f"{tmp_out}/md")
    with open(f"{tmp_out}/md/run.json", "w") as fh:
        json.dump(doc, fh, indent=2)
    runs, phases = runlog.read_run_json(spark, f"{tmp_out}/md")
    assert runs.first().overall_status == "SUCCESS"
    ph = phases.orderBy("id").collect()
    assert [(p.id, p.phase_name, p.status) for p in ph] == [(1, "extract", "SUCCESS"),
                                                            (2, "load", "FAILED")]
    rep = runlog.run_report(phases).first()
    assert rep.total_phases == 2 and rep.failed_phases == 1 and rep.success_rate == 50.0
    f = runlog.freshness(runs, "2024-01-03 03:04:05").first()
    assert f.freshness == "Aging" and f.hours_ago == 24.0
    assert runlog.health(runs).first().health == "HEALTHY"


def _write_sources(spark, tmp_out, n=1200):
    flights = spark.range(n).selectExpr(
        "2015 AS YEAR", "1 + id % 12 AS MONTH", "1 + id % 28 AS DAY", "1 + id % 7 AS DAY_OF_WEEK",
        "CASE WHEN id % 2 = 0 THEN 'AA' ELSE 'UA' END AS AIRLINE",
        "CAST(id AS STRING) AS FLIGHT_NUMBER", "'JFK' AS ORIGIN_AIRPORT",
        "'LAX' AS DESTINATION_AIRPORT", "CAST(id % 50 - 10 AS DOUBLE) AS DEPARTURE_DELAY",
        "CAST(id % 40 - 5 AS DOUBLE) AS ARRIVAL_DELAY", "0 AS CANCELLED", "0 AS DIVERTED")
    io.write_table(flights.coalesce(1), f"{tmp_out}/flights", fmt="csv")
    open(f"{tmp_out}/airlines.csv", "w").write("IATA_CODE,AIRLINE\nAA,American\nUA,United\n")
    open(f"{tmp_out}/airports.csv", "w").write(
        "IATA_CODE,AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\n"
        "JFK,Kennedy,New York,NY,USA,40.6,-73.8\nLAX,Los Angeles,LA,CA,USA,,\n")
    return {"flights": f"{tmp_out}/flights", "airlines": f"{tmp_out}/airlines.csv",
            "airports": f"{tmp_out}/airports.csv"}


def test_extract_row_limit_and_profiles(spark, tmp_out):
    from contrail.spec import FLIGHTS_SCHEMA
    paths = _write_sources(spark, tmp_out)
    src = io.extract(spark, paths, row_limit=1000)
    assert src.flights.count() == 1000  # "first N rows" cap (S1)
    assert io.read_fact(spark, paths["flights"], FLIGHTS_SCHEMA, row_limit=500).count() == 500
    assert io.read_fact(spark, paths["flights"], FLIGHTS_SCHEMA).count() == 1200  # None = all (S2)
    prof = {r.dataset: r.row_count for r in src.profiles.collect()}
    assert prof == {"flights": 1000, "airlines": 2, "airports": 2}
    ap = {r.IATA_CODE: r.LATITUDE for r in src.airports.collect()}
    assert ap["LAX"] is None and ap["JFK"] == 40.6
    for c in ("YEAR", "MONTH", "DAY", "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT"):
        assert c in src.flights.columns


def test_load_layers_fallback_and_table_checks(spark, tmp_out):
    paths = _write_sources(spark, tmp_out, n=10)
    layers, status = io.load_layers(spark, dict(paths, cleaned=f"{tmp_out}/no_cleaned"))
    assert status.first().status == "WARN"
    assert layers["cleaned_flights"].count() == 10
    io.write_table(layers["raw_flights"], f"{tmp_out}/fact_parquet")
    st = {(r.name, r.check): r.status for r in io.check_tables(
        spark, {"fact": f"{tmp_out}/fact_parquet", "gone": f"{tmp_out}/gone"}).collect()}
    assert st[("fact", "exists")] == "PASS" and st[("fact", "non_empty")] == "PASS"
    assert st[("gone", "exists")] == "FAIL"


def test_table_inventory(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    rows = {(r.table_name, r.column_name): (r.data_type, r.row_count)
            for r in io.table_inventory({"a": a}).collect()}
    assert rows == {("a", "k"): ("int", 2), ("a", "v"): ("string", 2)}


def test_sampled_read_and_approx_stats(spark, tmp_out):
    paths = _write_sources(spark, tmp_out, n=2000)
    from contrail.spec import FLIGHTS_SCHEMA
    n = io.read_fact(spark, paths["flights"], FLIGHTS_SCHEMA, fraction=0.5, seed=7).count()
    assert 800 < n < 1200
    df = spark.createDataFrame([(float(v),) for v in range(101)], "d double")
    r = dist.delay_stats(df, "d", approx=True).first()
    assert r.n == 101 and r.median == 50.0 and r.p90 == 90.0
