"""End to end on 1000 flights written as CSV files, after the reference's
integration test: extract -> clean -> normalize -> star -> analytics -> checks."""

from contrail.operators import clean, model, quality
from contrail.plans import kpi, metrics
from contrail.sources import io


def test_pipeline_end_to_end(spark, tmp_out):
    n = 1000
    flights = spark.range(n).selectExpr(
        "2015 AS YEAR", "1 + id % 12 AS MONTH", "1 + id % 28 AS DAY", "1 + id % 7 AS DAY_OF_WEEK",
        "element_at(array('AA', 'UA', 'DL', 'WN'), CAST(1 + id % 4 AS INT)) AS AIRLINE",
        "CAST(100 + id % 37 AS STRING) AS FLIGHT_NUMBER",
        "element_at(array('JFK', 'LAX', 'ORD'), CAST(1 + id % 3 AS INT)) AS ORIGIN_AIRPORT",
        "element_at(array('LAX', 'ORD', 'ATL', 'DEN'), CAST(1 + id % 4 AS INT)) AS DESTINATION_AIRPORT",
        "CASE WHEN id % 50 = 0 THEN NULL ELSE CAST(id % 90 - 20 AS STRING) END AS DEPARTURE_DELAY",
        "CASE WHEN id % 40 = 0 THEN NULL ELSE CAST(id % 70 - 15 AS DOUBLE) END AS ARRIVAL_DELAY",
        "CAST(id % 50 = 0 AS INT) AS CANCELLED", "0 AS DIVERTED",
        "CAST(500 + id % 1000 AS DOUBLE) AS DISTANCE")
    io.write_table(flights.coalesce(1), f"{tmp_out}/raw/flights", fmt="csv")
    with open(f"{tmp_out}/airlines.csv", "w") as fh:
        fh.write("IATA_CODE,AIRLINE\nAA,American\nUA,United\nDL,Delta\nWN,Southwest\n")
    with open(f"{tmp_out}/airports.csv", "w") as fh:
        fh.write("IATA_CODE,AIRPORT,CITY,STATE,COUNTRY,LATITUDE,LONGITUDE\n"
                 "JFK,Kennedy,New York,NY,USA,40.6,-73.8\nLAX,Los Angeles,LA,CA,USA,33.9,-118.4\n"
                 "ORD,O'Hare,Chicago,IL,USA,41.9,-87.9\nATL,Atlanta,Atlanta,GA,USA,33.6,-84.4\n")
    paths = {"flights": f"{tmp_out}/raw/flights", "airlines": f"{tmp_out}/airlines.csv",
             "airports": f"{tmp_out}/airports.csv"}
    src = io.extract(spark, paths)
    assert src.flights.count() == n

    # transform: text delays validated, gaps imputed, nothing dropped
    cleaned, report = clean.clean_fact(src.flights)
    io.write_table(cleaned, f"{tmp_out}/cleaned")
    cleaned = io.read_table(spark, f"{tmp_out}/cleaned")
    r = report.first()
    assert r.initial_rows == r.final_rows == n and r.rows_removed == 0
    assert cleaned.where("DEPARTURE_DELAY IS NULL OR ARRIVAL_DELAY IS NULL").count() == 0

    # load: normalized tables, star, load validation
    tables = model.normalize_written(spark, cleaned, f"{tmp_out}/wh", on_unmatched="raise")
    model.write_star(model.build_star(tables, src.airlines, src.airports), f"{tmp_out}/wh")
    star = model.read_star(spark, f"{tmp_out}/wh")
    quality.assert_loaded(quality.load_check(tables))
    assert star.fact.count() == n
    dims = {r.airport_code: r.airport_name for r in star.dim_airport.collect()}
    # DEN is not in the reference file: its member keeps NULL code and name
    assert dims[None] is None and dims["JFK"] == "Kennedy" and len(dims) == 5

    # analytics and checks
    summary = metrics.executive_summary(tables).first()
    assert summary.TOTAL_FLIGHTS == n and summary.TOTAL_AIRLINES == 4
    orphans = quality.orphan_check(star.fact, [
        ("airline_key", star.dim_airline, "airline_key", star.rows["dim_airline"]),
        ("origin_airport_key", star.dim_airport, "airport_key", star.rows["dim_airport"]),
        ("dest_airport_key", star.dim_airport, "airport_key", star.rows["dim_airport"])])
    assert all(o.failures == 0 for o in orphans.collect())
    rec = quality.reconcile({"raw": src.flights, "cleaned": cleaned, "loaded": star.fact,
                             "published": (metrics.executive_summary(tables), "TOTAL_FLIGHTS")})
    assert rec.first().status == "PASS"
    ref = quality.ref_check(src.flights, "DESTINATION_AIRPORT", src.airports, on_fail="WARN")
    assert ref.first().status == "WARN"
    rel = kpi.carrier_reliability(star).collect()
    assert sorted(x.airline_name for x in rel) == ["American", "Delta", "Southwest", "United"]
    assert sum(x.total_flights for x in rel) == n


def test_analytics_output_contracts(spark):
    """Column sets, one executive row and descending order of the analytic datasets."""
    from contrail.plans.catalog import CONTRACTS
    from contrail.sources import bindings
    t = bindings.normalized(spark, "/root/testdata/sf0.001")
    data = {"executive_summary": metrics.executive_summary(t),
            "airline_performance": metrics.carrier_performance(t),
            "airport_traffic": metrics.airport_traffic(t),
            "delay_analysis": metrics.delay_analysis(t)}
    for name, cols in CONTRACTS.items():
        assert data[name].columns == cols, name
    assert data["executive_summary"].count() == 1
    counts = [r.FLIGHT_COUNT for r in data["airline_performance"].collect()]
    assert counts == sorted(counts, reverse=True) and counts
    traffic = [r.TOTAL_TRAFFIC for r in data["airport_traffic"].collect()]
    assert traffic == sorted(traffic, reverse=True) and traffic
    codes = [r.AIRLINE_CODE for r in data["delay_analysis"].collect()]
    assert codes == sorted(codes)
