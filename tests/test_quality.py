"""Data-quality checks (K1-K16, F39) on inline rows with NULLs (the driver data has none)."""

from contrail.operators import quality
from contrail.spec import Star


def test_orphans_ignore_null_keys(spark):
    # NOT IN semantics fixed (S9): NULL fact keys are not orphans, NULL dim keys are ignored
    fact = spark.createDataFrame([(1,), (2,), (None,), (3,)], "fk int")
    dim = spark.createDataFrame([(1,), (None,)], "pk int")
    r = quality.orphan_check(fact, [("fk", dim, "pk", 2)]).first()
    assert r.failures == 2 and r.status == "FAIL" and r.checked == 4


def test_rule_check_tolerates_five_outliers(spark):
    rows = [(-61.0, 0.0, 0, 0)] * 5 + [(10.0, -70.0, 0, 0)] * 6
    df = spark.createDataFrame(rows, "DEPARTURE_DELAY double, ARRIVAL_DELAY double, "
                                     "CANCELLED int, DIVERTED int")
    st = {r.check: (r.failures, r.status) for r in quality.rule_check(df).collect()}
    assert st["DEPARTURE_DELAY >= -60"] == (5, "WARN")
    assert st["ARRIVAL_DELAY >= -60"] == (6, "FAIL")
    assert st["cancellation rate in [0, 100]"] == (0, "PASS")


def test_rule_check_missing_column_fails(spark):
    df = spark.createDataFrame([(1.0,)], "DEPARTURE_DELAY double")
    st = {r.check: r.status for r in quality.rule_check(df).collect()}
    assert st["ARRIVAL_DELAY (column missing)"] == "FAIL"


def test_null_check_and_rollup(spark):
    df = spark.createDataFrame([("AA", None, "LAX")], "AIRLINE string, ORIGIN_AIRPORT string, "
                                                     "DESTINATION_AIRPORT string")
    res = quality.null_check(df)
    roll = quality.dq_rollup(res).first()
    assert roll.overall_status == "FAIL" and roll.failed == 1
    assert roll.failed_checks == "raw:ORIGIN_AIRPORT nulls"


def _star(spark):
    fact = spark.createDataFrame(
        [(1, 1, 2, 20150101, 1.0, None), (9, 1, None, 20150101, None, 2.0)],
        "airline_key int, origin_airport_key int, dest_airport_key int, date_key int, "
        "DEPARTURE_DELAY double, ARRIVAL_DELAY double")
    da = spark.createDataFrame([(1, "AA", "A"), (1, "AA", "A")],
                               "airline_key int, airline_code string, airline_name string")
    dp = spark.createDataFrame([(1, "X"), (2, "Y")], "airport_key int, airport_code string")
    dd = spark.createDataFrame([(20150101,)], "date_key int")
    return Star(fact=fact, dim_airline=da, dim_airport=dp, dim_date=dd,
                rows={"dim_airline": 2, "dim_airport": 2, "dim_date": 1})


def test_star_checks_and_matrix(spark):
    s = _star(spark)
    checks = {r.check: r.value for r in quality.star_checks(s).collect()}
    assert checks["orphan airline keys"] == 1 and checks["null dest airport keys"] == 1
    assert checks["duplicate airline keys"] == 1
    assert quality.star_status(quality.star_checks(s)).first().status == "FAILED"
    m = {r.rule: (r.failures, r.status) for r in quality.rule_matrix(s).collect()}
    assert m["Orphan Airline Refs"] == (1, "WARNING")
    assert m["Departure Delay Nulls"] == (1, "WARNING")
    score = quality.matrix_score(quality.rule_matrix(s)).first()
    # 5 non-PASS rules of 12 -> 58.3 -> CRITICAL
    assert score.failed_checks == 5 and score.dq_score == 58.3
    assert score.score_label == "CRITICAL"


def test_reconcile(spark):
    a = spark.range(3)
    b = spark.range(3)
    pub = spark.createDataFrame([(3,)], "TOTAL_FLIGHTS long")
    r = quality.reconcile({"raw": a, "cleaned": b, "published": (pub, "TOTAL_FLIGHTS")}).first()
    assert r.status == "PASS"
    r = quality.reconcile({"raw": a, "cleaned": spark.range(2)}).first()
    assert r.status == "FAIL"


def test_kpi_audit_tolerance(spark):
    cols = ("TOTAL_FLIGHTS long, TOTAL_AIRLINES long, TOTAL_AIRPORTS long, "
            "CANCELLATION_RATE double, DIVERSION_RATE double, AVG_DEPARTURE_DELAY double, "
            "AVG_ARRIVAL_DELAY double")
    pub = spark.createDataFrame([(10, 2, 3, 1.234, 0.5, 5.04, 6.0)], cols)
    rec = spark.createDataFrame([(10, 2, 3, 1.3, 0.5, 5.0, 6.5)], cols)
    st = {r.metric: r.status for r in quality.kpi_audit(pub, rec).collect()}
    assert st["TOTAL_FLIGHTS"] == "PASS" and st["CANCELLATION_RATE"] == "PASS"
    assert st["AVG_ARRIVAL_DELAY"] == "FAIL"


def test_type_check(spark):
    df = spark.createDataFrame([(2015, "x")], "YEAR int, DEPARTURE_DELAY string")
    st = {r.check: r.status for r in quality.type_check(df).collect()}
    assert st["YEAR is integer"] == "PASS" and st["MONTH is integer"] == "FAIL"
    assert st["DEPARTURE_DELAY is numeric"] == "FAIL"


def test_optional_filters_fold(spark):
    from contrail.plans import metrics
    s = _star(spark)
    fact = spark.createDataFrame(
        [(1, 20150101, 10.0, 1.0, 2.0, 3.0, 4.0, 5.0), (2, 20150101, 20.0, 9.0, 9.0, 9.0, 9.0, 9.0),
         (1, 20150102, -5.0, 7.0, 7.0, 7.0, 7.0, 7.0)],
        "airline_key int, date_key int, ARRIVAL_DELAY double, WEATHER_DELAY double, "
        "AIRLINE_DELAY double, SECURITY_DELAY double, AIR_SYSTEM_DELAY double, "
        "LATE_AIRCRAFT_DELAY double")
    s.fact = fact
    all_ = metrics.cause_averages(s).first()
    assert all_["Weather"] == 5.0  # ARRIVAL_DELAY > 0 keeps rows 1 and 2
    one = metrics.cause_averages(s, carrier_key=1, date_key=20150101).first()
    assert one["Weather"] == 1.0 and one["Late Aircraft"] == 5.0
    long = {r.category: r.avg_minutes for r in metrics.cause_averages(s, long=True).collect()}
    assert list(long) == ["Weather", "Airline", "Security", "NAS", "Late Aircraft"]


def test_capitalize_and_map(spark):
    from contrail.functions.scalar import capitalize, map_values
    df = spark.createDataFrame([("late aircraft", "FAIL"), ("EXTRACT", "X")], "p string, s string")
    r = df.select(capitalize("p").alias("c"), map_values("s", {"FAIL": "red"}, "blue").alias("m"))
    assert [(x.c, x.m) for x in r.collect()] == [("Late aircraft", "red"), ("Extract", "blue")]


def test_run_checks_and_rollup(spark):
    raw = spark.createDataFrame(
        [(2015, 1, 1, "AA", "JFK", "XXX", 5.0, 1.0, 0, 0), (2015, 1, 1, "ZZ", "JFK", "JFK", -90.0, 1.0, 0, 0)],
        "YEAR int, MONTH int, DAY int, AIRLINE string, ORIGIN_AIRPORT string, "
        "DESTINATION_AIRPORT string, DEPARTURE_DELAY double, ARRIVAL_DELAY double, "
        "CANCELLED int, DIVERTED int")
    air = spark.createDataFrame([("AA", "A")], "IATA_CODE string, AIRLINE string")
    apt = spark.createDataFrame([("JFK", "K")], "IATA_CODE string, AIRPORT string")
    res = quality.run_checks(raw, raw, air, apt)
    st = {r.check: r.status for r in res.collect()}
    assert st["AIRLINE in reference"] == "FAIL"
    assert st["DESTINATION_AIRPORT in reference"] == "WARN"
    assert st["DEPARTURE_DELAY >= -60"] == "WARN"
    roll = quality.dq_rollup(res).first()
    assert roll.overall_status == "FAIL" and "raw:AIRLINE in reference" in roll.failed_checks
