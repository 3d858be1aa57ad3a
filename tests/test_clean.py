"""Cleaning operators on the reference's inline unit fixtures."""

import math

from pyspark.sql import functions as F

from contrail.operators import clean, profile


def test_impute_median_and_unknown(spark):
    df = spark.createDataFrame(
        [(10.0, "UA", 0), (None, "AA", 0), (20.0, None, 1), (15.0, "DL", 0)],
        "DEPARTURE_DELAY double, AIRLINE string, CANCELLED int")
    out = clean.impute(df).collect()
    assert out[1]["DEPARTURE_DELAY"] == 15.0
    assert out[2]["AIRLINE"] == "UNKNOWN"
    assert all(v is not None for r in out for v in r)
    # a column without gaps keeps its type
    assert dict(clean.impute(df).dtypes)["CANCELLED"] == "int"


def test_impute_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert [r.x for r in clean.impute(df).collect()] == [1.0, 2.0, 3.0]


def test_impute_policy_keep(spark):
    df = spark.createDataFrame([(1.0, None), (None, "a")], "x double, s string")
    out = clean.impute(df, policy={"x": "keep"}).collect()
    assert out[1]["x"] is None and out[0]["s"] == "UNKNOWN"


def test_dedupe_whole_rows(spark):
    rows = [(2015, 1, 1, 101)] * 3 + [(2015, 1, 1, 102)]
    df = spark.createDataFrame(rows, "YEAR int, MONTH int, DAY int, FLIGHT_NUMBER int")
    assert clean.dedupe(df).count() == 2


def test_dedupe_keep_first_by_order_with_hot_key(spark):
    # one key holds most rows: the min_by aggregate keeps the earliest one
    rows = [("hot", i, f"v{i}") for i in range(5000, 0, -1)] + [("cold", 7, "c")]
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    for method in ("shuffle", "hash"):
        out = {r.k: (r.seq, r.v) for r in clean.dedupe(df, ["k"], "seq", method).collect()}
        assert out == {"hot": (1, "v1"), "cold": (7, "c")}


def test_validate_numeric(spark):
    df = spark.createDataFrame(
        [("10", 5.0), ("  -15.5", 12.0), ("nan", None), ("abc", float("nan"))],
        "DEPARTURE_DELAY string, ARRIVAL_DELAY double")
    out = clean.validate_numeric(df, ["DEPARTURE_DELAY", "ARRIVAL_DELAY"]).collect()
    assert dict(clean.validate_numeric(df).dtypes)["DEPARTURE_DELAY"] == "double"
    assert [r.DEPARTURE_DELAY for r in out] == [10.0, -15.5, None, None]
    assert [r.ARRIVAL_DELAY for r in out] == [5.0, 12.0, None, None]


def test_validate_rejects_java_suffixes(spark):
    df = spark.createDataFrame([("1d",), ("2f",), ("1e3",), (" 7 ",)], "x string")
    assert [r.x for r in clean.validate_numeric(df, ["x"]).collect()] == [None, None, 1000.0, 7.0]


def test_invalid_numeric_pattern(spark):
    vals = ["10", "-15.5", "5.", ".5", "nan", "abc", "1d", "1e3", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "WEATHER_DELAY string")
    rep = clean.invalid_numeric_report(df, ["WEATHER_DELAY"]).collect()
    assert rep[0]["invalid_count"] == 4  # abc, 1d, 1e3, blank


def test_quality_score_text_column(spark):
    # 4 rows, one missing cell of 8, no duplicates; the text delay column has
    # 2 non-numeric values (one of them NULL, S23): min(2, 0.5*10) = 2
    df = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None), ("d", "4")],
                               "k string, WEATHER_DELAY string")
    r = profile.quality_score(df).first()
    # missing 12.5% -> 6.25; type 2 -> 100 - 6.25 - 2 = 91.75 -> 91
    assert r.quality_score == 91 and r.grade == "Excellent"
    assert math.isclose(r.missing_percentage, 12.5)


def test_clean_report_counts(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 0, 0), (1.0, 2.0, 0, 0), (None, -1.0, 1, 0)],
        "DEPARTURE_DELAY double, ARRIVAL_DELAY double, CANCELLED int, DIVERTED int")
    cleaned, report = clean.clean_fact(df)
    r = report.first()
    assert r.initial_rows == 3 and r.duplicates_before == 1
    assert r.final_rows == cleaned.count() == 2
    assert r.rows_removed == 1 and r.total_missing == 1


def test_missing_report_long_form(spark):
    df = spark.createDataFrame([(None, "x"), (1, None), (2, None)], "a int, b string")
    rows = {r.column_name: r.missing_count for r in profile.missing_report(df).collect()}
    assert rows == {"a": 1, "b": 2}
    assert profile.missing_summary(df).first().total_missing == 3
    assert F is not None


def test_distinct_row_count_hash_first(spark):
    rows = [(1, "a", None)] * 50 + [(2, "b", 1.0), (2, "b", 1.0), (None, None, None), (3, "c", 2.0)]
    df = spark.createDataFrame(rows, "x int, y string, z double")
    assert profile.distinct_row_count(df).first()["_uniq"] == df.distinct().count() == 4
    r = profile.duplicate_report(df).first()
    assert r.duplicate_rows == len(rows) - 4


def test_dedupe_nulls_and_hash_equal_rows(spark):
    # xxhash64 skips NULLs, so (NULL, 'a') and ('a', NULL) hash alike: both must survive
    rows = [(None, "a"), ("a", None), ("a", None), (None, None), (None, None), ("b", "c")]
    df = spark.createDataFrame(rows, "x string, y string")
    for method in ("shuffle", "hash"):
        got = sorted(map(tuple, clean.dedupe(df, method=method).collect()), key=repr)
        assert got == sorted(set(rows), key=repr)


def test_dedupe_by_key_with_null_keys(spark):
    rows = [(None, 3, "late"), (None, 1, "early"), ("k", 2, "only")]
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    for method in ("shuffle", "hash"):
        got = sorted(map(tuple, clean.dedupe(df, ["k"], "seq", method).collect()), key=repr)
        assert got == sorted([(None, 1, "early"), ("k", 2, "only")], key=repr)
        assert clean.dedupe(df, ["k"], method=method).count() == 2


def test_impute_approx_and_literal_policy(spark):
    df = spark.createDataFrame([(1.0, None, "x"), (None, 2, None), (3.0, None, "y")],
                               "a double, b int, s string")
    out = clean.impute(df, approx=True, policy={"b": -1, "s": "n/a"}).collect()
    assert out[1].a in (1.0, 3.0)  # approximate median is one of the observed values
    assert [r.b for r in out] == [-1, 2, -1] and out[1].s == "n/a"


def test_type_report(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "a int, b double, c string")
    assert profile.type_report(df) == [("a", "int"), ("b", "double"), ("c", "string")]


def test_clean_fact_rejects_empty_input(spark):
    import pytest
    df = spark.createDataFrame([], "DEPARTURE_DELAY double, ARRIVAL_DELAY double, "
                                   "CANCELLED int, DIVERTED int")
    with pytest.raises(ValueError):
        clean.clean_fact(df)
