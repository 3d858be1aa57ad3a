"""Schema contract (B8-B10), after the reference's schema-fix script."""

import pytest
from pyspark.sql import types as T

from contrail.operators import contract
from contrail.spec import NORMALIZED_FLIGHTS_SCHEMA


def test_schema_diff_valid_with_excluded_natural_keys(spark):
    cols = ["YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "AIRLINE", "FLIGHT_NUMBER", "ORIGIN_AIRPORT",
            "DESTINATION_AIRPORT", "DEPARTURE_DELAY", "ARRIVAL_DELAY", "DISTANCE", "CANCELLED",
            "DIVERTED", "TAIL_NUMBER"]
    df = spark.createDataFrame([tuple([None] * len(cols))],
                               T.StructType([T.StructField(c, T.StringType()) for c in cols]))
    r = contract.schema_diff(df, NORMALIZED_FLIGHTS_SCHEMA,
                             exclude=("AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT")).first()
    assert r.is_valid and r.missing_from_table == []
    assert "FLIGHT_ID" not in r.extra_in_table and "AIRLINE_ID" in r.extra_in_table


def test_select_compatible_drops_extras(spark):
    cols = ["YEAR", "MONTH", "DAY", "FLIGHT_NUMBER", "DEPARTURE_DELAY", "ARRIVAL_DELAY",
            "CANCELLED", "DIVERTED", "EXTRA_COLUMN_1", "EXTRA_COLUMN_2"]
    df = spark.createDataFrame([tuple(range(len(cols)))], ", ".join(f"{c} int" for c in cols))
    out = contract.select_compatible(df, NORMALIZED_FLIGHTS_SCHEMA)
    assert "EXTRA_COLUMN_1" not in out.columns and "FLIGHT_NUMBER" in out.columns
    assert out.columns == [c for c in cols if not c.startswith("EXTRA")]


def test_select_compatible_none_raises(spark):
    df = spark.createDataFrame([(1,)], "nothing int")
    with pytest.raises(ValueError):
        contract.select_compatible(df, NORMALIZED_FLIGHTS_SCHEMA)


def test_table_schema(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    assert contract.table_schema(df) == {"a": "int", "b": "string"}
