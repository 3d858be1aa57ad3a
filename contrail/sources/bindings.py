"""Flight-shaped view over the driver's TPC-H-like tables.

Roles: airline = supplier, airport = nation (supplier side = origin, customer
side = destination), flight date = order date, flight = lineitem. Nulls and
flags are derived deterministically from the measures so that the cleaning and
quality operators have something to find. The same derivation is the first
CTE of every DuckDB oracle (``contrail.plans.oracle.FLIGHTS_CTE``).

Join order is chosen for scale: orders x customer first (the small side of the
lineitem join), then lineitem on the order key with a sort-merge hint (the
fact must never be the broadcast side; below the broadcast threshold Spark
would otherwise broadcast a whole lineitem file), then supplier; nation is
the fixed 25-row TPC-H table. No broadcast hints: Spark/AQE pick broadcast
only when the measured size is under the threshold, otherwise sort-merge with
skew splitting.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators import model
from contrail.session import app_id, scratch_path
from contrail.spec import Star, Tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights with natural codes (AIRLINE, ORIGIN_AIRPORT, ...)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    oc = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey", "o_orderdate", "c_nationkey")
    # the fact side is never broadcast: sort-merge on the order key (spills,
    # AQE splits skewed keys); the smaller dimension joins stay Spark's choice
    base = (li.hint("merge").join(oc, li.l_orderkey == oc.o_orderkey)
            .join(supp, li.l_suppkey == supp.s_suppkey))
    org = nation.select(F.col("n_nationkey").alias("_ok"), F.col("n_name").alias("ORIGIN_AIRPORT"))
    dst = nation.select(F.col("n_nationkey").alias("_dk"),
                        F.col("n_name").alias("DESTINATION_AIRPORT"))
    base = (base.join(org, base.s_nationkey == org._ok)
            .join(dst, base.c_nationkey == dst._dk))

    q = F.col("l_quantity")
    canc = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R") & (q > 40)
    div = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A") & (q > 45)
    dep0 = q.cast("int") * 4 - 66
    arr0 = F.floor("l_extendedprice").cast("bigint") % 240 - 62
    flown = ~canc & ~div
    late = flown & (arr0 > 15)
    d = F.col("o_orderdate").cast("date")

    def cause(v):
        return F.when(late, v).cast("double")

    return base.select(
        F.year(d).alias("YEAR"),
        F.month(d).alias("MONTH"),
        F.dayofmonth(d).alias("DAY"),
        (F.weekday(d) + 1).alias("DAY_OF_WEEK"),
        F.col("l_suppkey").cast("string").alias("AIRLINE"),
        F.col("l_partkey").cast("string").alias("FLIGHT_NUMBER"),
        F.concat(F.lit("N"), F.col("l_partkey").cast("string")).alias("TAIL_NUMBER"),
        "ORIGIN_AIRPORT",
        "DESTINATION_AIRPORT",
        F.when(~canc, dep0).cast("double").alias("DEPARTURE_DELAY"),
        F.floor(F.col("l_extendedprice") / 100).cast("double").alias("DISTANCE"),
        F.when(flown, arr0).cast("double").alias("ARRIVAL_DELAY"),
        div.cast("int").alias("DIVERTED"),
        canc.cast("int").alias("CANCELLED"),
        F.when(canc, F.lit("B")).alias("CANCELLATION_REASON"),
        cause(F.col("l_partkey") % 11).alias("AIR_SYSTEM_DELAY"),
        cause(q.cast("int") % 7).alias("SECURITY_DELAY"),
        cause(F.col("l_linenumber")).alias("AIRLINE_DELAY"),
        cause(F.round(F.col("l_tax") * 100).cast("int")).alias("LATE_AIRCRAFT_DELAY"),
        cause(F.round(F.col("l_discount") * 100).cast("int")).alias("WEATHER_DELAY"),
        F.concat(F.lit("AC"), F.col("l_partkey").cast("string")).alias("AIRCRAFT_ID"),
        F.concat(F.lit("MODEL-"), (F.col("l_partkey") % 13).cast("string")).alias("MODEL"),
    )


def airlines_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference file of carriers: IATA_CODE, AIRLINE."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("IATA_CODE"), F.col("s_name").alias("AIRLINE"))


def airports_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference file of airports: IATA_CODE, AIRPORT, CITY, STATE, COUNTRY, LAT, LON."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_name").alias("IATA_CODE"),
        F.col("n_name").alias("AIRPORT"),
        F.col("n_name").alias("CITY"),
        F.col("r_name").alias("STATE"),
        F.col("r_name").alias("COUNTRY"),
        F.col("n_nationkey").cast("double").alias("LATITUDE"),
        F.col("n_regionkey").cast("double").alias("LONGITUDE"),
    )


_STAR_CACHE: dict = {}
_PATHS: dict = {}
_LOCK = threading.Lock()


def star(spark: SparkSession, sf_dir: str) -> Star:
    """Star schema of ``sf_dir``, built once per session and written to the
    shared work folder (lineage cut; survives executor loss)."""
    key = (app_id(spark), sf_dir.rstrip("/"))
    with _LOCK:
        if key in _STAR_CACHE:
            return _STAR_CACHE[key]
        path = scratch_path(spark, "star")
        build_and_write_star(spark, sf_dir, path)
        s = model.read_star(spark, path)
        _STAR_CACHE[key] = s
        _PATHS[key] = path
        return s


def star_path(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the written star (and flight table) of ``sf_dir``."""
    star(spark, sf_dir)
    return _PATHS[(app_id(spark), sf_dir.rstrip("/"))]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flight-shaped table as written by the star build (A4/A5 round trip)."""
    return spark.read.parquet(f"{star_path(spark, sf_dir)}/flights")


def normalized(spark: SparkSession, sf_dir: str) -> Tables:
    """Normalized layer (C10) of ``sf_dir``: written members with ids and the
    keyed fact (the warehouse fact with the id names of the normalized DDL)."""
    return model.normalized(spark, star_path(spark, sf_dir), star(spark, sf_dir))


def build_and_write_star(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The reference's batch flow on Spark: flights written once (the 4-way
    join runs once, A4), members extracted and counted (their counts bound
    every later broadcast), surrogate keys, key mapping (C9), star (C11-C14)."""
    flights(spark, sf_dir).write.mode("overwrite").parquet(f"{path}/flights")
    raw = spark.read.parquet(f"{path}/flights")
    model.load_star(spark, raw, path, airlines_ref(spark, sf_dir), airports_ref(spark, sf_dir), "first")


def text_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights as a text feed would carry them: every delay column is a
    string; a cancelled flight's departure delay reads 'N/A' and a diverted
    flight's arrival delay reads 'nan' (inputs for C3/C4/B6 type checks)."""
    f = raw(spark, sf_dir)
    delays = ["DEPARTURE_DELAY", "ARRIVAL_DELAY", "AIR_SYSTEM_DELAY", "SECURITY_DELAY",
              "AIRLINE_DELAY", "LATE_AIRCRAFT_DELAY", "WEATHER_DELAY"]
    cols = {c: F.col(c).cast("string") for c in delays}
    cols["DEPARTURE_DELAY"] = F.when(F.col("CANCELLED") == 1, F.lit("N/A")).otherwise(
        F.col("DEPARTURE_DELAY").cast("string"))
    cols["ARRIVAL_DELAY"] = F.when(F.col("DIVERTED") == 1, F.lit("nan")).otherwise(
        F.col("ARRIVAL_DELAY").cast("string"))
    return f.withColumns(cols)


def run_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Run history and phase log derived from ``events``: one run
    per calendar day, one phase per event type; a phase FAILS when one of its
    events has value >= 400 and WARNS from 300; duration = sum of values."""
    from contrail.sources.runlog import phase_order

    ev = table(spark, sf_dir, "events").select("ts", "event_type", "value")
    fmt = "yyyy-MM-dd'T'HH:mm:ss"
    day = F.date_format("ts", "yyyyMMdd")
    ph = ev.groupBy(F.concat(F.lit("run-"), day).alias("run_id"),
                    F.col("event_type").alias("phase_name")).agg(
        F.date_format(F.min("ts"), fmt).alias("start_time"),
        F.date_format(F.max("ts"), fmt).alias("end_time"),
        F.round(F.sum("value"), 4).alias("duration_seconds"),
        F.max("value").alias("_mx"), F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("event_type") != "error").alias("_ok"))
    ph = ph.withColumn("status", F.when(F.col("_mx") >= 400, "FAILED")
                       .when(F.col("_mx") >= 300, "WARNING").otherwise("SUCCESS"))
    runs = ph.groupBy("run_id").agg(
        F.min("start_time").alias("run_timestamp"),
        F.when(F.count_if(F.col("status") == "FAILED") > 0, "FAILED")
        .when(F.count_if(F.col("status") == "WARNING") > 0, "WARNING").otherwise("SUCCESS")
        .alias("overall_status"),
        F.round(F.sum("duration_seconds"), 4).alias("total_duration"),
        (F.sum("_ok") * 100.0 / F.sum("_n")).alias("dq_score"),
        F.sum("_n").alias("records_loaded"))
    phases = phase_order(ph.drop("_mx", "_n", "_ok"))
    return runs, phases


_LOG_PATHS: dict = {}


def run_log_path(spark: SparkSession, sf_dir: str) -> str:
    """The run log of ``sf_dir`` appended once per session to the work folder."""
    from contrail.sources.runlog import append_run

    key = (app_id(spark), sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _LOG_PATHS:
            path = scratch_path(spark, "runlog")
            append_run(*run_log(spark, sf_dir), path)
            _LOG_PATHS[key] = path
        return _LOG_PATHS[key]
