"""KPI batch over the star schema (F11-F18) and series windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.ranking import rank_rows
from contrail.functions.scalar import is_flag, one_row, pct, rnd, route_label
from contrail.plans.aggregates import sums
from contrail.plans.common import (ARR, CANC, CAUSES, DEP, DIVR, by_key_then_attr, dim, merge_partials, mean)
from contrail.spec import ROUTE_ARROW_BATCH, Star


# --------------------------------------------------------------------------- F11, G1
def _carriers(star: Star) -> DataFrame:
    """(airline_name, total_flights, cancelled_flights, _div, _cf, _avg) by airline name: counts, the
    cancel fraction and the average arrival delay, both unrounded."""
    g = by_key_then_attr(star, "airline_key", "dim_airline", "airline_key",
                         ["airline_name"], value_cols=(ARR,))
    return g.select(
        "airline_name",
        F.col("_n").alias("total_flights"),
        F.col(f"_f_{CANC}").alias("cancelled_flights"),
        F.col(f"_f_{DIVR}").alias("_div"),
        (F.col(f"_f_{CANC}") / F.col("_n")).alias("_cf"),
        mean(ARR).alias("_avg"),
    )


def carrier_reliability(star: Star, digits: int | None = 2) -> DataFrame:
    """Airline reliability: RANK by (cancel fraction asc, avg arrival delay asc).

    Grouped by airline name; the rank uses the unrounded fraction and average.
    """
    g = _carriers(star)
    g = rank_rows(g, [("_cf", True), ("_avg", True)], "rank", "reliability_rank", bound=star.rows.get("dim_airline"))
    return g.select(
        "airline_name", "total_flights", "cancelled_flights",
        pct("cancelled_flights", "total_flights", digits).alias("cancellation_rate"),
        pct("_div", "total_flights", digits).alias("diversion_rate"),
        rnd("_avg", digits).alias("avg_delay_mins"),
        "reliability_rank",
    ).orderBy("reliability_rank", F.col("airline_name").asc_nulls_first())


# --------------------------------------------------------------------------- F12, G2
def _airports(star: Star, min_departures: int, delayed_gt: float = 15) -> DataFrame:
    """(airport_code, airport_name, total_departures, _avg, delayed_departures) of the origin airports
    with more than ``min_departures`` departures; the average departure delay is unrounded."""
    per_key = sums(star.fact, star.agg, ["origin_airport_key"], (DEP,), (), late_gt=delayed_gt).withColumnRenamed("origin_airport_key", "_k")
    d = dim(star, "dim_airport", F.col("airport_key").alias("_k"), "airport_code", "airport_name")
    g = (per_key.join(d, "_k").groupBy("airport_code", "airport_name")
         .agg(*merge_partials((DEP,), ()), F.sum("_late").alias("_late"))
         .where(F.col("_n") > min_departures))
    return g.select("airport_code", "airport_name", F.col("_n").alias("total_departures"),
                    mean(DEP).alias("_avg"), F.col("_late").alias("delayed_departures"))


def airport_efficiency(star: Star, min_departures: int = 50, delayed_gt: float = 15,
                       digits: int | None = 2) -> DataFrame:
    """Origin airports with more than ``min_departures`` departures, DENSE_RANK
    by average departure delay (rank taken after the volume filter)."""
    g = rank_rows(_airports(star, min_departures, delayed_gt), [("_avg", True)], "dense_rank", "efficiency_rank",
                  bound=star.rows.get("dim_airport"))
    return g.select(
        "airport_code", "airport_name", "total_departures",
        rnd("_avg", digits).alias("avg_dep_delay"),
        "delayed_departures",
        pct("delayed_departures", "total_departures", digits).alias("delay_rate"),
        "efficiency_rank",
    ).orderBy("efficiency_rank", F.col("airport_code").asc_nulls_first())


# --------------------------------------------------------------------------- F13, F29, E2
def route_stats(star: Star, min_flights: int = 21, with_distance: bool = False) -> DataFrame:
    """Per (origin code, destination code): flights, cancellations, sums.

    Aggregates on the two keys first, then joins the airport dimension twice
    (role-playing, E2) to the aggregate, then regroups by the two codes.
    """
    vals = (ARR, "DISTANCE") if with_distance else (ARR,)
    per = sums(star.fact, star.agg, ["origin_airport_key", "dest_airport_key"], vals, (CANC,)).withColumnsRenamed(
        {"origin_airport_key": "_o", "dest_airport_key": "_d"})
    o = dim(star, "dim_airport", F.col("airport_key").alias("_o"), F.col("airport_code").alias("origin"))
    d = dim(star, "dim_airport", F.col("airport_key").alias("_d"),
            F.col("airport_code").alias("destination"))
    return (per.join(o, "_o").join(d, "_d").groupBy("origin", "destination")
            .agg(*merge_partials(vals, (CANC,))).where(F.col("_n") >= min_flights))


def route_intelligence(star: Star, min_flights: int = 21, digits: int | None = 2,
                       arrow: str = ROUTE_ARROW_BATCH) -> DataFrame:
    """Batch route KPI (F13): routes with at least ``min_flights`` flights
    (the reference's ``> 20``), busiest first."""
    r = route_stats(star, min_flights)
    return r.select(
        "origin", "destination", route_label("origin", "destination", arrow).alias("route"),
        F.col("_n").alias("flights"),
        rnd(mean(ARR), digits).alias("avg_arr_delay"),
        pct(f"_f_{CANC}", "_n", digits).alias("cancellation_rate"),
    ).orderBy(F.desc("flights"), F.col("origin").asc_nulls_first(),
              F.col("destination").asc_nulls_first())


# --------------------------------------------------------------------------- F14, G3
def monthly_trend(star: Star, by_year: bool = False, digits: int | None = 2) -> DataFrame:
    """Monthly volume, delay, cancel rate and running total of flights.

    ``by_year=False`` merges years like the reference (S21). The running total
    is a window over at most 12 (x years) rows: bounded by the calendar.
    """
    per_day = sums(star.fact, star.agg, ["date_key"], (DEP,), (CANC,))
    keys = (["year"] if by_year else []) + ["month_name", "month"]
    d = dim(star, "dim_date", "date_key", *keys)
    g = per_day.join(d, "date_key").groupBy(*keys).agg(*merge_partials((DEP,), (CANC,)))
    order = (["year"] if by_year else []) + ["month"]
    w = Window.orderBy(*order)  # default RANGE frame, as in SQL
    return g.select(
        *keys,
        F.col("_n").alias("total_flights"),
        rnd(mean(DEP), digits).alias("avg_delay"),
        pct(f"_f_{CANC}", "_n", digits).alias("cancellation_rate"),
        F.sum("_n").over(w).alias("running_total_flights"),
    ).orderBy(*order)


# --------------------------------------------------------------------------- F15
def delay_risk(star: Star, arr_gt: float = 0, digits: int | None = 2) -> DataFrame:
    """Cause averages by airline name over flights with arrival delay > ``arr_gt``."""
    cols = dict(CAUSES)
    picks = [("weather_risk", cols["Weather"]), ("security_risk", cols["Security"]),
             ("late_aircraft_risk", cols["Late Aircraft"]), ("nas_risk", cols["NAS"])]
    vals = tuple(c for _, c in picks)
    g = by_key_then_attr(star, "airline_key", "dim_airline", "airline_key", ["airline_name"], value_cols=vals, flags=(), arr_gt=arr_gt)
    return g.select("airline_name", *[rnd(mean(c), digits).alias(n) for n, c in picks])


# --------------------------------------------------------------------------- F16, F17, H6
def _places(star: Star, min_departures: int, min_route_flights: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The aggregates behind the rankings, with ``_place``: the columns that they order by, then the names.
    First and last place are found by ``min_by``/``max_by`` (partial aggregates): no rank is needed."""
    a = _carriers(star).withColumn("_place", F.struct("_cf", "_avg", "airline_name"))
    p = _airports(star, min_departures).withColumn("_place", F.struct("_avg", "airport_code"))
    r = route_intelligence(star, min_route_flights, digits=None).withColumn(
        "_place", F.struct("cancellation_rate", -F.col("flights"), "route"))
    return a, p, r


def scorecard(star: Star, min_departures: int = 50, min_route_flights: int = 21) -> DataFrame:
    """Best / worst airline (reliability), airport (efficiency) and route
    (cancellation %, then flights desc, then route)."""
    a, p, r = _places(star, min_departures, min_route_flights)
    out = None
    for subject, df, name in (("airline", a, "airline_name"), ("airport", p, "airport_name"), ("route", r, "route")):
        x = df.agg(F.min_by(name, "_place").alias("best"), F.max_by(name, "_place").alias("worst")).select(F.lit(subject).alias("subject"), "best", "worst")
        out = x if out is None else out.unionByName(x)
    return out


def insights(star: Star, min_departures: int = 50, min_route_flights: int = 21) -> DataFrame:
    """Busiest airline, busiest airport (among F12's), #1 airline, riskiest route."""
    a, p, r = _places(star, min_departures, min_route_flights)
    airlines = a.agg(F.min_by("airline_name", F.struct(-F.col("total_flights"), "airline_name")).alias("busiest_airline"),
                     F.min_by("airline_name", "_place").alias("top_reliability_airline"))  # one pass for both
    airports = p.agg(F.min_by("airport_name", F.struct(-F.col("total_departures"), "airport_code")).alias("busiest_airport"))
    routes = r.agg(F.max_by("route", "_place").alias("riskiest_route"))
    names = ["busiest_airline", "busiest_airport", "top_reliability_airline", "riskiest_route"]
    return one_row(airlines, airports, routes).unpivot([], names, "insight", "value")


# --------------------------------------------------------------------------- F18, D7
def geo_density(star: Star) -> DataFrame:
    """Departures per origin airport that has coordinates."""
    per = sums(star.fact, star.agg, ["origin_airport_key"], (), ()).withColumnRenamed("origin_airport_key", "_k")
    attrs = ["airport_code", "airport_name", "city", "state", "latitude", "longitude"]
    d = dim(star, "dim_airport", F.col("airport_key").alias("_k"), *attrs).where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return per.join(d, "_k").groupBy(*attrs).agg(F.sum("_n").alias("departures"))


# --------------------------------------------------------------------------- G5, G6
def moving_average(series: DataFrame, value: str, order: str, k: int = 7,
                   out: str | None = None) -> DataFrame:
    """Trailing k-row average over a period-aggregated series (rows = periods,
    bounded by the calendar, so one ordered window is fine)."""
    w = Window.orderBy(order).rowsBetween(-(k - 1), 0)
    return series.withColumn(out or f"{value}_ma{k}", F.avg(value).over(w))


def period_change(series: DataFrame, value: str, order, lag: int = 1) -> DataFrame:
    """Period-over-period change: previous value, difference, percent change."""
    order = [order] if isinstance(order, str) else list(order)
    w = Window.orderBy(*order)
    prev = F.lag(value, lag).over(w)
    return (series.withColumn(f"prev_{value}", prev)
            .withColumn(f"{value}_change", F.col(value) - F.col(f"prev_{value}"))
            .withColumn(f"{value}_change_pct",
                        pct(F.col(value) - F.col(f"prev_{value}"), f"prev_{value}", None)))


def fill_calendar(series: DataFrame, period: str, unit: str = "day", by=(), fill: dict | None = None) -> DataFrame:
    """``series`` (a row for each ``by`` and ``period``, a date) with a row for every period from the first to the
    last of its group: a calendar is generated and the series joined to it. Missing values are filled from
    ``fill`` (column -> value), others stay NULL. ``unit``: day, week, month, quarter or year; periods of the
    series are its first days."""
    if unit not in ("day", "week", "month", "quarter", "year"):
        raise ValueError(f"unknown unit {unit!r}")
    by = [by] if isinstance(by, str) else list(by)
    step = {"quarter": "INTERVAL 3 MONTHS"}.get(unit, f"INTERVAL 1 {unit.upper()}")
    edges = series.where(F.col(period).isNotNull()).groupBy(*by).agg(F.min(period).alias("_first"), F.max(period).alias("_last"))
    # a global aggregate of an empty series is one row of NULLs: no periods
    spine = edges.where(F.col("_first").isNotNull()).select(*by, F.explode(F.expr(f"sequence(_first, _last, {step})")).alias(period))
    s = series.withColumnsRenamed({c: f"_s_{c}" for c in [*by, period]})
    on = [spine[c].eqNullSafe(s[f"_s_{c}"]) for c in by] + [spine[period] == s[f"_s_{period}"]]
    out = spine.join(s, on, "left").select(*series.columns)
    return out.fillna(fill) if fill else out


def moving_average_by_date(series: DataFrame, value: str, period: str, days: int = 7, by=(), out: str | None = None) -> DataFrame:
    """Trailing average over the last ``days`` calendar days (a window by date range, not by rows): a missing
    day is no row of the window, and counts where ``fill_calendar`` has filled it. Windows are by group; a
    series without groups is bounded by the calendar."""
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(F.unix_date(period)).rangeBetween(-(days - 1), 0)
    return series.withColumn(out or f"{value}_ma{days}", F.avg(value).over(w))


def calendar_change(series: DataFrame, value: str, period: str, unit: str = "month", lag: int = 1, by=()) -> DataFrame:
    """Change against the period ``lag`` units before, found by its date (a self-join): where that period is
    missing the change is NULL, instead of being taken against some other period."""
    months = {"month": 1, "quarter": 3, "year": 12}.get(unit)
    days = {"day": 1, "week": 7}.get(unit)
    if months is None and days is None:
        raise ValueError(f"unknown unit {unit!r}")
    by = [by] if isinstance(by, str) else list(by)
    moved = F.add_months(period, months * lag) if months else F.date_add(period, days * lag)
    before = series.select(*[F.col(c).alias(f"_s_{c}") for c in by], moved.alias("_s_period"), F.col(value).alias(f"prev_{value}"))
    on = [series[c].eqNullSafe(before[f"_s_{c}"]) for c in by] + [series[period] == before["_s_period"]]
    out = series.join(before, on, "left").drop("_s_period", *[f"_s_{c}" for c in by])
    change = F.col(value) - F.col(f"prev_{value}")
    return out.withColumn(f"{value}_change", change).withColumn(f"{value}_change_pct", pct(change, f"prev_{value}", None))


def station_days(star: Star) -> DataFrame:
    """Departures by origin airport and date (the series behind the calendar windows)."""
    per = star.fact.groupBy("origin_airport_key", "date_key").agg(F.count(F.lit(1)).alias("flights"))
    a = dim(star, "dim_airport", F.col("airport_key").alias("origin_airport_key"), F.col("airport_code").alias("origin"))
    return (per.join(a, "origin_airport_key").join(dim(star, "dim_date", "date_key", "full_date"), "date_key")
            .groupBy("origin", "full_date").agg(F.sum("flights").alias("flights")))


def cancelled_months(star: Star) -> DataFrame:
    """Cancelled flights by airline and month; a month without any has no row."""
    per = star.fact.where(is_flag(CANC)).groupBy("airline_key", "date_key").agg(F.count(F.lit(1)).alias("cancelled"))
    a = dim(star, "dim_airline", "airline_key", "airline_code")
    d = dim(star, "dim_date", "date_key", F.trunc("full_date", "month").alias("month"))
    return per.join(a, "airline_key").join(d, "date_key").groupBy("airline_code", "month").agg(F.sum("cancelled").alias("cancelled"))


def daily_volume(star: Star) -> DataFrame:
    """Flights per calendar date (the series behind G5)."""
    per = sums(star.fact, star.agg, ["date_key"], (), ()).withColumnRenamed("_n", "flights")
    return per.join(dim(star, "dim_date", "date_key", "full_date"), "date_key").select(
        "full_date", "flights")


def monthly_volume(star: Star) -> DataFrame:
    """Flights per (year, month) (the series behind G6)."""
    per = sums(star.fact, star.agg, ["date_key"], (), ())
    return (per.join(dim(star, "dim_date", "date_key", "year", "month"), "date_key")
            .groupBy("year", "month").agg(F.sum("_n").alias("flights")))

