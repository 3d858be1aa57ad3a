"""Registry of catalogue queries over the driver tables, each with its oracle.

Every query takes ``(spark, sf_dir)`` and reads the whole driver tables (via
the binding and the star built from them). ``digits=6`` instead of the
reference's 1-2 decimals: DuckDB and Spark round unrepresentable ties
differently (SURVEY 7.4); the operators keep the reference's digits as default.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.functions.quantiles import quantiles
from contrail.plans import kpi, metrics, sketches
from contrail.plans.oracle import with_flights
from contrail.sources import bindings
from contrail.sources.warehouse import Warehouse

D = 6  # rounding digits used in the registered queries (oracle parity)

QUERIES: dict = {}
ORACLES: dict = {}


def _bigint_count_if(sql: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT; Spark's ``count_if`` is BIGINT."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = _bigint_count_if(sql[j + len(key):k - 1])
        out.append(sql[i:j] + "CAST(count_if(" + inner + ") AS BIGINT)")
        i = k


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = _bigint_count_if(oracle)
        return fn
    return deco


def star(spark, sf_dir):
    return bindings.star(spark, sf_dir)


# =========================================================================== KPI batch
@register("q_f11_airline_reliability", with_flights(f"""
s AS (SELECT airline_name, count(*) AS total_flights,
        count_if(CANCELLED = 1) AS cancelled_flights, count_if(DIVERTED = 1) AS dv,
        avg(ARRIVAL_DELAY) AS avg_delay
      FROM fl GROUP BY airline_name)
SELECT airline_name, total_flights, cancelled_flights,
  round(CAST(cancelled_flights AS DOUBLE) / total_flights * 100, {D}) AS cancellation_rate,
  round(CAST(dv AS DOUBLE) / total_flights * 100, {D}) AS diversion_rate,
  round(avg_delay, {D}) AS avg_delay_mins,
  CAST(rank() OVER (ORDER BY CAST(cancelled_flights AS DOUBLE) / total_flights ASC NULLS FIRST,
                    avg_delay ASC NULLS FIRST) AS BIGINT) AS reliability_rank
FROM s"""))
def q_f11(spark, sf_dir):
    return kpi.carrier_reliability(star(spark, sf_dir), digits=D)


def raw(spark, sf_dir):
    return bindings.raw(spark, sf_dir)


def tables(spark, sf_dir):
    return bindings.normalized(spark, sf_dir)


_PCT = "round(CAST({n} AS DOUBLE) / {d} * 100, " + str(D) + ")"
_PCT0 = "round(coalesce(CAST({n} AS DOUBLE) * 100.0 / {d}, 0.0), " + str(D) + ")"


def P(n, d):
    return _PCT.format(n=n, d=d)


def P0(n, d):
    return _PCT0.format(n=n, d=d)


def R(x):
    return f"round({x}, {D})"


# =========================================================================== KPI batch (cont.)
@register("q_f12_airport_efficiency", with_flights(f"""
g AS (SELECT ORIGIN_AIRPORT AS airport_code, ORIGIN_AIRPORT AS airport_name,
        count(*) AS total_departures, avg(DEPARTURE_DELAY) AS av,
        count_if(DEPARTURE_DELAY > 15) AS delayed_departures
      FROM fl GROUP BY ORIGIN_AIRPORT HAVING count(*) > 50)
SELECT airport_code, airport_name, total_departures, {R('av')} AS avg_dep_delay,
  delayed_departures, {P('delayed_departures', 'total_departures')} AS delay_rate,
  CAST(dense_rank() OVER (ORDER BY av ASC NULLS FIRST) AS BIGINT) AS efficiency_rank
FROM g"""))
def q_f12(spark, sf_dir):
    return kpi.airport_efficiency(star(spark, sf_dir), digits=D)


@register("q_f13_route_intelligence", with_flights(f"""
SELECT ORIGIN_AIRPORT AS origin, DESTINATION_AIRPORT AS destination,
  ORIGIN_AIRPORT || ' → ' || DESTINATION_AIRPORT AS route, count(*) AS flights,
  {R('avg(ARRIVAL_DELAY)')} AS avg_arr_delay,
  {P('count_if(CANCELLED = 1)', 'count(*)')} AS cancellation_rate
FROM fl GROUP BY ORIGIN_AIRPORT, DESTINATION_AIRPORT HAVING count(*) > 20"""))
def q_f13(spark, sf_dir):
    return kpi.route_intelligence(star(spark, sf_dir), min_flights=21, digits=D)


@register("q_f14_monthly_trend", with_flights(f"""
SELECT d.month_name, d.month, count(*) AS total_flights,
  {R('avg(DEPARTURE_DELAY)')} AS avg_delay,
  {P('count_if(CANCELLED = 1)', 'count(*)')} AS cancellation_rate,
  CAST(sum(count(*)) OVER (ORDER BY d.month) AS BIGINT) AS running_total_flights
FROM fl JOIN dd d USING (date_key) GROUP BY d.month_name, d.month"""))
def q_f14(spark, sf_dir):
    return kpi.monthly_trend(star(spark, sf_dir), digits=D)


@register("q_f15_delay_risk", with_flights(f"""
SELECT airline_name, {R('avg(WEATHER_DELAY)')} AS weather_risk,
  {R('avg(SECURITY_DELAY)')} AS security_risk,
  {R('avg(LATE_AIRCRAFT_DELAY)')} AS late_aircraft_risk, {R('avg(AIR_SYSTEM_DELAY)')} AS nas_risk
FROM fl WHERE ARRIVAL_DELAY > 0 GROUP BY airline_name"""))
def q_f15(spark, sf_dir):
    return kpi.delay_risk(star(spark, sf_dir), digits=D)


_F11_RAW = """
a AS (SELECT airline_name, count(*) AS total_flights,
        CAST(count_if(CANCELLED = 1) AS DOUBLE) / count(*) AS cf, avg(ARRIVAL_DELAY) AS av
      FROM fl GROUP BY airline_name),
ar AS (SELECT *, rank() OVER (ORDER BY cf ASC NULLS FIRST, av ASC NULLS FIRST) AS rk FROM a),
p AS (SELECT ORIGIN_AIRPORT AS airport_code, ORIGIN_AIRPORT AS airport_name,
        count(*) AS total_departures, avg(DEPARTURE_DELAY) AS av
      FROM fl GROUP BY ORIGIN_AIRPORT HAVING count(*) > 50),
pr AS (SELECT *, dense_rank() OVER (ORDER BY av ASC NULLS FIRST) AS rk FROM p),
r AS (SELECT ORIGIN_AIRPORT || ' → ' || DESTINATION_AIRPORT AS route, count(*) AS flights,
        CAST(count_if(CANCELLED = 1) AS DOUBLE) / count(*) * 100 AS rate
      FROM fl GROUP BY ORIGIN_AIRPORT, DESTINATION_AIRPORT HAVING count(*) > 20)"""


@register("q_f16_scorecard", with_flights(_F11_RAW + """
SELECT 'airline' AS subject,
  (SELECT airline_name FROM ar ORDER BY rk, airline_name LIMIT 1) AS best,
  (SELECT airline_name FROM ar ORDER BY rk DESC, airline_name DESC LIMIT 1) AS worst
UNION ALL SELECT 'airport',
  (SELECT airport_name FROM pr ORDER BY rk, airport_code LIMIT 1),
  (SELECT airport_name FROM pr ORDER BY rk DESC, airport_code DESC LIMIT 1)
UNION ALL SELECT 'route',
  (SELECT route FROM r ORDER BY rate, flights DESC, route LIMIT 1),
  (SELECT route FROM r ORDER BY rate DESC, flights, route DESC LIMIT 1)"""))
def q_f16(spark, sf_dir):
    return kpi.scorecard(star(spark, sf_dir))


@register("q_f17_insights", with_flights(_F11_RAW + """
SELECT 'busiest_airline' AS insight,
  (SELECT airline_name FROM ar ORDER BY total_flights DESC, airline_name LIMIT 1) AS value
UNION ALL SELECT 'busiest_airport',
  (SELECT airport_name FROM pr ORDER BY total_departures DESC, airport_code LIMIT 1)
UNION ALL SELECT 'top_reliability_airline',
  (SELECT airline_name FROM ar ORDER BY rk, airline_name LIMIT 1)
UNION ALL SELECT 'riskiest_route',
  (SELECT route FROM r ORDER BY rate DESC, flights, route DESC LIMIT 1)"""))
def q_f17(spark, sf_dir):
    return kpi.insights(star(spark, sf_dir))


@register("q_f18_geo_density", with_flights("""
SELECT a.airport_code, a.airport_name, a.city, a.state, a.latitude, a.longitude,
  count(*) AS departures
FROM fl JOIN dim_apt a ON fl.ORIGIN_AIRPORT = a.airport_code
WHERE a.latitude IS NOT NULL AND a.longitude IS NOT NULL
GROUP BY a.airport_code, a.airport_name, a.city, a.state, a.latitude, a.longitude"""))
def q_f18(spark, sf_dir):
    return kpi.geo_density(star(spark, sf_dir))


@register("q_g05_moving_average", with_flights("""
v AS (SELECT full_date, count(*) AS flights FROM fl GROUP BY full_date)
SELECT full_date, flights,
  avg(flights) OVER (ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS flights_ma7
FROM v"""))
def q_g05(spark, sf_dir):
    return kpi.moving_average(kpi.daily_volume(star(spark, sf_dir)), "flights", "full_date", 7)


@register("q_g06_period_change", with_flights("""
v AS (SELECT d.year, d.month, count(*) AS flights FROM fl JOIN dd d USING (date_key)
      GROUP BY d.year, d.month),
l AS (SELECT *, lag(flights) OVER (ORDER BY year, month) AS prev_flights FROM v)
SELECT year, month, flights, prev_flights, flights - prev_flights AS flights_change,
  CAST(flights - prev_flights AS DOUBLE) / prev_flights * 100 AS flights_change_pct
FROM l"""))
def q_g06(spark, sf_dir):
    return kpi.period_change(kpi.monthly_volume(star(spark, sf_dir)), "flights",
                             ["year", "month"])


# =========================================================================== metrics: cleaned fact
@register("q_f01_business_metrics", with_flights(f"""
g AS (SELECT count(*) AS t, CAST(coalesce(sum(CANCELLED), 0) AS BIGINT) AS c,
        CAST(coalesce(sum(DIVERTED), 0) AS BIGINT) AS d, avg(DEPARTURE_DELAY) AS dep,
        avg(ARRIVAL_DELAY) AS arr, count_if(DEPARTURE_DELAY <= 0 AND ARRIVAL_DELAY <= 0) AS ot
      FROM fl)
SELECT t AS total_flights, c AS cancelled_flights,
  coalesce(CAST(c AS DOUBLE) / t * 100, 0.0) AS cancelled_percentage, d AS diverted_flights,
  coalesce(CAST(d AS DOUBLE) / t * 100, 0.0) AS diverted_percentage,
  {R('dep')} AS avg_departure_delay, {R('arr')} AS avg_arrival_delay, ot AS on_time_flights,
  coalesce(CAST(ot AS DOUBLE) / t * 100, 0.0) AS on_time_percentage FROM g"""))
def q_f01(spark, sf_dir):
    return metrics.business_metrics(raw(spark, sf_dir), digits=D)


@register("q_f05_paired_delay_avg", with_flights(f"""
SELECT {R('coalesce(avg(DEPARTURE_DELAY), 0.0)')} AS avg_departure_delay,
  {R('coalesce(avg(ARRIVAL_DELAY), 0.0)')} AS avg_arrival_delay
FROM fl WHERE DEPARTURE_DELAY IS NOT NULL AND ARRIVAL_DELAY IS NOT NULL"""))
def q_f05(spark, sf_dir):
    return metrics.paired_delay_avg(raw(spark, sf_dir), digits=D)


def _flag_sql(flag):
    return with_flights(f"""
SELECT '{flag}' AS flag, count(*) AS total, CAST(coalesce(sum({flag}), 0) AS BIGINT) AS flag_count,
  coalesce(CAST(coalesce(sum({flag}), 0) AS DOUBLE) / count(*) * 100, 0.0) AS rate FROM fl""")


@register("q_f06_cancellation_rate", _flag_sql("CANCELLED"))
def q_f06c(spark, sf_dir):
    return metrics.flag_rate(raw(spark, sf_dir), "CANCELLED")


@register("q_f06_diversion_rate", _flag_sql("DIVERTED"))
def q_f06d(spark, sf_dir):
    return metrics.flag_rate(raw(spark, sf_dir), "DIVERTED")


@register("q_f40_aircraft_utilization", with_flights("""
SELECT AIRCRAFT_ID, MODEL, count(*) AS flights FROM fl WHERE AIRCRAFT_ID IS NOT NULL
GROUP BY AIRCRAFT_ID, MODEL"""))
def q_f40(spark, sf_dir):
    return metrics.aircraft_utilization(raw(spark, sf_dir))


@register("q_f41_delayed_averages", with_flights("""
SELECT avg(DEPARTURE_DELAY) AS avg_dep_delay, avg(ARRIVAL_DELAY) AS avg_arr_delay,
  avg(AIR_SYSTEM_DELAY) AS air_system, avg(WEATHER_DELAY) AS weather
FROM fl WHERE DEPARTURE_DELAY > 0"""))
def q_f41(spark, sf_dir):
    return metrics.delayed_averages(raw(spark, sf_dir))


@register("q_f42_column_counts", with_flights("""
SELECT 'FLIGHT_NUMBER' AS column_name, count(FLIGHT_NUMBER) AS non_null_count,
  count(DISTINCT FLIGHT_NUMBER) AS distinct_count FROM fl
UNION ALL SELECT 'AIRCRAFT_ID', count(AIRCRAFT_ID), count(DISTINCT AIRCRAFT_ID) FROM fl
UNION ALL SELECT 'CANCELLATION_REASON', count(CANCELLATION_REASON),
  count(DISTINCT CANCELLATION_REASON) FROM fl"""))
def q_f42(spark, sf_dir):
    return metrics.column_counts(raw(spark, sf_dir),
                                 ["FLIGHT_NUMBER", "AIRCRAFT_ID", "CANCELLATION_REASON"])


@register("q_d01_find_flight", with_flights("""
SELECT * EXCLUDE (full_date, date_key, airline_name, origin_name, dest_name, origin_state,
                  origin_lat, origin_lon)
FROM fl WHERE FLIGHT_NUMBER = '17' AND "YEAR" = 1996"""))
def q_d01(spark, sf_dir):
    return metrics.find_flights(raw(spark, sf_dir), "17", 1996)


# =========================================================================== metrics: normalized
@register("q_f02_load_totals", with_flights("""
SELECT (SELECT count(*) FROM fl) AS total_flights, (SELECT count(*) FROM air) AS total_airlines,
  (SELECT count(*) FROM apt) AS total_airports"""))
def q_f02(spark, sf_dir):
    return metrics.load_totals(tables(spark, sf_dir))


@register("q_f03_top_airlines", with_flights("""
SELECT AIRLINE AS airline, count(*) AS flight_count FROM fl GROUP BY AIRLINE
ORDER BY flight_count DESC, airline LIMIT 10"""))
def q_f03(spark, sf_dir):
    return metrics.top_carriers_by_code(tables(spark, sf_dir))


@register("q_f04_top_origin_airports", with_flights("""
SELECT ORIGIN_AIRPORT AS airport, count(*) AS flight_count FROM fl GROUP BY ORIGIN_AIRPORT
ORDER BY flight_count DESC, airport LIMIT 10"""))
def q_f04o(spark, sf_dir):
    return metrics.top_airports_by_role(tables(spark, sf_dir), "origin")


@register("q_f04_top_destination_airports", with_flights("""
SELECT DESTINATION_AIRPORT AS airport, count(*) AS flight_count FROM fl
GROUP BY DESTINATION_AIRPORT ORDER BY flight_count DESC, airport LIMIT 10"""))
def q_f04d(spark, sf_dir):
    return metrics.top_airports_by_role(tables(spark, sf_dir), "destination")


@register("q_f07_executive_summary", with_flights(f"""
SELECT count(*) AS TOTAL_FLIGHTS, (SELECT count(*) FROM air) AS TOTAL_AIRLINES,
  (SELECT count(*) FROM apt) AS TOTAL_AIRPORTS,
  {P0('count_if(CANCELLED = 1)', 'count(*)')} AS CANCELLATION_RATE,
  {P0('count_if(DIVERTED = 1)', 'count(*)')} AS DIVERSION_RATE,
  {R('coalesce(avg(DEPARTURE_DELAY), 0.0)')} AS AVG_DEPARTURE_DELAY,
  {R('coalesce(avg(ARRIVAL_DELAY), 0.0)')} AS AVG_ARRIVAL_DELAY
FROM fl"""))
def q_f07(spark, sf_dir):
    return metrics.executive_summary(tables(spark, sf_dir), rate_digits=D, avg_digits=D)


_F08 = with_flights(f"""
SELECT AIRLINE AS AIRLINE_CODE, count(*) AS FLIGHT_COUNT,
  {R('coalesce(avg(DEPARTURE_DELAY), 0.0)')} AS AVG_DEPARTURE_DELAY,
  {R('coalesce(avg(ARRIVAL_DELAY), 0.0)')} AS AVG_ARRIVAL_DELAY,
  {P0('count_if(CANCELLED = 1)', 'count(*)')} AS CANCELLATION_RATE,
  {P0('count_if(DIVERTED = 1)', 'count(*)')} AS DIVERSION_RATE
FROM fl GROUP BY AIRLINE""")


@register("q_f08_airline_performance", _F08)
def q_f08(spark, sf_dir):
    return metrics.carrier_performance(tables(spark, sf_dir), rate_digits=D, avg_digits=D)


@register("q_f49_cancellation_ranking", _F08)
def q_f49(spark, sf_dir):
    return metrics.carrier_performance(tables(spark, sf_dir), order="cancellation",
                                       ascending=False, rate_digits=D, avg_digits=D)


@register("q_f44_ranked_slice", with_flights(f"""
p AS (
  SELECT AIRLINE AS AIRLINE_CODE, count(*) AS FLIGHT_COUNT,
  {R('coalesce(avg(DEPARTURE_DELAY), 0.0)')} AS AVG_DEPARTURE_DELAY,
  {R('coalesce(avg(ARRIVAL_DELAY), 0.0)')} AS AVG_ARRIVAL_DELAY,
  {P0('count_if(CANCELLED = 1)', 'count(*)')} AS CANCELLATION_RATE,
  {P0('count_if(DIVERTED = 1)', 'count(*)')} AS DIVERSION_RATE
  FROM fl GROUP BY AIRLINE)
SELECT *, CAST(row_number() OVER (ORDER BY FLIGHT_COUNT DESC, AIRLINE_CODE) AS BIGINT) AS "rank"
FROM p ORDER BY FLIGHT_COUNT DESC, AIRLINE_CODE LIMIT 10"""))
def q_f44(spark, sf_dir):
    perf = metrics.carrier_performance(tables(spark, sf_dir), rate_digits=D, avg_digits=D)
    return metrics.ranked_slice(perf, [("FLIGHT_COUNT", True), ("AIRLINE_CODE", False)], 10)


@register("q_f09_airport_traffic", with_flights("""
o AS (SELECT ORIGIN_AIRPORT AS code, count(*) AS n FROM fl GROUP BY 1),
d AS (SELECT DESTINATION_AIRPORT AS code, count(*) AS n FROM fl GROUP BY 1)
SELECT a.airport_code AS AIRPORT_CODE, coalesce(o.n, 0) AS ORIGIN_FLIGHTS,
  coalesce(d.n, 0) AS DESTINATION_FLIGHTS, coalesce(o.n, 0) + coalesce(d.n, 0) AS TOTAL_TRAFFIC
FROM apt a LEFT JOIN o ON a.airport_code = o.code LEFT JOIN d ON a.airport_code = d.code
WHERE o.n IS NOT NULL OR d.n IS NOT NULL"""))
def q_f09(spark, sf_dir):
    return metrics.airport_traffic(tables(spark, sf_dir))


@register("q_f10_delay_analysis", with_flights(f"""
SELECT AIRLINE AS AIRLINE_CODE,
  {R('coalesce(avg(WEATHER_DELAY), 0.0)')} AS AVG_WEATHER_DELAY,
  {R('coalesce(avg(AIRLINE_DELAY), 0.0)')} AS AVG_AIRLINE_DELAY,
  {R('coalesce(avg(SECURITY_DELAY), 0.0)')} AS AVG_SECURITY_DELAY,
  {R('coalesce(avg(AIR_SYSTEM_DELAY), 0.0)')} AS AVG_AIR_SYSTEM_DELAY,
  {R('coalesce(avg(LATE_AIRCRAFT_DELAY), 0.0)')} AS AVG_LATE_AIRCRAFT_DELAY
FROM fl GROUP BY AIRLINE"""))
def q_f10(spark, sf_dir):
    return metrics.delay_analysis(tables(spark, sf_dir), digits=D)


# =========================================================================== metrics: star
@register("q_f19_executive_kpis", with_flights(f"""
g AS (SELECT count(*) AS total_flights, (SELECT count(*) FROM air) AS total_airlines,
        (SELECT count(*) FROM apt) AS total_airports,
        {P('count_if(CANCELLED = 1)', 'count(*)')} AS cancel_rate,
        {P('count_if(DIVERTED = 1)', 'count(*)')} AS divert_rate,
        {R('avg(DEPARTURE_DELAY)')} AS avg_dep, {R('avg(ARRIVAL_DELAY)')} AS avg_arr FROM fl)
SELECT *, {R('100.0 - cancel_rate - divert_rate')} AS completed_pct FROM g"""))
def q_f19(spark, sf_dir):
    return metrics.executive_kpis(star(spark, sf_dir), rate_digits=D, avg_digits=D)


@register("q_f20_top_airlines_by_name", with_flights("""
SELECT airline_name, count(*) AS flights FROM fl GROUP BY airline_name
ORDER BY flights DESC, airline_name LIMIT 10"""))
def q_f20(spark, sf_dir):
    return metrics.top_carriers(star(spark, sf_dir))


@register("q_f21_top_airports_by_traffic", with_flights("""
SELECT code AS airport_code, count(*) AS traffic FROM roles GROUP BY code
ORDER BY traffic DESC, airport_code LIMIT 10"""))
def q_f21(spark, sf_dir):
    return metrics.top_airports(star(spark, sf_dir))


_CAUSES_WIDE = f"""
w AS (SELECT {R('avg(WEATHER_DELAY)')} AS "Weather", {R('avg(AIRLINE_DELAY)')} AS "Airline",
        {R('avg(SECURITY_DELAY)')} AS "Security", {R('avg(AIR_SYSTEM_DELAY)')} AS "NAS",
        {R('avg(LATE_AIRCRAFT_DELAY)')} AS "Late Aircraft" FROM fl WHERE ARRIVAL_DELAY > 0)"""


@register("q_f22_network_delay_causes", with_flights(_CAUSES_WIDE + """
SELECT 'Weather' AS category, "Weather" AS avg_minutes FROM w
UNION ALL SELECT 'Airline', "Airline" FROM w UNION ALL SELECT 'Security', "Security" FROM w
UNION ALL SELECT 'NAS', "NAS" FROM w UNION ALL SELECT 'Late Aircraft', "Late Aircraft" FROM w"""))
def q_f22(spark, sf_dir):
    return metrics.cause_averages(star(spark, sf_dir), arr_gt=0, long=True, digits=D)


@register("q_f30_delay_causes_filtered", with_flights(_CAUSES_WIDE + "\nSELECT * FROM w"))
def q_f30(spark, sf_dir):
    return metrics.cause_averages(star(spark, sf_dir), arr_gt=0, carrier_key=None,
                                  date_key=None, digits=D)


@register("q_f23_airline_drilldown", with_flights(f"""
SELECT k.airline_key, k.airline_name, count(*) AS flights, {R('avg(DEPARTURE_DELAY)')} AS avg_dep,
  {R('avg(ARRIVAL_DELAY)')} AS avg_arr, {P('count_if(CANCELLED = 1)', 'count(*)')} AS cancel_rate
FROM fl JOIN dim_air k ON fl.AIRLINE = k.airline_code GROUP BY k.airline_key, k.airline_name"""))
def q_f23(spark, sf_dir):
    return metrics.carrier_kpis(star(spark, sf_dir), None, rate_digits=D, avg_digits=D)


@register("q_f24_daily_volume", with_flights("""
SELECT full_date, d.day_name, count(*) AS flights,
  d.day_name || ' (' || strftime(full_date, '%Y-%m-%d') || ')' AS date_label
FROM fl JOIN dd d USING (full_date) GROUP BY full_date, d.day_name"""))
def q_f24(spark, sf_dir):
    return metrics.carrier_daily(star(spark, sf_dir), None)


@register("q_f25_airline_comparison", with_flights(f"""
SELECT airline_name, count(*) AS flights, {R('avg(ARRIVAL_DELAY)')} AS avg_delay,
  {P('count_if(CANCELLED = 1)', 'count(*)')} AS cancel_rate FROM fl GROUP BY airline_name"""))
def q_f25(spark, sf_dir):
    return metrics.carrier_comparison(star(spark, sf_dir), rate_digits=D, avg_digits=D)


@register("q_f26_airport_drilldown", with_flights(f"""
r AS (SELECT ORIGIN_AIRPORT AS code, 1 AS o, 0 AS a, DEPARTURE_DELAY AS v FROM fl
      UNION ALL SELECT DESTINATION_AIRPORT, 0, 1, NULL FROM fl),
g AS (SELECT code, CAST(sum(o) AS BIGINT) AS departures, CAST(sum(a) AS BIGINT) AS arrivals,
        avg(v) AS av FROM r GROUP BY code)
SELECT k.airport_key, k.airport_code, k.airport_name, k.city, k.state, departures, arrivals,
  coalesce({R('av')}, 0.0) AS avg_dep_delay
FROM g JOIN dim_apt k ON g.code = k.airport_code"""))
def q_f26(spark, sf_dir):
    return metrics.airport_kpis(star(spark, sf_dir), None, avg_digits=D)


@register("q_f27_top_destinations", with_flights("""
g AS (SELECT ORIGIN_AIRPORT AS hub, DESTINATION_AIRPORT AS code, count(*) AS flights
      FROM fl GROUP BY 1, 2),
rk AS (SELECT h.airport_key AS hub_key, g.code AS airport_code, g.code AS airport_name, flights,
         CAST(row_number() OVER (PARTITION BY hub ORDER BY flights DESC, g.code) AS BIGINT)
           AS dest_rank
       FROM g JOIN dim_apt h ON h.airport_code = g.hub)
SELECT * FROM rk WHERE dest_rank <= 10"""))
def q_f27(spark, sf_dir):
    return metrics.top_destinations(star(spark, sf_dir), None, 10)


@register("q_f28_airport_rankings", with_flights("""
t AS (SELECT code AS airport_code, count(*) AS total_traffic FROM roles GROUP BY code)
SELECT airport_code, total_traffic,
  CAST(dense_rank() OVER (ORDER BY total_traffic DESC) AS BIGINT) AS "rank"
FROM t ORDER BY "rank", airport_code LIMIT 25"""))
def q_f28(spark, sf_dir):
    return metrics.airport_rankings(star(spark, sf_dir), 25)


@register("q_f29_route_table", with_flights(f"""
SELECT ORIGIN_AIRPORT AS origin, DESTINATION_AIRPORT AS destination,
  ORIGIN_AIRPORT || ' -> ' || DESTINATION_AIRPORT AS route, count(*) AS flights,
  {R('avg(ARRIVAL_DELAY)')} AS avg_delay, {P('count_if(CANCELLED = 1)', 'count(*)')} AS cancel_rate,
  {R('avg(DISTANCE)')} AS avg_distance_mi
FROM fl GROUP BY ORIGIN_AIRPORT, DESTINATION_AIRPORT HAVING count(*) >= 20
ORDER BY flights DESC, origin, destination LIMIT 20"""))
def q_f29(spark, sf_dir):
    return metrics.routes(star(spark, sf_dir), min_flights=20, limit=20, avg_digits=D,
                          rate_digits=D, dist_digits=D)


@register("q_f31_airline_arrival_delay", with_flights(f"""
SELECT airline_name, {R('avg(ARRIVAL_DELAY)')} AS avg_delay FROM fl WHERE ARRIVAL_DELAY > 0
GROUP BY airline_name"""))
def q_f31(spark, sf_dir):
    return metrics.carrier_delay(star(spark, sf_dir), arr_gt=0, digits=D)


@register("q_f32_daily_trend", with_flights(f"""
SELECT full_date, d.day_name, d.is_weekend, count(*) AS flights,
  {R('avg(DEPARTURE_DELAY)')} AS avg_dep_delay, {R('avg(ARRIVAL_DELAY)')} AS avg_arr_delay,
  {P('count_if(CANCELLED = 1)', 'count(*)')} AS cancel_rate,
  d.day_name || ' ' || strftime(full_date, '%m-%d') AS label
FROM fl JOIN dd d USING (full_date) GROUP BY full_date, d.day_name, d.is_weekend"""))
def q_f32(spark, sf_dir):
    return metrics.daily_trend(star(spark, sf_dir), rate_digits=D, avg_digits=D)


@register("q_f33_airline_by_day", with_flights("""
SELECT full_date, d.day_name, airline_name, count(*) AS flights,
  d.day_name || ' ' || strftime(full_date, '%m-%d') AS label
FROM fl JOIN dd d USING (full_date) GROUP BY full_date, d.day_name, airline_name"""))
def q_f33(spark, sf_dir):
    return metrics.carrier_by_day(star(spark, sf_dir))


@register("q_f34_weekday_weekend", with_flights(f"""
SELECT CASE WHEN d.is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, count(*) AS flights,
  {R('avg(DEPARTURE_DELAY)')} AS avg_delay
FROM fl JOIN dd d USING (full_date) GROUP BY day_type"""))
def q_f34(spark, sf_dir):
    return metrics.day_type(star(spark, sf_dir), digits=D)


@register("q_f43_airline_options", with_flights(
    "SELECT airline_key, airline_name FROM dim_air"))
def q_f43a(spark, sf_dir):
    return metrics.filter_options(star(spark, sf_dir), "airlines")


@register("q_f43_airport_options", with_flights("""
SELECT airport_key, airport_code || ' - ' || airport_name AS label FROM dim_apt
WHERE airport_code IN (SELECT code FROM roles)"""))
def q_f43p(spark, sf_dir):
    return metrics.filter_options(star(spark, sf_dir), "airports")


@register("q_f43_date_options", with_flights("""
SELECT date_key, full_date, day_name,
  day_name || ' (' || strftime(full_date, '%Y-%m-%d') || ')' AS label FROM dd"""))
def q_f43d(spark, sf_dir):
    return metrics.filter_options(star(spark, sf_dir), "dates")


# =========================================================================== profile (B) / clean (C)
from contrail.operators import clean, keys, model, profile, quarantine  # noqa: E402
from contrail.plans.oracle import RAW_COLUMNS, STRING_COLUMNS, q  # noqa: E402
from contrail.spec import (AIRLINES_SCHEMA, DELAY_COLUMNS, FLIGHTS_SCHEMA,  # noqa: E402
                           NORMALIZED_FLIGHTS_SCHEMA)
from pyspark.sql import types as T  # noqa: E402

_NUM_PATTERN = r"^(-*[0-9]*\.?[0-9]+|-*[0-9]+\.?|nan)$"


def _miss(c, is_float):
    return f"({q(c)} IS NULL OR isnan({q(c)}))" if is_float else f"{q(c)} IS NULL"


def text_flights(spark, sf_dir):
    return bindings.text_flights(spark, sf_dir)


@register("q_b01_profile", with_flights(f"""
SELECT 'flights' AS dataset, count(*) AS row_count, {len(RAW_COLUMNS)} AS column_count,
  '{",".join(c for c, _ in RAW_COLUMNS)}' AS columns FROM rf"""))
def q_b01(spark, sf_dir):
    return profile.profile(raw(spark, sf_dir), "flights").select(
        "dataset", "row_count", "column_count", F.array_join("columns", ",").alias("columns"))


@register("q_b02_missing_values", with_flights("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count_if({_miss(c, fl_)}) AS missing_count, "
    f"CAST(count_if({_miss(c, fl_)}) AS DOUBLE) / count(*) * 100 AS missing_pct FROM rf"
    for c, fl_ in RAW_COLUMNS)))
def q_b02(spark, sf_dir):
    return profile.missing_report(raw(spark, sf_dir))


@register("q_b02_missing_summary", with_flights(f"""
m AS (SELECT count(*) AS r, {' + '.join(f'count_if({_miss(c, f)})' for c, f in RAW_COLUMNS)} AS t
      FROM rf)
SELECT CAST(t AS BIGINT) AS total_missing, CAST(r * {len(RAW_COLUMNS)} AS BIGINT) AS total_cells,
  coalesce(CAST(t AS DOUBLE) / CAST(r * {len(RAW_COLUMNS)} AS DOUBLE) * 100, 0.0)
    AS total_missing_percentage FROM m"""))
def q_b02s(spark, sf_dir):
    return profile.missing_summary(raw(spark, sf_dir))


def _dup_sql(cols):
    sel = ", ".join(q(c) for c in cols)
    return with_flights(f"""
t AS (SELECT count(*) AS total_rows FROM rf),
u AS (SELECT count(*) AS unique_rows FROM (SELECT DISTINCT {sel} FROM rf))
SELECT total_rows, unique_rows, total_rows - unique_rows AS duplicate_rows,
  coalesce(CAST(total_rows - unique_rows AS DOUBLE) / total_rows * 100, 0.0)
    AS duplicate_percentage FROM t, u""")


DUP_KEYS = ["AIRLINE", "FLIGHT_NUMBER", "YEAR"]


@register("q_b03_duplicate_rows", _dup_sql([c for c, _ in RAW_COLUMNS]))
def q_b03(spark, sf_dir):
    return profile.duplicate_report(raw(spark, sf_dir))


@register("q_b03_duplicate_keys", _dup_sql(DUP_KEYS))
def q_b03k(spark, sf_dir):
    return profile.duplicate_report(raw(spark, sf_dir), DUP_KEYS)


def _quality_sql(src, text_cols):
    n = len(RAW_COLUMNS)
    miss = " + ".join(f"count_if({_miss(c, f and c not in text_cols)})" for c, f in RAW_COLUMNS)
    bad = [f"least(2.0, coalesce(CAST(count_if(TRY_CAST(trim({q(c)}) AS DOUBLE) IS NULL "
           f"OR isnan(TRY_CAST(trim({q(c)}) AS DOUBLE))) AS DOUBLE) / count(*), 0.0) * 10)"
           for c in text_cols]
    ded = " + ".join(bad) if bad else "0.0"
    return with_flights(f"""
m AS (SELECT count(*) AS r, {miss} AS t, {ded} AS tded FROM {src}),
u AS (SELECT count(*) AS uq FROM (SELECT DISTINCT * FROM {src})),
s AS (SELECT r, coalesce(CAST(t AS DOUBLE) / (CAST(r AS DOUBLE) * {n}) * 100, 0.0) AS mp,
        coalesce(CAST(r - uq AS DOUBLE) / CAST(r AS DOUBLE) * 100, 0.0) AS dp,
        CAST(least(10.0, tded) AS DOUBLE) AS td FROM m, u),
f AS (SELECT *, CAST(floor(greatest(0.0, least(100.0,
        100.0 - least(30.0, mp * 0.5) - least(20.0, dp * 0.5) - td))) AS INTEGER) AS qs FROM s)
SELECT r AS total_rows, mp AS missing_percentage, dp AS duplicate_percentage,
  td AS type_deduction, qs AS quality_score,
  CASE WHEN qs >= 90 THEN 'Excellent' WHEN qs >= 75 THEN 'Good' WHEN qs >= 60 THEN 'Fair'
       ELSE 'Poor' END AS grade FROM f""")


@register("q_b06_quality_score", _quality_sql("rf", []))
def q_b06(spark, sf_dir):
    return profile.quality_score(raw(spark, sf_dir))


@register("q_b06_quality_score_text_feed", _quality_sql("tf", DELAY_COLUMNS))
def q_b06t(spark, sf_dir):
    return profile.quality_score(text_flights(spark, sf_dir))


def _to_num(c):
    v = f"TRY_CAST(trim({q(c)}) AS DOUBLE)"
    return f"CASE WHEN isnan({v}) THEN NULL ELSE {v} END"


@register("q_c03_validate_numeric", with_flights(
    "SELECT * REPLACE (" + ", ".join(f"{_to_num(c)} AS {q(c)}" for c in DELAY_COLUMNS)
    + ") FROM tf"))
def q_c03(spark, sf_dir):
    return clean.validate_numeric(text_flights(spark, sf_dir))


@register("q_c04_invalid_numeric", with_flights("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count_if(NOT ({q(c)} IS NULL OR "
    f"regexp_matches(trim({q(c)}), '{_NUM_PATTERN}'))) AS invalid_count FROM tf"
    for c in DELAY_COLUMNS)))
def q_c04(spark, sf_dir):
    return clean.invalid_numeric_report(text_flights(spark, sf_dir))


def _imputed_select(src):
    """Imputation in SQL. Integer columns of the binding never hold NULLs, so
    they pass through with their type; the others coalesce (a no-op without gaps)."""
    parts = []
    for c, is_float in RAW_COLUMNS:
        if c in STRING_COLUMNS:
            parts.append(f"coalesce({q(c)}, 'UNKNOWN') AS {q(c)}")
        elif not is_float:
            parts.append(q(c))
        else:
            parts.append(f"coalesce(CAST({q(c)} AS DOUBLE), "
                         f"(SELECT median(CAST({q(c)} AS DOUBLE)) FROM {src})) AS {q(c)}")
    return "SELECT " + ", ".join(parts) + f" FROM {src}"


@register("q_c01_impute", with_flights(_imputed_select("rf")))
def q_c01(spark, sf_dir):
    return clean.impute(raw(spark, sf_dir))


@register("q_c02_keep_first", with_flights(f"""
k AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(q(c) for c in DUP_KEYS)}
        ORDER BY {', '.join(q(c) + ' ASC NULLS FIRST' for c, _ in RAW_COLUMNS if c not in DUP_KEYS)})
        AS rn FROM rf)
SELECT * EXCLUDE (rn) FROM k WHERE rn = 1"""))
def q_c02(spark, sf_dir):
    f = raw(spark, sf_dir)
    return clean.dedupe(f, DUP_KEYS, [c for c in f.columns if c not in DUP_KEYS])


@register("q_c02_drop_duplicates", with_flights(
    "SELECT DISTINCT AIRLINE, ORIGIN_AIRPORT, DESTINATION_AIRPORT, \"YEAR\" FROM rf"))
def q_c02d(spark, sf_dir):
    return clean.dedupe(raw(spark, sf_dir).select("AIRLINE", "ORIGIN_AIRPORT",
                                                   "DESTINATION_AIRPORT", "YEAR"))


@register("q_c05_clean_report", with_flights(f"""
c AS (SELECT DISTINCT * FROM ({_imputed_select("rf")})),
b AS (SELECT count(*) AS initial_rows,
        {' + '.join(f'count_if({_miss(c, f)})' for c, f in RAW_COLUMNS)} AS total_missing FROM rf),
u AS (SELECT count(*) AS uq FROM (SELECT DISTINCT * FROM rf)),
a AS (SELECT count(*) AS t, CAST(sum(CANCELLED) AS BIGINT) AS cc, CAST(sum(DIVERTED) AS BIGINT) AS dv,
        avg(DEPARTURE_DELAY) AS dep, avg(ARRIVAL_DELAY) AS arr,
        count_if(DEPARTURE_DELAY <= 0 AND ARRIVAL_DELAY <= 0) AS ot FROM c),
s AS (SELECT initial_rows, CAST(total_missing AS BIGINT) AS total_missing,
        initial_rows - uq AS duplicates_before,
        CAST(floor(greatest(0.0, least(100.0, 100.0
          - least(30.0, CAST(total_missing AS DOUBLE) / (initial_rows * {len(RAW_COLUMNS)}.0) * 100 * 0.5)
          - least(20.0, CAST(initial_rows - uq AS DOUBLE) / initial_rows * 100 * 0.5)))) AS INTEGER)
          AS quality_score FROM b, u)
SELECT total_missing, initial_rows, duplicates_before, quality_score,
  CASE WHEN quality_score >= 90 THEN 'Excellent' WHEN quality_score >= 75 THEN 'Good'
       WHEN quality_score >= 60 THEN 'Fair' ELSE 'Poor' END AS grade,
  t AS final_rows, cc AS cancelled_flights, CAST(cc AS DOUBLE) / t * 100 AS cancelled_percentage,
  dv AS diverted_flights, CAST(dv AS DOUBLE) / t * 100 AS diverted_percentage,
  {R('dep')} AS avg_departure_delay, {R('arr')} AS avg_arrival_delay, ot AS on_time_flights,
  CAST(ot AS DOUBLE) / t * 100 AS on_time_percentage, initial_rows - t AS rows_removed
FROM s, a"""))
def q_c05(spark, sf_dir):
    return clean.clean_fact(raw(spark, sf_dir), digits=D)[1]


# =========================================================================== model
@register("q_c06_airline_members", with_flights("SELECT DISTINCT AIRLINE FROM fl"))
def q_c06(spark, sf_dir):
    return model.members(raw(spark, sf_dir), "AIRLINE", "AIRLINE")


@register("q_c08_airport_keys", with_flights("""
SELECT code AS AIRPORT, CAST(row_number() OVER (ORDER BY code) AS INTEGER) AS AIRPORT_ID
FROM (SELECT DISTINCT code FROM roles)"""))
def q_c08(spark, sf_dir):
    m = model.members(raw(spark, sf_dir), ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT"], "AIRPORT")
    return model.surrogate_keys(m, "AIRPORT", "AIRPORT_ID")


@register("q_c08_airline_keys_distributed", with_flights("""
SELECT airline_code AS AIRLINE, airline_key AS AIRLINE_ID FROM dim_air"""))
def q_c08d(spark, sf_dir):
    """Surrogate keys of airlines by code order."""
    m = model.members(raw(spark, sf_dir), "AIRLINE", "AIRLINE")
    return model.surrogate_keys(m, "AIRLINE", "AIRLINE_ID")


@register("q_c11_dim_airport", with_flights("SELECT * FROM dim_apt"))
def q_c11(spark, sf_dir):
    return star(spark, sf_dir).dim_airport


@register("q_c12_dim_airline", with_flights("SELECT * FROM dim_air"))
def q_c12(spark, sf_dir):
    return star(spark, sf_dir).dim_airline


@register("q_c13_dim_date", with_flights("SELECT * FROM dd"))
def q_c13(spark, sf_dir):
    return star(spark, sf_dir).dim_date


@register("q_c14_fact_flights", with_flights("""
SELECT a.airline_key, o.airport_key AS origin_airport_key, d.airport_key AS dest_airport_key,
  fl.date_key, CAST(fl.date_key / 10000 AS INTEGER) AS year,
  fl.* EXCLUDE ("YEAR", "MONTH", "DAY", DAY_OF_WEEK, AIRLINE, ORIGIN_AIRPORT, DESTINATION_AIRPORT,
                full_date, date_key, airline_name, origin_name, dest_name, origin_state,
                origin_lat, origin_lon)
FROM fl JOIN dim_air a ON fl.AIRLINE = a.airline_code
JOIN dim_apt o ON fl.ORIGIN_AIRPORT = o.airport_code
JOIN dim_apt d ON fl.DESTINATION_AIRPORT = d.airport_code"""))
def q_c14(spark, sf_dir):
    return star(spark, sf_dir).fact


# =========================================================================== distributions
from contrail.operators import quality  # noqa: E402
from contrail.plans import dist  # noqa: E402

_COMPLETED = ("CANCELLED <> 1 AND DIVERTED <> 1 AND DEPARTURE_DELAY IS NOT NULL "
              "AND ARRIVAL_DELAY IS NOT NULL")


@register("q_f35_delay_stats", with_flights("\nUNION ALL\n".join(
    f"SELECT '{c}' AS metric, count({c}) AS n, {R(f'avg({c})')} AS mean, "
    f"{R(f'quantile_cont({c}, 0.5)')} AS median, {R(f'stddev_samp({c})')} AS std, "
    f"{R(f'quantile_cont({c}, 0.9)')} AS p90 FROM rf WHERE {_COMPLETED}"
    for c in ("DEPARTURE_DELAY", "ARRIVAL_DELAY"))))
def q_f35(spark, sf_dir):
    return dist.delay_stats(dist.completed(raw(spark, sf_dir)),
                            ["DEPARTURE_DELAY", "ARRIVAL_DELAY"], digits=D)


def _hist_sql(src_where: str, col: str, bins: int, by: str | None = None, src: str = "rf"):
    bcol = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    join_s = f"JOIN s USING ({by})" if by else "CROSS JOIN s"
    return with_flights(f"""
x AS (SELECT {bcol}CAST({col} AS DOUBLE) AS v FROM {src} WHERE {col} IS NOT NULL AND {src_where}),
s AS (SELECT {bcol}min(v) AS lo, max(v) AS hi FROM x {'GROUP BY ' + by if by else ''}),
b AS (SELECT {bcol}CASE WHEN s.hi - s.lo = 0 THEN 1
        ELSE least(CAST(floor((v - s.lo) / (s.hi - s.lo) * {bins}) AS INTEGER) + 1, {bins}) END
        AS bin FROM x {join_s}),
c AS (SELECT {bcol}bin, count(*) AS n FROM b GROUP BY {bcol}bin),
g AS (SELECT {bcol}s.lo, s.hi, CAST(r.range AS INTEGER) AS bin FROM s, range(1, {bins + 1}) r)
SELECT {('g.' + by + ', ') if by else ''}g.bin,
  {R(f'g.lo + (g.bin - 1) * ((g.hi - g.lo) / {bins})')} AS bin_lo,
  {R(f'g.lo + g.bin * ((g.hi - g.lo) / {bins})')} AS bin_hi,
  coalesce(c.n, 0) AS frequency
FROM g LEFT JOIN c ON g.bin = c.bin {('AND g.' + by + ' = c.' + by) if by else ''}""")


@register("q_f36_dep_histogram",
          _hist_sql(_COMPLETED + " AND DEPARTURE_DELAY BETWEEN -20 AND 180", "DEPARTURE_DELAY", 50))
def q_f36d(spark, sf_dir):
    return dist.histogram(dist.completed(raw(spark, sf_dir)), "DEPARTURE_DELAY", 50, -20, 180,
                          digits=D)


@register("q_f36_arr_histogram",
          _hist_sql(_COMPLETED + " AND ARRIVAL_DELAY BETWEEN -20 AND 180", "ARRIVAL_DELAY", 50))
def q_f36a(spark, sf_dir):
    return dist.histogram(dist.completed(raw(spark, sf_dir)), "ARRIVAL_DELAY", 50, -20, 180,
                          digits=D)


@register("q_f37_airline_delay_histogram", _hist_sql(
    "DEPARTURE_DELAY BETWEEN -30 AND 120", "DEPARTURE_DELAY", 50, by="airline_key",
    src="(SELECT k.airline_key, fl.* FROM fl JOIN dim_air k ON fl.AIRLINE = k.airline_code)"))
def q_f37(spark, sf_dir):
    return dist.histogram(star(spark, sf_dir).fact, "DEPARTURE_DELAY", 50, -30, 120,
                          by="airline_key", digits=D)


@register("q_f38_weather_histogram", _hist_sql("WEATHER_DELAY > 0", "WEATHER_DELAY", 40))
def q_f38(spark, sf_dir):
    return dist.histogram(star(spark, sf_dir).fact, "WEATHER_DELAY", 40, None, None,
                          where=F.col("WEATHER_DELAY") > 0, digits=D)


# =========================================================================== data quality (K)
def cleaned(spark, sf_dir):
    return clean.dedupe(clean.impute(clean.validate_numeric(raw(spark, sf_dir))))


def _row(layer, family, check, checked, failures, status, src):
    return (f"SELECT '{layer}' AS layer, '{family}' AS family, '{check}' AS \"check\", "
            f"CAST({checked} AS BIGINT) AS checked, CAST({failures} AS BIGINT) AS failures, "
            f"{status} AS status FROM {src}")


def _pf(x):
    return f"CASE WHEN {x} = 0 THEN 'PASS' ELSE 'FAIL' END"


_K01 = "\nUNION ALL\n".join(
    _row("raw", "null", f"{c} nulls", "count(*)", f"count_if({c} IS NULL)",
         _pf(f"count_if({c} IS NULL)"), "rf")
    for c in ("AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT"))


@register("q_k01_null_check", with_flights(_K01))
def q_k01(spark, sf_dir):
    return quality.null_check(raw(spark, sf_dir))


_AIRLINES_REF = "(SELECT CAST(s_suppkey AS VARCHAR) AS IATA_CODE FROM supplier)"
_AIRPORTS_REF = "(SELECT n_name AS IATA_CODE FROM nation)"
_K02 = "\nUNION ALL\n".join([
    _row("reference", "duplicate", "duplicate airline IATA_CODE", "count(*)",
         f"count(*) - (SELECT count(DISTINCT IATA_CODE) FROM {_AIRLINES_REF})",
         _pf(f"count(*) - (SELECT count(DISTINCT IATA_CODE) FROM {_AIRLINES_REF})"),
         _AIRLINES_REF),
    _row("reference", "duplicate", "duplicate airport IATA_CODE", "count(*)",
         f"count(*) - (SELECT count(DISTINCT IATA_CODE) FROM {_AIRPORTS_REF})",
         _pf(f"count(*) - (SELECT count(DISTINCT IATA_CODE) FROM {_AIRPORTS_REF})"),
         _AIRPORTS_REF),
    _row("raw", "duplicate", "duplicate rows", "count(*)",
         "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM rf))",
         _pf("count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM rf))"), "rf")])


def _k02(spark, sf_dir):
    return (quality.duplicate_check(bindings.airlines_ref(spark, sf_dir), ["IATA_CODE"],
                                    "duplicate airline IATA_CODE", "reference")
            .unionByName(quality.duplicate_check(bindings.airports_ref(spark, sf_dir),
                                                 ["IATA_CODE"], "duplicate airport IATA_CODE",
                                                 "reference"))
            .unionByName(quality.duplicate_check(raw(spark, sf_dir))))


register("q_k02_duplicate_check", with_flights(_K02))(_k02)

_CLEANED_SQL = f"(SELECT DISTINCT * FROM ({_imputed_select('rf')}))"


def _tol(x):
    return f"CASE WHEN {x} = 0 THEN 'PASS' WHEN {x} <= 5 THEN 'WARN' ELSE 'FAIL' END"


_K04 = "\nUNION ALL\n".join([
    _row("cleaned", "business_rule", f"{c} >= -60", f"count({c})", f"count_if({c} < -60)",
         _tol(f"count_if({c} < -60)"), _CLEANED_SQL) for c in ("DEPARTURE_DELAY", "ARRIVAL_DELAY")]
    + [_row("cleaned", "business_rule", f"{lbl} rate in [0, 100]", "count(*)",
            f"CASE WHEN coalesce(sum({c}) / count(*) * 100, 0.0) BETWEEN 0 AND 100 THEN 0 ELSE 1 END",
            "'PASS'", _CLEANED_SQL)
       for c, lbl in (("CANCELLED", "cancellation"), ("DIVERTED", "diversion"))])


@register("q_k04_business_rules", with_flights(_K04))
def q_k04(spark, sf_dir):
    return quality.rule_check(cleaned(spark, sf_dir))


def _k05_row(col, ref, status):
    codes = f"(SELECT DISTINCT {col} AS c FROM rf WHERE {col} IS NOT NULL)"
    miss = f"(SELECT count(*) FROM {codes} WHERE c NOT IN (SELECT IATA_CODE FROM {ref}))"
    return _row("raw", "reference", f"{col} in reference", "count(*)", miss,
                f"CASE WHEN {miss} = 0 THEN 'PASS' ELSE '{status}' END", codes)


_K05 = "\nUNION ALL\n".join([
    _k05_row("AIRLINE", _AIRLINES_REF, "FAIL"), _k05_row("ORIGIN_AIRPORT", _AIRPORTS_REF, "WARN"),
    _k05_row("DESTINATION_AIRPORT", _AIRPORTS_REF, "WARN")])


@register("q_k05_reference_integrity", with_flights(_K05))
def q_k05(spark, sf_dir):
    f = raw(spark, sf_dir)
    air, apt = bindings.airlines_ref(spark, sf_dir), bindings.airports_ref(spark, sf_dir)
    return (quality.ref_check(f, "AIRLINE", air, on_fail="FAIL")
            .unionByName(quality.ref_check(f, "ORIGIN_AIRPORT", apt, on_fail="WARN"))
            .unionByName(quality.ref_check(f, "DESTINATION_AIRPORT", apt, on_fail="WARN")))


_FACT_SQL = """(SELECT a.airline_key, o.airport_key AS origin_airport_key,
    d.airport_key AS dest_airport_key, fl.date_key, fl.DEPARTURE_DELAY, fl.ARRIVAL_DELAY
  FROM fl JOIN dim_air a ON fl.AIRLINE = a.airline_code
  JOIN dim_apt o ON fl.ORIGIN_AIRPORT = o.airport_code
  JOIN dim_apt d ON fl.DESTINATION_AIRPORT = d.airport_code)"""
_ORPHAN = {
    "airline_key": "count_if(airline_key IS NOT NULL AND airline_key NOT IN "
                   "(SELECT airline_key FROM dim_air))",
    "origin_airport_key": "count_if(origin_airport_key IS NOT NULL AND origin_airport_key NOT IN "
                          "(SELECT airport_key FROM dim_apt))",
    "dest_airport_key": "count_if(dest_airport_key IS NOT NULL AND dest_airport_key NOT IN "
                        "(SELECT airport_key FROM dim_apt))",
    "date_key": "count_if(date_key IS NOT NULL AND date_key NOT IN (SELECT date_key FROM dd))",
}


_K06 = "\nUNION ALL\n".join(
    _row("warehouse", "orphan", f"orphan {k}", "count(*)", v, _pf(v), _FACT_SQL)
    for k, v in _ORPHAN.items())


@register("q_k06_orphans", with_flights(_K06))
def q_k06(spark, sf_dir):
    s = star(spark, sf_dir)
    return quality.orphan_check(s.fact, [
        ("airline_key", s.dim_airline, "airline_key", s.rows.get("dim_airline")),
        ("origin_airport_key", s.dim_airport, "airport_key", s.rows.get("dim_airport")),
        ("dest_airport_key", s.dim_airport, "airport_key", s.rows.get("dim_airport")),
        ("date_key", s.dim_date, "date_key", s.rows.get("dim_date"))])


_SPARSE = {"CANCELLATION_REASON", "AIR_SYSTEM_DELAY", "SECURITY_DELAY", "AIRLINE_DELAY",
           "LATE_AIRCRAFT_DELAY", "WEATHER_DELAY"}
_DENSE = [(c, f) for c, f in RAW_COLUMNS if c not in _SPARSE]


@register("q_k07_dq_scores", with_flights(f"""
a AS (SELECT count(*) AS rn, {' + '.join(f'count_if({_miss(c, f)})' for c, f in _DENSE)} AS nulls,
        (SELECT count(*) FROM (SELECT DISTINCT * FROM rf)) AS ru FROM rf),
b AS (SELECT count(*) AS cn, count_if(DEPARTURE_DELAY < -60 OR ARRIVAL_DELAY < -60) AS bad
      FROM {_CLEANED_SQL}),
s AS (SELECT {R(f'(1 - CAST(nulls AS DOUBLE) / (rn * {len(_DENSE)})) * 100')} AS completeness,
        {R('(1 - CAST(bad AS DOUBLE) / cn) * 100')} AS validity,
        {R('(1 - CAST(rn - ru AS DOUBLE) / rn) * 100')} AS consistency FROM a, b)
SELECT *, {R('(completeness + validity + consistency) / 3')} AS overall FROM s"""))
def q_k07(spark, sf_dir):
    return quality.dq_scores(raw(spark, sf_dir), cleaned(spark, sf_dir), digits=D)


@register("q_k08_reconciliation", with_flights(f"""
k AS (SELECT (SELECT count(*) FROM rf) AS raw, (SELECT count(*) FROM {_CLEANED_SQL}) AS cleaned,
  (SELECT count(*) FROM {_FACT_SQL}) AS loaded, (SELECT count(*) FROM fl) AS published)
SELECT *, CASE WHEN raw = cleaned AND raw = loaded AND raw = published THEN 'PASS' ELSE 'FAIL' END
    AS status FROM k"""))
def q_k08(spark, sf_dir):
    return quality.reconcile({
        "raw": raw(spark, sf_dir), "cleaned": cleaned(spark, sf_dir),
        "loaded": star(spark, sf_dir).fact,
        "published": (metrics.executive_summary(tables(spark, sf_dir)), "TOTAL_FLIGHTS")})


def _sub(sql):
    return f"SELECT * FROM ({sql})"


@register("q_k09_dq_rollup", f"""
WITH r AS ({_sub(with_flights(_K01))} UNION ALL {_sub(with_flights(_K02))}
  UNION ALL {_sub(with_flights(_K04))})
SELECT count(*) AS checks, count_if(status = 'FAIL') AS failed,
  count_if(status IN ('WARN', 'WARNING')) AS warned,
  coalesce(string_agg(CASE WHEN status = 'FAIL' THEN layer || ':' || "check" END, '; '
    ORDER BY CASE WHEN status = 'FAIL' THEN layer || ':' || "check" END), '') AS failed_checks,
  CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL'
       WHEN count_if(status IN ('WARN', 'WARNING')) > 0 THEN 'WARN' ELSE 'PASS' END
    AS overall_status
FROM r""")
def q_k09(spark, sf_dir):
    results = (quality.null_check(raw(spark, sf_dir)).unionByName(_k02(spark, sf_dir))
               .unionByName(quality.rule_check(cleaned(spark, sf_dir))))
    return quality.dq_rollup(results)


@register("q_k10_load_check", with_flights("\nUNION ALL\n".join([
    _row("normalized", "load", "flights rows", "count(*)", "count(*)",
         "CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END", _FACT_SQL),
    _row("normalized", "load", "airlines rows", "count(*)", "count(*)",
         "CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END", "dim_air"),
    _row("normalized", "load", "airports rows", "count(*)", "count(*)",
         "CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END", "dim_apt")]
    + [_row("normalized", "load", f"null {n}", "count(*)", f"count_if({c} IS NULL)",
            _pf(f"count_if({c} IS NULL)"), _FACT_SQL)
       for n, c in (("AIRLINE_ID", "airline_key"), ("ORIGIN_AIRPORT_ID", "origin_airport_key"),
                    ("DESTINATION_AIRPORT_ID", "dest_airport_key"))])))
def q_k10(spark, sf_dir):
    return quality.load_check(tables(spark, sf_dir))


_STAR_VALUES = {
    "fact_rows": f"(SELECT count(*) FROM {_FACT_SQL})",
    "rows_airline": "(SELECT count(*) FROM dim_air)", "rows_airport": "(SELECT count(*) FROM dim_apt)",
    "rows_date": "(SELECT count(*) FROM dd)",
    **{f"orphan_{k}": f"(SELECT {v} FROM {_FACT_SQL})" for k, v in _ORPHAN.items()},
    **{f"null_{k}": f"(SELECT count_if({k} IS NULL) FROM {_FACT_SQL})" for k in _ORPHAN},
    "dup_airline": "(SELECT count(*) FROM (SELECT airline_key FROM dim_air GROUP BY 1 "
                   "HAVING count(*) > 1))",
    "dup_airport": "(SELECT count(*) FROM (SELECT airport_key FROM dim_apt GROUP BY 1 "
                   "HAVING count(*) > 1))",
    "dup_date": "(SELECT count(*) FROM (SELECT date_key FROM dd GROUP BY 1 HAVING count(*) > 1))",
    "null_dep": f"(SELECT count_if(DEPARTURE_DELAY IS NULL) FROM {_FACT_SQL})",
    "null_arr": f"(SELECT count_if(ARRIVAL_DELAY IS NULL) FROM {_FACT_SQL})",
}
_K11 = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS \"check\", CAST({_STAR_VALUES[c]} AS BIGINT) AS value, "
    f"{'false' if n.endswith(' rows') else 'true'} AS is_issue"
    for n, c in quality.STAR_CHECKS)


@register("q_k11_star_checks", with_flights(_K11))
def q_k11(spark, sf_dir):
    return quality.star_checks(star(spark, sf_dir))


@register("q_k11_star_status", f"""
WITH c AS ({_sub(with_flights(_K11))})
SELECT CAST(coalesce(sum(CASE WHEN is_issue THEN value END), 0) AS BIGINT) AS total_issues,
  CASE WHEN coalesce(sum(CASE WHEN is_issue THEN value END), 0) = 0 THEN 'SUCCESS'
       ELSE 'FAILED' END AS status FROM c""")
def q_k11s(spark, sf_dir):
    return quality.star_status(quality.star_checks(star(spark, sf_dir)))


_K12 = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule, CAST({_STAR_VALUES[c]} AS BIGINT) AS records_checked, "
    f"CAST({_STAR_VALUES[f]} AS BIGINT) AS failures, CASE WHEN {_STAR_VALUES[f]} = 0 THEN 'PASS' "
    f"WHEN {_STAR_VALUES[f]} < 10 THEN 'WARNING' ELSE 'FAIL' END AS status"
    for n, c, f in quality.MATRIX_RULES)


@register("q_k12_rule_matrix", with_flights(_K12))
def q_k12(spark, sf_dir):
    return quality.rule_matrix(star(spark, sf_dir))


@register("q_k13_matrix_score", f"""
WITH m AS ({_sub(with_flights(_K12))}),
g AS (SELECT count(*) AS total_checks, count_if(status = 'PASS') AS passed_checks FROM m)
SELECT total_checks, passed_checks, total_checks - passed_checks AS failed_checks,
  round(100.0 - CAST(total_checks - passed_checks AS DOUBLE) / total_checks * 100, 1) AS dq_score,
  CASE WHEN round(100.0 - CAST(total_checks - passed_checks AS DOUBLE) / total_checks * 100, 1) >= 95
         THEN 'EXCELLENT'
       WHEN round(100.0 - CAST(total_checks - passed_checks AS DOUBLE) / total_checks * 100, 1) >= 80
         THEN 'GOOD'
       WHEN round(100.0 - CAST(total_checks - passed_checks AS DOUBLE) / total_checks * 100, 1) >= 60
         THEN 'FAIR' ELSE 'CRITICAL' END AS score_label FROM g""")
def q_k13(spark, sf_dir):
    return quality.matrix_score(quality.rule_matrix(star(spark, sf_dir)))


@register("q_k16_dq_insights", with_flights(f"""
m AS ({_K12})
SELECT lower(regexp_extract(rule, '^(Null|Orphan|Duplicate)', 1)) || '_total' AS insight,
  CAST(sum(failures) AS BIGINT) AS value FROM m
WHERE regexp_extract(rule, '^(Null|Orphan|Duplicate)', 1) <> '' GROUP BY 1
UNION ALL SELECT 'coverage_flights', CAST({_STAR_VALUES['fact_rows']} AS BIGINT) FROM (SELECT 1)
UNION ALL SELECT 'coverage_dates', CAST({_STAR_VALUES['rows_date']} AS BIGINT) FROM (SELECT 1)
UNION ALL SELECT 'coverage_airlines', CAST({_STAR_VALUES['rows_airline']} AS BIGINT) FROM (SELECT 1)
UNION ALL SELECT 'coverage_airports', CAST({_STAR_VALUES['rows_airport']} AS BIGINT) FROM (SELECT 1)
""".replace("FROM (SELECT 1)", "FROM (SELECT 1) AS one")))
def q_k16(spark, sf_dir):
    s = star(spark, sf_dir)
    return quality.dq_insights(quality.rule_matrix(s), s)


@register("q_f39_kpi_audit", with_flights("""
p AS (SELECT CAST(count(*) AS DOUBLE) AS tf, CAST((SELECT count(*) FROM air) AS DOUBLE) AS ta, CAST((SELECT count(*) FROM apt) AS DOUBLE) AS tp,
        round(coalesce(CAST(count_if(CANCELLED = 1) AS DOUBLE) * 100.0 / count(*), 0.0), 4) AS cr,
        round(coalesce(CAST(count_if(DIVERTED = 1) AS DOUBLE) * 100.0 / count(*), 0.0), 4) AS dr,
        round(coalesce(avg(DEPARTURE_DELAY), 0.0), 2) AS ad,
        round(coalesce(avg(ARRIVAL_DELAY), 0.0), 2) AS aa FROM fl),
m AS (SELECT unnest([{'metric': 'TOTAL_FLIGHTS', 'v': tf, 'r': tf, 'drift': 1.0, 'tol': 0.0}, {'metric': 'TOTAL_AIRLINES', 'v': ta, 'r': ta, 'drift': 0.0, 'tol': 0.0},
    {'metric': 'TOTAL_AIRPORTS', 'v': tp, 'r': tp, 'drift': 0.0, 'tol': 0.0}, {'metric': 'CANCELLATION_RATE', 'v': cr, 'r': round(cr, 2), 'drift': 0.0, 'tol': 0.1},
    {'metric': 'DIVERSION_RATE', 'v': dr, 'r': round(dr, 2), 'drift': 0.0, 'tol': 0.1}, {'metric': 'AVG_DEPARTURE_DELAY', 'v': ad, 'r': round(ad, 1), 'drift': 0.2, 'tol': 0.1},
    {'metric': 'AVG_ARRIVAL_DELAY', 'v': aa, 'r': round(aa, 1), 'drift': 0.0, 'tol': 0.1}], recursive := true) FROM p),
x AS (SELECT 'as is' AS published_as, metric, v AS published, r AS recomputed, tol FROM m
      UNION ALL SELECT 'drifted', metric, v + drift, r, tol FROM m)
SELECT published_as, metric, published, recomputed, round(abs(published - recomputed), 9) AS diff,
  CASE WHEN round(abs(published - recomputed), 9) <= tol THEN 'PASS' ELSE 'FAIL' END AS status FROM x"""))
def q_f39(spark, sf_dir):
    """The published summary against a recomputation, as it is and with two drifted values."""
    published = metrics.executive_summary(tables(spark, sf_dir))
    recomputed = metrics.executive_from_flights(raw(spark, sf_dir))
    drifted = (published.withColumn("TOTAL_FLIGHTS", F.col("TOTAL_FLIGHTS") + 1)
               .withColumn("AVG_DEPARTURE_DELAY", F.col("AVG_DEPARTURE_DELAY") + 0.2))
    return (quality.kpi_audit(published, recomputed).withColumn("published_as", F.lit("as is"))
            .unionByName(quality.kpi_audit(drifted, recomputed).withColumn("published_as", F.lit("drifted"))))


# =========================================================================== run log
from contrail.plans.oracle import with_runlog  # noqa: E402
from contrail.session import scratch_path  # noqa: E402
from contrail.sources import io, runlog  # noqa: E402
from contrail.operators import contract  # noqa: E402


def log(spark, sf_dir):
    return runlog.read_log(spark, bindings.run_log_path(spark, sf_dir))


@register("q_a11_run_json_roundtrip", with_runlog("""
SELECT id, run_id, phase_name, status, duration_seconds, start_time, end_time,
  CAST(NULL AS VARCHAR) AS error_message FROM ph"""))
def q_a11(spark, sf_dir):
    runs, phases = log(spark, sf_dir)
    path = scratch_path(spark, "run-json")
    runlog.to_metadata(runs, phases).write.mode("overwrite").json(path)
    return runlog.read_run_json(spark, path, multiline=False)[1]


@register("q_f45_latest_run", with_runlog("""
SELECT run_timestamp, overall_status, total_duration FROM runs
ORDER BY run_timestamp DESC, run_id DESC LIMIT 1"""))
def q_f45(spark, sf_dir):
    return runlog.latest_run(log(spark, sf_dir)[0])


@register("q_f46_phase_timeline", with_runlog("""
SELECT r.run_timestamp, p.phase_name, p.status, p.duration_seconds, p.start_time, p.end_time
FROM ph p JOIN runs r USING (run_id)"""))
def q_f46(spark, sf_dir):
    return runlog.phase_timeline(*log(spark, sf_dir))


@register("q_f47_dq_trend", with_runlog("SELECT run_timestamp, dq_score, records_loaded FROM runs"))
def q_f47(spark, sf_dir):
    return runlog.dq_trend(log(spark, sf_dir)[0])


@register("q_f48_run_report", with_runlog(f"""
SELECT run_id, count(*) AS total_phases, count_if(status = 'SUCCESS') AS successful_phases,
  count_if(status = 'FAILED') AS failed_phases, count_if(status = 'SKIPPED') AS skipped_phases,
  {R("CAST(count_if(status = 'SUCCESS') AS DOUBLE) / count(*) * 100")} AS success_rate,
  {R('sum(duration_seconds)')} AS total_runtime
FROM ph GROUP BY run_id"""))
def q_f48(spark, sf_dir):
    return runlog.run_report(log(spark, sf_dir)[1], digits=D)


FRESHNESS_NOW = "2024-02-01 00:00:00"


@register("q_k14_freshness", with_runlog(f"""
l AS (SELECT max(run_timestamp) AS last_run FROM runs),
h AS (SELECT last_run, (epoch(TIMESTAMP '{FRESHNESS_NOW}') - epoch(CAST(last_run AS TIMESTAMP)))
        / 3600.0 AS hours_ago FROM l)
SELECT last_run, hours_ago,
  CASE WHEN last_run IS NULL THEN 'Unknown' WHEN hours_ago < 24 THEN 'Fresh'
       WHEN hours_ago < 72 THEN 'Aging' ELSE 'Stale' END AS freshness FROM h"""))
def q_k14(spark, sf_dir):
    return runlog.freshness(log(spark, sf_dir)[0], FRESHNESS_NOW)


@register("q_k15_health", with_runlog("""
l AS (SELECT overall_status FROM runs ORDER BY run_timestamp DESC, run_id DESC LIMIT 1)
SELECT coalesce(overall_status, 'UNKNOWN') AS overall_status,
  CASE WHEN overall_status = 'SUCCESS' THEN 'HEALTHY' WHEN overall_status = 'WARNING' THEN 'WARNING'
       ELSE coalesce(overall_status, 'UNKNOWN') END AS health FROM l"""))
def q_k15(spark, sf_dir):
    return runlog.health(log(spark, sf_dir)[0])


# =========================================================================== io (A) / contract
@register("q_a01_reference_csv_roundtrip", with_flights(
    "SELECT CAST(s_suppkey AS VARCHAR) AS IATA_CODE, s_name AS AIRLINE FROM supplier"))
def q_a01(spark, sf_dir):
    path = scratch_path(spark, "airlines-csv")
    io.write_table(bindings.airlines_ref(spark, sf_dir), path, fmt="csv")
    return io.read_reference(spark, path, AIRLINES_SCHEMA)


@register("q_a02_fact_csv_roundtrip", with_flights("SELECT * FROM rf"))
def q_a02(spark, sf_dir):
    """A4 -> A2: cleaned flights written as CSV and read back with the full
    flights schema (columns the feed lacks come back NULL and are dropped)."""
    f = raw(spark, sf_dir)
    path = scratch_path(spark, "flights-csv")
    io.write_table(f, path, fmt="csv", require_rows=True)
    schema = T.StructType([FLIGHTS_SCHEMA[c] for c in f.columns])
    return io.read_fact(spark, path, schema)


@register("q_a12_table_inventory", with_flights("""
SELECT 'dim_airline' AS table_name, c.column_name, c.data_type,
  (SELECT count(*) FROM dim_air) AS row_count
FROM (VALUES ('airline_key', 'int'), ('airline_code', 'string'), ('airline_name', 'string'))
  AS c(column_name, data_type)
UNION ALL
SELECT 'dim_date', c.column_name, c.data_type, (SELECT count(*) FROM dd)
FROM (VALUES ('full_date', 'date'), ('date_key', 'int'), ('year', 'int'), ('quarter', 'int'),
  ('month', 'int'), ('month_name', 'string'), ('week', 'int'), ('day', 'int'),
  ('day_name', 'string'), ('is_weekend', 'boolean')) AS c(column_name, data_type)"""))
def q_a12(spark, sf_dir):
    s = star(spark, sf_dir)
    return io.table_inventory({"dim_airline": s.dim_airline, "dim_date": s.dim_date})


@register("q_b10_select_compatible", with_flights("""
SELECT "YEAR", "MONTH", "DAY", DAY_OF_WEEK, FLIGHT_NUMBER, TAIL_NUMBER, DEPARTURE_DELAY, DISTANCE,
  ARRIVAL_DELAY, DIVERTED, CANCELLED, CANCELLATION_REASON, AIR_SYSTEM_DELAY, SECURITY_DELAY,
  AIRLINE_DELAY, LATE_AIRCRAFT_DELAY, WEATHER_DELAY, AIRCRAFT_ID, MODEL FROM rf"""))
def q_b10(spark, sf_dir):
    """Flights projected onto the normalized table's columns (natural codes drop out)."""
    return contract.select_compatible(raw(spark, sf_dir), NORMALIZED_FLIGHTS_SCHEMA)


@register("q_h03_idle_airlines", with_flights("""
SELECT CAST(s_suppkey AS VARCHAR) AS code FROM supplier
WHERE CAST(s_suppkey AS VARCHAR) NOT IN (SELECT DISTINCT AIRLINE FROM fl)"""))
def q_h03(spark, sf_dir):
    """H3: reference carriers that never fly (key difference, left_anti)."""
    flying = model.members(raw(spark, sf_dir), "AIRLINE", "AIRLINE")
    return model.unmatched(bindings.airlines_ref(spark, sf_dir), "IATA_CODE", flying, "AIRLINE")


@register("q_d02_range_filter", with_flights("""
SELECT AIRLINE, FLIGHT_NUMBER, DEPARTURE_DELAY FROM rf
WHERE CANCELLED <> 1 AND DIVERTED <> 1 AND DEPARTURE_DELAY IS NOT NULL
  AND ARRIVAL_DELAY IS NOT NULL AND DEPARTURE_DELAY BETWEEN -30 AND 120"""))
def q_d02(spark, sf_dir):
    """D2 + D3: completed flights with departure delay in [-30, 120]."""
    return (dist.completed(raw(spark, sf_dir)).where(dist.in_range("DEPARTURE_DELAY", -30, 120))
            .select("AIRLINE", "FLIGHT_NUMBER", "DEPARTURE_DELAY"))


@register("q_i13_phase_labels", with_runlog("""
SELECT r.run_timestamp, p.phase_name, p.status, p.duration_seconds, p.start_time, p.end_time,
  upper(substr(p.phase_name, 1, 1)) || lower(substr(p.phase_name, 2)) AS phase_label,
  CASE p.status WHEN 'SUCCESS' THEN 'SUCCESS' WHEN 'FAIL' THEN 'FAIL' WHEN 'FAILED' THEN 'FAIL'
    WHEN 'WARNING' THEN 'WARNING' ELSE 'OTHER' END AS status_band
FROM ph p JOIN runs r USING (run_id)"""))
def q_i13(spark, sf_dir):
    return runlog.phase_timeline(*log(spark, sf_dir), labels=True)


# K3 on the cleaned flights: date parts stay integers, delays are doubles (all PASS)
_K03 = "\nUNION ALL\n".join(
    [f"SELECT 'cleaned' AS layer, 'type' AS family, '{c} is integer' AS \"check\", "
     "CAST(1 AS BIGINT) AS checked, CAST(0 AS BIGINT) AS failures, 'PASS' AS status"
     for c in ("YEAR", "MONTH", "DAY")]
    + [f"SELECT 'cleaned', 'type', '{c} is numeric', CAST(1 AS BIGINT), CAST(0 AS BIGINT), 'PASS'"
       for c in DELAY_COLUMNS])


@register("q_k09_dq_run", with_flights(f"""
r AS ({_K01} UNION ALL {_K02} UNION ALL {_K03} UNION ALL {_K04} UNION ALL {_K05}
      UNION ALL {_K06})
SELECT count(*) AS checks, count_if(status = 'FAIL') AS failed,
  count_if(status IN ('WARN', 'WARNING')) AS warned,
  coalesce(string_agg(CASE WHEN status = 'FAIL' THEN layer || ':' || "check" END, '; '
    ORDER BY CASE WHEN status = 'FAIL' THEN layer || ':' || "check" END), '') AS failed_checks,
  CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL'
       WHEN count_if(status IN ('WARN', 'WARNING')) > 0 THEN 'WARN' ELSE 'PASS' END
    AS overall_status
FROM r"""))
def q_k09r(spark, sf_dir):
    """One data-quality run over every layer (K1-K6) rolled up (K9)."""
    results = quality.run_checks(raw(spark, sf_dir), cleaned(spark, sf_dir),
                                 bindings.airlines_ref(spark, sf_dir),
                                 bindings.airports_ref(spark, sf_dir), star(spark, sf_dir))
    return quality.dq_rollup(results)


@register("q_c02_drop_duplicates_hash_first", with_flights(
    "SELECT DISTINCT AIRLINE, ORIGIN_AIRPORT, DESTINATION_AIRPORT, \"YEAR\" FROM rf"))
def q_c02h(spark, sf_dir):
    return clean.dedupe(raw(spark, sf_dir).select("AIRLINE", "ORIGIN_AIRPORT",
                                                   "DESTINATION_AIRPORT", "YEAR"), method="hash")


@register("q_a03_extract_profiles", with_flights(f"""
SELECT 'flights' AS dataset, count(*) AS row_count, {len(FLIGHTS_SCHEMA.fields)} AS column_count
FROM rf
UNION ALL SELECT 'airlines', count(*), 2 FROM supplier
UNION ALL SELECT 'airports', count(*), 7 FROM nation"""))
def q_a03(spark, sf_dir):
    """A3: the three sources written as CSV files, extracted with explicit
    schemas and profiled (one row per source)."""
    base = scratch_path(spark, "sources")
    io.write_table(raw(spark, sf_dir), f"{base}/flights", fmt="csv")
    io.write_table(bindings.airlines_ref(spark, sf_dir), f"{base}/airlines", fmt="csv")
    io.write_table(bindings.airports_ref(spark, sf_dir), f"{base}/airports", fmt="csv")
    src = io.extract(spark, {"flights": f"{base}/flights", "airlines": f"{base}/airlines",
                             "airports": f"{base}/airports"})
    return src.profiles.select("dataset", "row_count", "column_count")


# Dataset contracts of the analytic outputs (A10): required columns per dataset.
CONTRACTS = {
    "executive_summary": ["TOTAL_FLIGHTS", "TOTAL_AIRLINES", "TOTAL_AIRPORTS",
                          "CANCELLATION_RATE", "DIVERSION_RATE", "AVG_DEPARTURE_DELAY",
                          "AVG_ARRIVAL_DELAY"],
    "airline_performance": ["AIRLINE_CODE", "FLIGHT_COUNT", "AVG_DEPARTURE_DELAY",
                            "AVG_ARRIVAL_DELAY", "CANCELLATION_RATE", "DIVERSION_RATE"],
    "airport_traffic": ["AIRPORT_CODE", "ORIGIN_FLIGHTS", "DESTINATION_FLIGHTS", "TOTAL_TRAFFIC"],
    "delay_analysis": ["AIRLINE_CODE", "AVG_WEATHER_DELAY", "AVG_AIRLINE_DELAY",
                       "AVG_SECURITY_DELAY", "AVG_AIR_SYSTEM_DELAY", "AVG_LATE_AIRCRAFT_DELAY"],
}


@register("q_a10_dataset_contracts", with_flights("\nUNION ALL\n".join(
    f"SELECT '{n}' AS name, 'contract' AS \"check\", "
    f"CASE WHEN (SELECT count(*) FROM fl) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
    f"CASE WHEN (SELECT count(*) FROM fl) = 0 THEN 'no rows' END AS detail"
    for n in CONTRACTS)))
def q_a10(spark, sf_dir):
    """A10: each analytic dataset (F7-F10) has its required columns and rows."""
    t = tables(spark, sf_dir)
    data = {"executive_summary": metrics.executive_summary(t),
            "airline_performance": metrics.carrier_performance(t),
            "airport_traffic": metrics.airport_traffic(t),
            "delay_analysis": metrics.delay_analysis(t)}
    out = None
    for name, cols in CONTRACTS.items():
        part = io.check_contract(data[name], name, cols)
        out = part if out is None else out.unionByName(part)
    return out


@register("q_a09_table_checks", with_flights("""
SELECT t.name, c.check_name AS "check",
  CASE WHEN c.check_name = 'exists' OR t.n > 0 THEN 'PASS' ELSE 'WARN' END AS status,
  CAST(NULL AS VARCHAR) AS detail
FROM (SELECT 'fact_flights' AS name, (SELECT count(*) FROM fl) AS n
      UNION ALL SELECT 'dim_airline', (SELECT count(*) FROM dim_air)
      UNION ALL SELECT 'dim_airport', (SELECT count(*) FROM dim_apt)
      UNION ALL SELECT 'dim_date', (SELECT count(*) FROM dd)) t,
     (VALUES ('exists'), ('non_empty')) AS c(check_name)"""))
def q_a09(spark, sf_dir):
    """The warehouse tables exist and are non-empty."""
    tables = Warehouse(spark, bindings.star_path(spark, sf_dir)).read_all()
    return io.check_tables(spark, {n: tables.get(n) for n in
                                   ("fact_flights", "dim_airline", "dim_airport", "dim_date")})


@register("q_a13_a14_source_layers", with_flights("""
SELECT name, "check", status, detail FROM (VALUES
  ('flights', 'source_present', 'PASS'), ('airlines', 'source_present', 'PASS'),
  ('airports', 'source_present', 'PASS'), ('cleaned_flights', 'layer', 'WARN'))
  AS v(name, "check", status), (SELECT count(*) AS n FROM rf) AS k(n),
  LATERAL (SELECT CASE WHEN name = 'cleaned_flights' THEN 'fell back to raw flights'
                  ELSE NULL END AS detail)"""))
def q_a13_a14(spark, sf_dir):
    """A13 + A14: the three CSV sources written from the driver data are
    present; the cleaned layer was not written, so it falls back to raw (WARN)."""
    base = scratch_path(spark, "sources")
    paths = {"flights": f"{base}/flights", "airlines": f"{base}/airlines",
             "airports": f"{base}/airports"}
    io.write_table(raw(spark, sf_dir), paths["flights"], fmt="csv")
    io.write_table(bindings.airlines_ref(spark, sf_dir), paths["airlines"], fmt="csv")
    io.write_table(bindings.airports_ref(spark, sf_dir), paths["airports"], fmt="csv")
    present = io.check_sources(spark, paths)
    layers, status = io.load_layers(spark, dict(paths, cleaned=f"{base}/cleaned"))
    # the detail of a present source is its path (run-specific): report NULL instead
    present = present.withColumn("detail", F.lit(None).cast("string"))
    return present.unionByName(status)


# =========================================================================== loads one after another
def _two_loads(spark, sf_dir, first, second, name):
    """The flights as two loads of one warehouse."""
    f, path = raw(spark, sf_dir), scratch_path(spark, name)
    for i, part in enumerate((first, second)):
        star_ = model.load_star(spark, f.where(part), path, bindings.airlines_ref(spark, sf_dir), bindings.airports_ref(spark, sf_dir), f"load-{i}")
    return star_, path


@register("q_c08_stable_keys", with_flights("""
m AS (SELECT 'airlines' AS dim, AIRLINE AS code, min(CASE WHEN greatest(ORIGIN_AIRPORT, DESTINATION_AIRPORT) < 'NATION_2' THEN 1 ELSE 2 END) AS load FROM fl GROUP BY AIRLINE
  UNION ALL SELECT 'airports', code, min(load) FROM (
    SELECT ORIGIN_AIRPORT AS code, CASE WHEN greatest(ORIGIN_AIRPORT, DESTINATION_AIRPORT) < 'NATION_2' THEN 1 ELSE 2 END AS load FROM fl
    UNION ALL SELECT DESTINATION_AIRPORT, CASE WHEN greatest(ORIGIN_AIRPORT, DESTINATION_AIRPORT) < 'NATION_2' THEN 1 ELSE 2 END FROM fl) GROUP BY code)
SELECT dim, code, CAST(row_number() OVER (PARTITION BY dim ORDER BY load, code) AS INTEGER) AS key, CAST(load AS BIGINT) AS load_version FROM m"""))
def q_c08_stable(spark, sf_dir):
    """Keys after two loads (flights between the first stations, then all others): those of the first
    load are numbered by code, the new ones of the second follow."""
    both = F.greatest("ORIGIN_AIRPORT", "DESTINATION_AIRPORT")
    _, path = _two_loads(spark, sf_dir, both < "NATION_2", both >= "NATION_2", "stable-keys")
    return keys.registry(Warehouse(spark, path))


@register("q_a07_incremental_star", with_flights(f"""
SELECT "YEAR" AS year, airline_name, origin_name AS origin, count(*) AS flights, count_if(CANCELLED = 1) AS cancelled, {R('avg(DEPARTURE_DELAY)')} AS avg_dep_delay
FROM fl GROUP BY "YEAR", airline_name, origin_name"""))
def q_a07(spark, sf_dir):
    """The star after two loads: up to 1995, with flown flights of 1995 only, then from 1995 on; 1995 is replaced."""
    flown = (F.col("YEAR") < 1995) | ((F.col("YEAR") == 1995) & (F.col("CANCELLED") == 0))
    s, _ = _two_loads(spark, sf_dir, flown, F.col("YEAR") >= 1995, "incremental")
    return (s.fact.join(s.dim_airline, "airline_key").join(s.dim_airport, s.fact.origin_airport_key == s.dim_airport.airport_key)
            .groupBy("year", "airline_name", F.col("airport_name").alias("origin"))
            .agg(F.count(F.lit(1)).alias("flights"), F.count_if(F.col("CANCELLED") == 1).alias("cancelled"), F.round(F.avg("DEPARTURE_DELAY"), D).alias("avg_dep_delay")))


@register("q_d04_calendar_slice", with_flights(f"""
SELECT d.year, d.quarter, d.is_weekend, count(*) AS flights, {R('avg(DEPARTURE_DELAY)')} AS avg_dep_delay, {R('avg(ARRIVAL_DELAY)')} AS avg_arr_delay,
  {P('count_if(CANCELLED = 1)', 'count(*)')} AS cancellation_rate
FROM fl JOIN dd d USING (date_key) WHERE d.is_weekend AND d.quarter = 4 GROUP BY d.year, d.quarter, d.is_weekend"""))
def q_d04(spark, sf_dir):
    """Weekends of the last quarter: a filter on the date's attributes."""
    return metrics.calendar_slice(star(spark, sf_dir), [F.col("is_weekend"), F.col("quarter") == 4], digits=D)


# =========================================================================== text feeds
@register("q_c03_quarantine", with_flights("""
bad AS (SELECT * FROM tf WHERE CANCELLED = 1 OR DISTANCE > 500)
SELECT '*' AS column_name, 'good' AS reason, count(*) - (SELECT count(*) FROM bad) AS cells FROM tf
UNION ALL SELECT '*', 'rejected', count(*) FROM bad
UNION ALL SELECT 'DEPARTURE_DELAY', 'unparsable', count(*) FROM tf WHERE CANCELLED = 1 GROUP BY 2
UNION ALL SELECT 'DISTANCE', 'out of range', count(*) FROM tf WHERE DISTANCE > 500 GROUP BY 2"""))
def q_c03_quarantine(spark, sf_dir):
    """The text feed as two CSV files with different column orders, parted into good rows and rejected cells."""
    feed, base = bindings.text_flights(spark, sf_dir), scratch_path(spark, "feed")
    io.write_table(feed.where("MONTH <= 6"), f"{base}/first-half", fmt="csv", options=io.PACKED)
    io.write_table(feed.where("MONTH > 6").select(*reversed(feed.columns)), f"{base}/second-half", fmt="csv", options=io.PACKED)
    got = quarantine.read_csv_split(spark, [f"{base}/first-half", f"{base}/second-half"], FLIGHTS_SCHEMA,
                                    required=["AIRLINE"], ranges={"DISTANCE": (0, 500)})
    rows = got.good.agg(F.count(F.lit(1)).alias("cells")).select(F.lit("*").alias("column_name"), F.lit("good").alias("reason"), "cells").unionByName(
        got.rows.agg(F.count(F.lit(1)).alias("cells")).select(F.lit("*").alias("column_name"), F.lit("rejected").alias("reason"), "cells"))
    return rows.unionByName(got.counts())


# =========================================================================== calendar windows
@register("q_g05_calendar_average", with_flights("""
v AS (SELECT ORIGIN_AIRPORT AS origin, full_date, count(*) AS flights FROM fl GROUP BY ALL),
e AS (SELECT origin, min(full_date) AS lo, max(full_date) AS hi FROM v GROUP BY origin),
c AS (SELECT origin, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS full_date FROM e),
f AS (SELECT origin, full_date, coalesce(flights, 0) AS flights FROM c LEFT JOIN v USING (origin, full_date))
SELECT *, avg(flights) OVER (PARTITION BY origin ORDER BY full_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS flights_ma7 FROM f"""))
def q_g05_calendar(spark, sf_dir):
    """Departures by station and calendar day, days without any included, and their seven-day average."""
    days = kpi.fill_calendar(kpi.station_days(star(spark, sf_dir)), "full_date", "day", "origin", {"flights": 0})
    return kpi.moving_average_by_date(days, "flights", "full_date", 7, "origin")


@register("q_g06_calendar_change", with_flights("""
v AS (SELECT AIRLINE AS airline_code, CAST(date_trunc('month', full_date) AS DATE) AS month, count(*) AS cancelled FROM fl WHERE CANCELLED = 1 GROUP BY ALL),
e AS (SELECT airline_code, min(month) AS lo, max(month) AS hi FROM v GROUP BY airline_code),
c AS (SELECT airline_code, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month FROM e),
f AS (SELECT airline_code, month, coalesce(cancelled, 0) AS cancelled FROM c LEFT JOIN v USING (airline_code, month))
SELECT f.*, p.cancelled AS prev_cancelled, f.cancelled - p.cancelled AS cancelled_change,
  CASE WHEN p.cancelled <> 0 THEN CAST(f.cancelled - p.cancelled AS DOUBLE) / p.cancelled * 100 END AS cancelled_change_pct
FROM f LEFT JOIN f p ON p.airline_code = f.airline_code AND p.month = CAST(f.month - INTERVAL 1 YEAR AS DATE)"""))
def q_g06_calendar(spark, sf_dir):
    """Cancelled flights by airline and calendar month against the same month of the year before."""
    months = kpi.fill_calendar(kpi.cancelled_months(star(spark, sf_dir)), "month", "month", "airline_code", {"cancelled": 0})
    return kpi.calendar_change(months, "cancelled", "month", "month", 12, "airline_code")


@register("q_f35_quantiles_by_ranges", with_flights("""
SELECT metric, p, quantile_cont(x, p) AS value FROM (
  SELECT 'price' AS metric, l_extendedprice AS x FROM lineitem UNION ALL SELECT 'delay', ARRIVAL_DELAY FROM fl UNION ALL SELECT 'distance', DISTANCE FROM fl),
  (VALUES (0.0::DOUBLE), (0.01::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE), (1.0::DOUBLE)) AS q(p) WHERE x IS NOT NULL GROUP BY metric, p"""
    .replace("quantile_cont(x, p)", "CASE p WHEN 0 THEN min(x) WHEN 0.01 THEN quantile_cont(x, 0.01) WHEN 0.25 THEN quantile_cont(x, 0.25) WHEN 0.5 THEN quantile_cont(x, 0.5) WHEN 0.9 THEN quantile_cont(x, 0.9) ELSE max(x) END")))
def q_f35_quantiles(spark, sf_dir):
    """Exact quantiles of prices (nearly as many values as rows), delays and distances."""
    ps = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    flown = quantiles(raw(spark, sf_dir), {"delay": F.col("ARRIVAL_DELAY"), "distance": F.col("DISTANCE")}, ps)
    return flown.unionByName(quantiles(bindings.table(spark, sf_dir, "lineitem"), {"price": F.col("l_extendedprice")}, ps))


# =========================================================================== content, sketches, schemas
_CONTENT = ["AIRLINE", "FLIGHT_NUMBER", "YEAR", "MONTH", "DAY", "ORIGIN_AIRPORT", "DEPARTURE_DELAY", "CANCELLED"]
_CONTENT_SQL = ", ".join(q(c) for c in _CONTENT)


@register("q_k08_content_rows", with_flights(f"""
a AS (SELECT {_CONTENT_SQL} FROM rf),
b AS (SELECT * REPLACE (CASE WHEN FLIGHT_NUMBER = '17' AND "YEAR" = 1996 THEN coalesce(DEPARTURE_DELAY, 0) + 1 ELSE DEPARTURE_DELAY END AS DEPARTURE_DELAY) FROM a)
SELECT 'loaded' AS layer, 'missing' AS side, count(*) AS copies, {_CONTENT_SQL} FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL
UNION ALL SELECT 'loaded', 'added', count(*), {_CONTENT_SQL} FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL"""))
def q_k08_content(spark, sf_dir):
    """Three layers with equal counts; in one a few delays were changed. The changed rows are named."""
    f = raw(spark, sf_dir).select(*_CONTENT)
    hit = (F.col("FLIGHT_NUMBER") == "17") & (F.col("YEAR") == 1996)
    changed = f.withColumn("DEPARTURE_DELAY", F.when(hit, F.coalesce("DEPARTURE_DELAY", F.lit(0.0)) + 1).otherwise(F.col("DEPARTURE_DELAY")))
    return quality.reconcile_content({"raw": f, "published": f.repartition("FLIGHT_NUMBER"), "loaded": changed}, ["AIRLINE", "FLIGHT_NUMBER"])[1]


@register("q_k08_content_status", with_flights("""
k AS (SELECT count(*) AS n, count_if(FLIGHT_NUMBER = '17' AND "YEAR" = 1996) AS hit FROM rf)
SELECT 'published' AS layer, n AS rows, 'PASS' AS status FROM k UNION ALL SELECT 'loaded', n, CASE WHEN hit > 0 THEN 'FAIL' ELSE 'PASS' END FROM k"""))
def q_k08_status(spark, sf_dir):
    f = raw(spark, sf_dir).select(*_CONTENT)
    hit = (F.col("FLIGHT_NUMBER") == "17") & (F.col("YEAR") == 1996)
    changed = f.withColumn("DEPARTURE_DELAY", F.when(hit, F.coalesce("DEPARTURE_DELAY", F.lit(0.0)) + 1).otherwise(F.col("DEPARTURE_DELAY")))
    return quality.reconcile_content({"raw": f, "published": f.repartition("FLIGHT_NUMBER"), "loaded": changed}, ["AIRLINE", "FLIGHT_NUMBER"])[0].drop("differing_buckets")


@register("q_f42_sketched_counts", with_flights("""
SELECT "YEAR" AS year, c.column_name, CASE c.column_name WHEN 'FLIGHT_NUMBER' THEN count(DISTINCT FLIGHT_NUMBER) WHEN 'AIRLINE' THEN count(DISTINCT AIRLINE)
  ELSE count(DISTINCT CANCELLATION_REASON) END AS exact_count, true AS within
FROM fl, (VALUES ('FLIGHT_NUMBER'), ('AIRLINE'), ('CANCELLATION_REASON')) AS c(column_name) GROUP BY 1, 2"""))
def q_f42_sketched(spark, sf_dir):
    """Distinct counts by year from sketches by day, next to the exact ones: within 2 %."""
    columns = ["FLIGHT_NUMBER", "AIRLINE", "CANCELLATION_REASON"]
    f, path = raw(spark, sf_dir).withColumnRenamed("YEAR", "year"), scratch_path(spark, "sketches")
    sketches.distinct_sketches(f, columns, ["year", "MONTH", "DAY"]).write.parquet(path)  # kept by day
    yearly = sketches.merged_counts(spark.read.parquet(path), "year")
    return sketches.with_exact(yearly, f, columns, "year").select("year", "column_name", "exact_count", "within")


@register("q_b08_table_schema", """
SELECT table_name, column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
  WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE data_type END AS data_type FROM information_schema.columns
WHERE table_name IN ('lineitem', 'orders', 'supplier', 'nation')""")
def q_b08(spark, sf_dir):
    """Names and types of the columns of tables as they are read."""
    rows = [(t, c, k) for t in ("lineitem", "orders", "supplier", "nation")
            for c, k in contract.table_schema(bindings.table(spark, sf_dir, t)).items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


@register("q_b09_schema_diff", """
WITH c AS (SELECT table_name, column_name, ordinal_position AS i FROM information_schema.columns WHERE table_name IN ('documents', 'labels')),
m AS (SELECT string_agg(column_name, ',' ORDER BY i) AS m, count(*) AS n FROM c WHERE table_name = 'documents' AND column_name NOT IN (SELECT column_name FROM c WHERE table_name = 'labels')),
e AS (SELECT string_agg(column_name, ',' ORDER BY i) AS m, count(*) AS n FROM c WHERE table_name = 'labels' AND column_name NOT IN (SELECT column_name FROM c WHERE table_name = 'documents'))
SELECT m.m AS missing_from_table, e.m AS extra_in_table, CAST(m.n AS INTEGER) AS missing_count, CAST(e.n AS INTEGER) AS extra_count, m.n = 0 AS is_valid FROM m, e""")
def q_b09(spark, sf_dir):
    """A frame with the columns of one table against the columns of another."""
    d = contract.schema_diff(bindings.table(spark, sf_dir, "documents"), bindings.table(spark, sf_dir, "labels"))
    return d.withColumns({c: F.array_join(c, ",") for c in ("missing_from_table", "extra_in_table")})
