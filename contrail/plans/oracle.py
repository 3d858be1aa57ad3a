"""DuckDB text of the flight binding, the first CTEs of every oracle query.

``fl`` is the flight-shaped view of ``contrail.sources.bindings.flights`` with
the star attributes already attached (airline name, airport codes, dates), so
an oracle can group by names/codes directly without surrogate keys.
"""

FLIGHTS_CTE = """
base AS (
  SELECT l.*, o.o_orderdate, c.c_nationkey, s.s_nationkey, s.s_name,
    (l_linestatus = 'F' AND l_returnflag = 'R' AND l_quantity > 40) AS is_canc,
    (l_linestatus = 'F' AND l_returnflag = 'A' AND l_quantity > 45) AS is_dv,
    CAST(l_quantity AS INT) * 4 - 66 AS dep0,
    CAST(floor(l_extendedprice) AS BIGINT) % 240 - 62 AS arr0
  FROM lineitem l
  JOIN orders o ON l_orderkey = o_orderkey
  JOIN customer c ON o_custkey = c_custkey
  JOIN supplier s ON l_suppkey = s_suppkey),
fl AS (
  SELECT
    CAST(o_orderdate AS DATE) AS full_date,
    CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
    CAST(year(o_orderdate) AS INTEGER) AS "YEAR",
    CAST(month(o_orderdate) AS INTEGER) AS "MONTH",
    CAST(day(o_orderdate) AS INTEGER) AS "DAY",
    CAST(isodow(o_orderdate) AS INTEGER) AS DAY_OF_WEEK,
    CAST(l_suppkey AS VARCHAR) AS AIRLINE,
    CAST(l_partkey AS VARCHAR) AS FLIGHT_NUMBER,
    'N' || CAST(l_partkey AS VARCHAR) AS TAIL_NUMBER,
    n1.n_name AS ORIGIN_AIRPORT,
    n2.n_name AS DESTINATION_AIRPORT,
    CAST(CASE WHEN NOT is_canc THEN dep0 END AS DOUBLE) AS DEPARTURE_DELAY,
    CAST(floor(l_extendedprice / 100) AS DOUBLE) AS DISTANCE,
    CAST(CASE WHEN NOT is_canc AND NOT is_dv THEN arr0 END AS DOUBLE) AS ARRIVAL_DELAY,
    CAST(is_dv AS INTEGER) AS DIVERTED,
    CAST(is_canc AS INTEGER) AS CANCELLED,
    CASE WHEN is_canc THEN 'B' END AS CANCELLATION_REASON,
    CAST(CASE WHEN NOT is_canc AND NOT is_dv AND arr0 > 15 THEN l_partkey % 11 END AS DOUBLE)
      AS AIR_SYSTEM_DELAY,
    CAST(CASE WHEN NOT is_canc AND NOT is_dv AND arr0 > 15 THEN CAST(l_quantity AS INT) % 7 END
      AS DOUBLE) AS SECURITY_DELAY,
    CAST(CASE WHEN NOT is_canc AND NOT is_dv AND arr0 > 15 THEN l_linenumber END AS DOUBLE)
      AS AIRLINE_DELAY,
    CAST(CASE WHEN NOT is_canc AND NOT is_dv AND arr0 > 15 THEN CAST(round(l_tax * 100) AS INT) END
      AS DOUBLE) AS LATE_AIRCRAFT_DELAY,
    CAST(CASE WHEN NOT is_canc AND NOT is_dv AND arr0 > 15
      THEN CAST(round(l_discount * 100) AS INT) END AS DOUBLE) AS WEATHER_DELAY,
    'AC' || CAST(l_partkey AS VARCHAR) AS AIRCRAFT_ID,
    'MODEL-' || CAST(l_partkey % 13 AS VARCHAR) AS MODEL,
    s_name AS airline_name,
    n1.n_name AS origin_name, n2.n_name AS dest_name,
    r1.r_name AS origin_state,
    CAST(n1.n_nationkey AS DOUBLE) AS origin_lat, CAST(n1.n_regionkey AS DOUBLE) AS origin_lon
  FROM base
  JOIN nation n1 ON s_nationkey = n1.n_nationkey
  JOIN nation n2 ON c_nationkey = n2.n_nationkey
  LEFT JOIN region r1 ON n1.n_regionkey = r1.r_regionkey),
dd AS (
  SELECT DISTINCT full_date, date_key,
    CAST(year(full_date) AS INTEGER) AS year,
    CAST(quarter(full_date) AS INTEGER) AS quarter,
    CAST(month(full_date) AS INTEGER) AS month,
    monthname(full_date) AS month_name,
    CAST(weekofyear(full_date) AS INTEGER) AS week,
    CAST(day(full_date) AS INTEGER) AS day,
    dayname(full_date) AS day_name,
    isodow(full_date) >= 6 AS is_weekend
  FROM fl),
apt AS (
  SELECT DISTINCT code AS airport_code FROM (
    SELECT ORIGIN_AIRPORT AS code FROM fl UNION ALL SELECT DESTINATION_AIRPORT FROM fl)),
air AS (SELECT DISTINCT AIRLINE AS airline_code, airline_name FROM fl),
dim_air AS (
  SELECT CAST(row_number() OVER (ORDER BY airline_code) AS INTEGER) AS airline_key,
         airline_code, airline_name FROM air),
dim_apt AS (
  SELECT CAST(row_number() OVER (ORDER BY a.airport_code) AS INTEGER) AS airport_key,
         a.airport_code, n.n_name AS airport_name, n.n_name AS city, r.r_name AS state,
         r.r_name AS country, CAST(n.n_nationkey AS DOUBLE) AS latitude,
         CAST(n.n_regionkey AS DOUBLE) AS longitude
  FROM apt a LEFT JOIN nation n ON a.airport_code = n.n_name
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
roles AS (
  SELECT ORIGIN_AIRPORT AS code FROM fl UNION ALL SELECT DESTINATION_AIRPORT AS code FROM fl),
rf AS (
  SELECT "YEAR", "MONTH", "DAY", DAY_OF_WEEK, AIRLINE, FLIGHT_NUMBER, TAIL_NUMBER,
    ORIGIN_AIRPORT, DESTINATION_AIRPORT, DEPARTURE_DELAY, DISTANCE, ARRIVAL_DELAY, DIVERTED,
    CANCELLED, CANCELLATION_REASON, AIR_SYSTEM_DELAY, SECURITY_DELAY, AIRLINE_DELAY,
    LATE_AIRCRAFT_DELAY, WEATHER_DELAY, AIRCRAFT_ID, MODEL
  FROM fl),
tf AS (
  SELECT * REPLACE (
    CASE WHEN CANCELLED = 1 THEN 'N/A' ELSE CAST(DEPARTURE_DELAY AS VARCHAR) END AS DEPARTURE_DELAY,
    CASE WHEN DIVERTED = 1 THEN 'nan' ELSE CAST(ARRIVAL_DELAY AS VARCHAR) END AS ARRIVAL_DELAY,
    CAST(AIR_SYSTEM_DELAY AS VARCHAR) AS AIR_SYSTEM_DELAY,
    CAST(SECURITY_DELAY AS VARCHAR) AS SECURITY_DELAY,
    CAST(AIRLINE_DELAY AS VARCHAR) AS AIRLINE_DELAY,
    CAST(LATE_AIRCRAFT_DELAY AS VARCHAR) AS LATE_AIRCRAFT_DELAY,
    CAST(WEATHER_DELAY AS VARCHAR) AS WEATHER_DELAY)
  FROM rf)
"""

# Raw flight columns and whether they are floating point (NaN counts as missing).
RAW_COLUMNS = [
    ("YEAR", False), ("MONTH", False), ("DAY", False), ("DAY_OF_WEEK", False),
    ("AIRLINE", False), ("FLIGHT_NUMBER", False), ("TAIL_NUMBER", False),
    ("ORIGIN_AIRPORT", False), ("DESTINATION_AIRPORT", False), ("DEPARTURE_DELAY", True),
    ("DISTANCE", True), ("ARRIVAL_DELAY", True), ("DIVERTED", False), ("CANCELLED", False),
    ("CANCELLATION_REASON", False), ("AIR_SYSTEM_DELAY", True), ("SECURITY_DELAY", True),
    ("AIRLINE_DELAY", True), ("LATE_AIRCRAFT_DELAY", True), ("WEATHER_DELAY", True),
    ("AIRCRAFT_ID", False), ("MODEL", False),
]
STRING_COLUMNS = {"AIRLINE", "FLIGHT_NUMBER", "TAIL_NUMBER", "ORIGIN_AIRPORT",
                  "DESTINATION_AIRPORT", "CANCELLATION_REASON", "AIRCRAFT_ID", "MODEL"}


def q(c: str) -> str:
    """Quoted identifier."""
    return f'"{c}"'



def with_flights(sql: str) -> str:
    """Prefix a query that reads ``fl``/``dd``/``apt``/``air`` with the binding CTEs.

    ``sql`` must start with further CTE definitions (``name AS (...)``,
    comma-separated) followed by the final SELECT, or with SELECT directly.
    """
    s = sql.strip()
    if s.upper().startswith("SELECT"):
        return f"WITH {FLIGHTS_CTE}\n{s}"
    return f"WITH {FLIGHTS_CTE},\n{s}"


RUNLOG_CTE = """
ph0 AS (
  SELECT 'run-' || strftime(ts, '%Y%m%d') AS run_id, event_type AS phase_name,
    strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS start_time,
    strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS end_time,
    round(sum(value), 4) AS duration_seconds, max(value) AS mx, count(*) AS n,
    count_if(event_type <> 'error') AS ok
  FROM events GROUP BY 1, 2),
ph AS (
  SELECT CAST(row_number() OVER (PARTITION BY run_id ORDER BY start_time, phase_name) AS BIGINT)
      AS id, run_id, phase_name,
    CASE WHEN mx >= 400 THEN 'FAILED' WHEN mx >= 300 THEN 'WARNING' ELSE 'SUCCESS' END AS status,
    duration_seconds, start_time, end_time, n, ok
  FROM ph0),
runs AS (
  SELECT run_id, min(start_time) AS run_timestamp,
    CASE WHEN count_if(status = 'FAILED') > 0 THEN 'FAILED'
         WHEN count_if(status = 'WARNING') > 0 THEN 'WARNING' ELSE 'SUCCESS' END AS overall_status,
    round(sum(duration_seconds), 4) AS total_duration,
    CAST(sum(ok) AS DOUBLE) * 100.0 / sum(n) AS dq_score, CAST(sum(n) AS BIGINT) AS records_loaded
  FROM ph GROUP BY run_id)
"""


def with_runlog(sql: str) -> str:
    s = sql.strip()
    if s.upper().startswith("SELECT"):
        return f"WITH {RUNLOG_CTE}\n{s}"
    return f"WITH {RUNLOG_CTE},\n{s}"
