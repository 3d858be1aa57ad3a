"""Column roles, result containers, schemas and fixed presets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
# The seven delay columns validated as numeric (C3/C4/K3), in this order:
DELAY_COLUMNS = [
    "DEPARTURE_DELAY",
    "ARRIVAL_DELAY",
    "AIR_SYSTEM_DELAY",
    "SECURITY_DELAY",
    "AIRLINE_DELAY",
    "LATE_AIRCRAFT_DELAY",
    "WEATHER_DELAY",
]
# Quality-score deductions (B6) and grade thresholds (B7):
MISSING_MULTIPLIER = 0.5
MISSING_MAX = 30
DUPLICATE_MULTIPLIER = 0.5
DUPLICATE_MAX = 20
TYPE_ISSUES_MAX = 10
TYPE_ISSUE_PER_COLUMN_MAX = 2
TYPE_ISSUE_FRACTION_WEIGHT = 10
GRADES = [(90, "Excellent"), (75, "Good"), (60, "Fair"), (0, "Poor")]
# Fill value for missing text (C1) and the auto columns ignored by the schema diff (B9):
TEXT_FILL = "UNKNOWN"
AUTO_COLUMNS = ("FLIGHT_ID", "CREATED_AT")
# Columns dropped from the warehouse fact (C14):
FACT_DROP = ["YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "CREATED_AT", "date_str", "FLIGHT_ID"]
# Route label separators: batch KPI (F13) and interactive table (F29):
ROUTE_ARROW_BATCH = " → "
ROUTE_ARROW_TABLE = " -> "
# Delay causes of the long form (C15, F22/F30), in display order: label, fact column:
CAUSES = [
    ("Weather", "WEATHER_DELAY"),
    ("Airline", "AIRLINE_DELAY"),
    ("Security", "SECURITY_DELAY"),
    ("NAS", "AIR_SYSTEM_DELAY"),
    ("Late Aircraft", "LATE_AIRCRAFT_DELAY"),
]
# Sparse columns left out of the completeness score (K7):
SPARSE_COLUMNS = [
    "CANCELLATION_REASON",
    "AIR_SYSTEM_DELAY",
    "SECURITY_DELAY",
    "AIRLINE_DELAY",
    "LATE_AIRCRAFT_DELAY",
    "WEATHER_DELAY",
]
# Data-quality matrix status bands (K12) and score labels (K13):
MATRIX_WARN_BELOW = 10
MATRIX_LABELS = [(95, "EXCELLENT"), (80, "GOOD"), (60, "FAIR"), (None, "CRITICAL")]
# Freshness bands in hours and their labels (K14), health labels (K15):
FRESH_HOURS = 24
AGING_HOURS = 72
FRESH_LABEL, AGING_LABEL, STALE_LABEL, UNKNOWN_LABEL = "Fresh", "Aging", "Stale", "Unknown"
HEALTH_LABELS = {"SUCCESS": "HEALTHY", "WARNING": "WARNING"}
# Day-type labels (F34):
WEEKDAY_LABEL, WEEKEND_LABEL = "Weekday", "Weekend"
# The 12 rules of the data-quality matrix (K12), in order: rule, records-checked measure, failures measure:
MATRIX_RULES = [
    ("Null Airline Keys", "fact_rows", "null_airline_key"),
    ("Null Origin Airport Keys", "fact_rows", "null_origin_airport_key"),
    ("Null Dest Airport Keys", "fact_rows", "null_dest_airport_key"),
    ("Null Date Keys", "fact_rows", "null_date_key"),
    ("Orphan Airline Refs", "fact_rows", "orphan_airline_key"),
    ("Orphan Origin Refs", "fact_rows", "orphan_origin_airport_key"),
    ("Orphan Dest Refs", "fact_rows", "orphan_dest_airport_key"),
    ("Orphan Date Refs", "fact_rows", "orphan_date_key"),
    ("Duplicate Airline Keys", "rows_airline", "dup_airline"),
    ("Duplicate Airport Keys", "rows_airport", "dup_airport"),
    ("Departure Delay Nulls", "fact_rows", "null_dep"),
    ("Arrival Delay Nulls", "fact_rows", "null_arr"),
]

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()

AIRLINES_SCHEMA = T.StructType([T.StructField("IATA_CODE", S), T.StructField("AIRLINE", S)])

AIRPORTS_SCHEMA = T.StructType(
    [T.StructField(n, S) for n in ["IATA_CODE", "AIRPORT", "CITY", "STATE", "COUNTRY"]]
    + [T.StructField("LATITUDE", D), T.StructField("LONGITUDE", D)]
)

# Raw / cleaned flights file: natural keys, no surrogate ids.
_FLIGHT_FIELDS = [
    ("YEAR", I), ("MONTH", I), ("DAY", I), ("DAY_OF_WEEK", I),
    ("AIRLINE", S), ("FLIGHT_NUMBER", S), ("TAIL_NUMBER", S),
    ("ORIGIN_AIRPORT", S), ("DESTINATION_AIRPORT", S),
    ("SCHEDULED_DEPARTURE", I), ("DEPARTURE_TIME", I), ("DEPARTURE_DELAY", D),
    ("TAXI_OUT", D), ("WHEELS_OFF", I), ("SCHEDULED_TIME", D), ("ELAPSED_TIME", D),
    ("AIR_TIME", D), ("DISTANCE", D), ("WHEELS_ON", I), ("TAXI_IN", D),
    ("SCHEDULED_ARRIVAL", I), ("ARRIVAL_TIME", I), ("ARRIVAL_DELAY", D),
    ("DIVERTED", I), ("CANCELLED", I), ("CANCELLATION_REASON", S),
    ("AIR_SYSTEM_DELAY", D), ("SECURITY_DELAY", D), ("AIRLINE_DELAY", D),
    ("LATE_AIRCRAFT_DELAY", D), ("WEATHER_DELAY", D),
    ("AIRCRAFT_ID", S), ("AIRCRAFT_TYPE", S), ("MANUFACTURER", S), ("MODEL", S),
]
FLIGHTS_SCHEMA = T.StructType([T.StructField(n, t) for n, t in _FLIGHT_FIELDS])

# Normalized fact: natural keys replaced by surrogate ids.
NORMALIZED_FLIGHTS_COLUMNS = (
    ["YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "FLIGHT_NUMBER",
     "AIRLINE_ID", "ORIGIN_AIRPORT_ID", "DESTINATION_AIRPORT_ID"]
    + [n for n, _ in _FLIGHT_FIELDS
       if n not in ("YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "FLIGHT_NUMBER",
                    "AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT")]
)
NORMALIZED_FLIGHTS_SCHEMA = T.StructType(
    [T.StructField("FLIGHT_ID", T.LongType())]
    # the three *_ID keys are not flight-file columns: they default to int
    + [T.StructField(n, dict(_FLIGHT_FIELDS).get(n, I)) for n in NORMALIZED_FLIGHTS_COLUMNS]
    + [T.StructField("CREATED_AT", T.TimestampType())]
)

RUN_PHASE_SCHEMA = T.StructType([
    T.StructField("phase_name", S), T.StructField("status", S),
    T.StructField("start_time", S), T.StructField("end_time", S),
    T.StructField("duration_seconds", D), T.StructField("error_message", S),
])
RUN_METADATA_SCHEMA = T.StructType([
    T.StructField("pipeline_name", S), T.StructField("pipeline_version", S),
    T.StructField("run_id", S), T.StructField("run_timestamp", S),
    T.StructField("total_duration_seconds", D), T.StructField("overall_status", S),
    T.StructField("phases", T.ArrayType(RUN_PHASE_SCHEMA)),
])


# ---------------------------------------------------------------------------
# Column roles
# ---------------------------------------------------------------------------
# Fact columns of the star (fixed by the warehouse build, C14):
DEP = "DEPARTURE_DELAY"
ARR = "ARRIVAL_DELAY"
CANC = "CANCELLED"
DIVR = "DIVERTED"
DIST = "DISTANCE"


@dataclass(frozen=True)
class FactSpec:
    """Which column of a flight-shaped fact plays which role."""

    carrier: str = "AIRLINE"
    origin: str = "ORIGIN_AIRPORT"
    destination: str = "DESTINATION_AIRPORT"
    year: str = "YEAR"
    month: str = "MONTH"
    day: str = "DAY"
    flight_no: str = "FLIGHT_NUMBER"
    cancelled: str = "CANCELLED"
    diverted: str = "DIVERTED"
    dep_delay: str = "DEPARTURE_DELAY"
    arr_delay: str = "ARRIVAL_DELAY"
    distance: str = "DISTANCE"
    # label -> column; the long-form labels of C15.
    cause_delays: tuple = tuple(CAUSES)
    # Presets of the reference
    delayed_gt: float = 15
    min_departures: int = 50
    min_route_flights: int = 20
    early_limit: float = -60
    max_outliers: int = 5

    @property
    def causes(self) -> dict:
        return dict(self.cause_delays)


FLIGHT_SPEC = FactSpec()


@dataclass
class Tables:
    """Normalized layer (C10): two small dimensions and the keyed fact."""

    airlines: DataFrame   # AIRLINE_ID, AIRLINE
    airports: DataFrame   # AIRPORT_ID, AIRPORT
    flights: DataFrame    # NORMALIZED_FLIGHTS_COLUMNS
    counts: dict = field(default_factory=dict)
    agg: DataFrame | None = None  # additive aggregates of the flights (plans/aggregates.py)


@dataclass
class Star:
    """Star schema (C11-C14). ``rows`` holds dimension row counts when known;
    joins broadcast a dimension only when its count is known and bounded."""

    fact: DataFrame
    dim_airline: DataFrame
    dim_airport: DataFrame
    dim_date: DataFrame
    rows: dict = field(default_factory=dict)
    agg: DataFrame | None = None  # additive aggregates of the fact (plans/aggregates.py)

    def dim(self, name: str) -> DataFrame:
        return getattr(self, name)
