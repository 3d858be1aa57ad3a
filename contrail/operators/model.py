"""Modelling: dimension members, surrogate keys, key mapping, star schema.

Scale notes
-----------
* Members are ``distinct`` over the code columns: partial aggregation before
  the shuffle, so only distinct codes move, however skewed the fact; the batch
  build takes the members of both dimensions in one scan (``all_members``).
* Code -> key lookups and dimension enrichment broadcast a side only when its
  row count is known (counted after materialising) and the size estimated from
  it is below ``BROADCAST_MAX_BYTES``; otherwise Spark/AQE choose (sort-merge,
  skew split).
* Surrogate keys of a load's new members follow the largest known key in code order
  (``operators/keys.py``); known members keep theirs.
* A load's tables become visible together (``sources/warehouse.py``); only the years that it
  holds are rewritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.ranking import dense_keys
from contrail.functions.scalar import date_from_key, one_row
from contrail.operators.keys import register, registry
from contrail.plans import aggregates
from contrail.sources.warehouse import Load, Warehouse
from contrail.spec import FACT_DROP, FLIGHT_SPEC, FactSpec, Star, Tables

# Largest side (estimated bytes) we broadcast by hint; a string counts as so many bytes.
BROADCAST_MAX_BYTES = 32 << 20
STRING_BYTES = 64


def row_bytes(df: DataFrame) -> int:
    """Estimated bytes of a row: 16 and 8 a column, more for strings."""
    return 16 + sum(STRING_BYTES if f.dataType.typeName() == "string" else 8 for f in df.schema)


def bounded(df: DataFrame, rows: int | None) -> DataFrame:
    """Broadcast hint only behind a known row count and the size that follows from it."""
    return F.broadcast(df) if rows is not None and rows * row_bytes(df) <= BROADCAST_MAX_BYTES else df


# --------------------------------------------------------------------------- C6, C7, H2
def members(df: DataFrame, cols, out: str = "code") -> DataFrame:
    """Distinct non-null codes found in one or more columns (one scan).

    Two roles (origin, destination) are read in one pass with
    ``explode(array(o, d))`` instead of scanning the fact twice.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing member column(s): {missing}")
    if len(cols) == 1:
        m = df.select(F.col(cols[0]).alias(out))
    else:
        m = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(out))
    return m.where(F.col(out).isNotNull()).distinct()


# --------------------------------------------------------------------------- C8
def surrogate_keys(mem: DataFrame, code: str = "code", key: str = "key") -> DataFrame:
    """Keys 1..n in code order (deterministic; the reference used arrival order)."""
    return dense_keys(mem, code, key)


# --------------------------------------------------------------------------- C9
def map_keys(df: DataFrame, lookups, on_unmatched: str = "keep") -> DataFrame:
    """Replace natural codes by surrogate keys.

    ``lookups``: list of ``(code_col, keyed_members, member_code, member_key,
    new_col, rows)``; ``rows`` is the member count if known (broadcast bound).
    ``on_unmatched``: "keep" (NULL key), "raise" (ValueError with counts; one
    aggregate job) or "drop" (inner join semantics).
    """
    out = df
    for code_col, keyed, m_code, m_key, new_col, rows in lookups:
        lk = keyed.select(F.col(m_code).alias(f"__c_{new_col}"), F.col(m_key).alias(new_col))
        how = "inner" if on_unmatched == "drop" else "left"
        out = out.join(bounded(lk, rows), out[code_col] == lk[f"__c_{new_col}"], how).drop(
            f"__c_{new_col}")
    if on_unmatched == "raise":
        new_cols = [lk[4] for lk in lookups]
        row = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in new_cols]).first()
        bad = {c: row[c] for c in new_cols if row[c]}
        if bad:
            raise ValueError(f"unmatched natural keys (rows per key column): {bad}")
    return out


def unmatched(df: DataFrame, code_col: str, keyed: DataFrame, m_code: str) -> DataFrame:
    """Distinct codes of ``df`` without a member (left_anti)."""
    return (df.select(F.col(code_col).alias("code")).where(F.col("code").isNotNull()).distinct()
            .join(keyed.select(F.col(m_code).alias("code")), "code", "left_anti"))


# --------------------------------------------------------------------------- C10
def normalize(df: DataFrame, spec: FactSpec = FLIGHT_SPEC, on_unmatched: str = "keep",
              airline_rows: int | None = None, airport_rows: int | None = None) -> Tables:
    """Normalized layer: airlines(AIRLINE_ID, AIRLINE), airports(AIRPORT_ID,
    AIRPORT) and flights keyed by ids (natural codes dropped)."""
    airlines = surrogate_keys(members(df, spec.carrier, "AIRLINE"), "AIRLINE", "AIRLINE_ID")
    airports = surrogate_keys(members(df, [spec.origin, spec.destination], "AIRPORT"),
                              "AIRPORT", "AIRPORT_ID")
    keyed = map_keys(df, [
        (spec.carrier, airlines, "AIRLINE", "AIRLINE_ID", "AIRLINE_ID", airline_rows),
        (spec.origin, airports, "AIRPORT", "AIRPORT_ID", "ORIGIN_AIRPORT_ID", airport_rows),
        (spec.destination, airports, "AIRPORT", "AIRPORT_ID", "DESTINATION_AIRPORT_ID",
         airport_rows),
    ], on_unmatched=on_unmatched)
    flights = keyed.drop(spec.carrier, spec.origin, spec.destination)
    return Tables(airlines=airlines, airports=airports, flights=flights)


# --------------------------------------------------------------------------- C11, C12, E5
def enrich_dim(dim: DataFrame, ref: DataFrame, on: tuple, select: list,
               ref_rows: int | None = None) -> DataFrame:
    """Left-join reference attributes onto members, then rename/project.

    ``on`` = (dim_col, ref_col); ``select`` = list of (source_col, out_name).
    Members missing from the reference keep NULL attributes (S10).
    """
    d_col, r_col = on
    j = dim.join(bounded(ref, ref_rows), dim[d_col] == ref[r_col], "left")
    return j.select(*[F.col(s).alias(o) for s, o in select])


def dim_airport(airports: DataFrame, ref: DataFrame, ref_rows: int | None = None) -> DataFrame:
    r = ref.select(F.col("IATA_CODE"), F.col("AIRPORT").alias("REF_AIRPORT"), "CITY", "STATE",
                   "COUNTRY", "LATITUDE", "LONGITUDE")
    return enrich_dim(airports, r, ("AIRPORT", "IATA_CODE"), [
        ("AIRPORT_ID", "airport_key"), ("IATA_CODE", "airport_code"),
        ("REF_AIRPORT", "airport_name"), ("CITY", "city"), ("STATE", "state"),
        ("COUNTRY", "country"), ("LATITUDE", "latitude"), ("LONGITUDE", "longitude")],
        ref_rows)


def dim_airline(airlines: DataFrame, ref: DataFrame, ref_rows: int | None = None) -> DataFrame:
    r = ref.select(F.col("IATA_CODE"), F.col("AIRLINE").alias("REF_AIRLINE"))
    return enrich_dim(airlines, r, ("AIRLINE", "IATA_CODE"), [
        ("AIRLINE_ID", "airline_key"), ("IATA_CODE", "airline_code"),
        ("REF_AIRLINE", "airline_name")], ref_rows)


# --------------------------------------------------------------------------- C13, I7
def date_attributes(d: Column) -> list[Column]:
    return [
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    ]


def date_dim(fact: DataFrame, key: str = "date_key") -> DataFrame:
    """Date dimension from the distinct fact dates."""
    keys = fact.select(F.col(key).alias("date_key")).where(F.col("date_key").isNotNull()).distinct()
    d = date_from_key("date_key")
    return keys.select(d.alias("full_date"), F.col("date_key").cast("int").alias("date_key"),
                       *date_attributes(d))


# --------------------------------------------------------------------------- C14
def fact_table(flights: DataFrame, spec: FactSpec = FLIGHT_SPEC) -> DataFrame:
    """Warehouse fact: date_key, renamed keys, redundant columns dropped."""
    f = flights.withColumn(
        "date_key",
        (F.col(spec.year) * 10000 + F.col(spec.month) * 100 + F.col(spec.day)).cast("int"))
    f = f.withColumnsRenamed({"AIRLINE_ID": "airline_key",
                              "ORIGIN_AIRPORT_ID": "origin_airport_key",
                              "DESTINATION_AIRPORT_ID": "dest_airport_key"})
    return f.drop(*[c for c in FACT_DROP if c in f.columns])


def build_star(tables: Tables, airlines_ref: DataFrame, airports_ref: DataFrame,
               spec: FactSpec = FLIGHT_SPEC, ref_rows: dict | None = None) -> Star:
    """Star schema from the normalized layer and the two reference files (lazy)."""
    ref_rows = ref_rows or {}
    fact = fact_table(tables.flights, spec)
    return Star(
        fact=fact,
        dim_airline=dim_airline(tables.airlines, airlines_ref, ref_rows.get("airlines")),
        dim_airport=dim_airport(tables.airports, airports_ref, ref_rows.get("airports")),
        dim_date=date_dim(fact),
    )


FACT = "fact_flights"
DIMENSIONS = ("dim_airline", "dim_airport", "dim_date")


def with_year(fact: DataFrame) -> DataFrame:
    """The fact with its partition column, derived from ``date_key``."""
    return fact if "year" in fact.columns else fact.withColumn("year", (F.col("date_key") / 10000).cast("int"))


def stage_star(load: Load, star: Star, replace_all: bool = False, aggregates_: bool = True) -> None:
    """Stages the four tables (A7) in a load. The fact is partitioned by year, so that date predicates prune
    directories, and only the years that it holds are replaced (all, with ``replace_all``). The date
    dimension takes the dates of the fact as written (a scan of one column) and keeps those of the other years; the
    additive aggregates (``plans/aggregates.py``) are made from the fact as written, too."""
    before = load.warehouse.read("dim_date") if load.before and not replace_all and "dim_date" in load.warehouse._folders() else None
    fact = load.write(FACT, with_year(star.fact), "year", replace_all)
    load.write("dim_airline", star.dim_airline)
    load.write("dim_airport", star.dim_airport)
    dates = date_dim(fact)
    if before is not None:
        years = fact.select("year").distinct()
        dates = dates.unionByName(before.join(years, "year", "left_anti").select(dates.columns))
    load.write("dim_date", dates)
    if aggregates_:
        load.write(aggregates.TABLE, aggregates.aggregate(fact), "year", replace_all)  # the years' rows are replaced, so are their sums


def write_star(star: Star, path: str) -> None:
    """Publishes the four tables as a new version of the warehouse at ``path``; readers see all of them or none."""
    load = Warehouse(star.fact.sparkSession, path).begin(f"star-{uuid.uuid4().hex[:12]}")
    stage_star(load, star, replace_all=True)
    load.commit()


def read_star(spark, path: str, version: int | None = None) -> Star:
    """The star of a published version (the newest, if not given); dimension row counts come from Parquet metadata."""
    tables = Warehouse(spark, path).read_all(version)
    missing = [t for t in (FACT, *DIMENSIONS) if t not in tables]
    if missing:
        raise ValueError(f"no published star in {path}: {missing}")
    dims = {n: tables[n] for n in DIMENSIONS}
    counted = one_row(*[d.agg(F.count(F.lit(1)).alias(n)) for n, d in dims.items()]).first()
    return Star(fact=tables[FACT], rows={n: counted[n] for n in dims}, agg=tables.get(aggregates.TABLE), **dims)  # one job for the three counts


def normalized(spark, path: str, star: Star) -> Tables:
    """Normalized layer (C10) of a warehouse: members with ids, and the star's fact under the normalized names."""
    keyed = read_keys(spark, path)
    return Tables(airlines=keyed["airlines"], airports=keyed["airports"], agg=star.agg,
                  flights=star.fact.withColumnsRenamed({"airline_key": "AIRLINE_ID", "origin_airport_key": "ORIGIN_AIRPORT_ID", "dest_airport_key": "DESTINATION_AIRPORT_ID"}),
                  counts={"airlines": star.rows["dim_airline"], "airports": star.rows["dim_airport"]})


def append_flights(spark, df: DataFrame, path: str, airlines_ref: DataFrame, airports_ref: DataFrame, load_id: str,
                   removed: DataFrame | None = None, spec: FactSpec = FLIGHT_SPEC) -> Star:
    """A load that adds flights to the years they belong to and takes ``removed`` ones (flights, every column as
    loaded, each row once) away. Years that only gain get files beside those they have; years that lose rows are
    rewritten. The aggregates take the signed delta of these rows; nothing else of the fact is read for them."""
    warehouse = Warehouse(spark, path)
    if warehouse.committed(load_id):
        return read_star(spark, path)
    load = warehouse.begin(load_id)
    live = warehouse.read_all() if load.before else {}
    tables = keyed_tables(load, df if removed is None else df.unionByName(removed), spec)

    def keyed(flights: DataFrame) -> DataFrame:
        return with_year(fact_table(key_flights(flights, tables, spec), spec))

    def years(rows: DataFrame) -> list:
        return [r["year"] for r in rows.select("year").distinct().collect()]  # a row a year

    added, gone = keyed(df), keyed(removed) if removed is not None else None
    losing = years(gone) if gone is not None and FACT in live else []
    if losing:
        rest = live[FACT].where(F.col("year").isin(losing)).exceptAll(gone.select(live[FACT].columns))
        load.write(FACT, rest.unionByName(added.where(F.col("year").isin(losing))), "year", parts=losing)
    load.write(FACT, added.where(~F.coalesce(F.col("year").isin(losing), F.lit(False))), "year", append=True)
    touched = sorted({*years(added), *losing} - {None})
    before = live[aggregates.TABLE].where(F.col("year").isin(touched)) if aggregates.TABLE in live else None
    load.write(aggregates.TABLE, aggregates.merged(before, added, gone if losing else None), "year", parts=touched)
    dates = date_dim(added)
    if "dim_date" in live:
        known = live["dim_date"]
        dates = known.unionByName(dates.join(known.select("date_key"), "date_key", "left_anti").select(known.columns))
    load.write("dim_airline", dim_airline(tables.airlines, airlines_ref))
    load.write("dim_airport", dim_airport(tables.airports, airports_ref))
    load.write("dim_date", dates)
    load.commit()
    return read_star(spark, path)


def load_star(spark, df: DataFrame, path: str, airlines_ref: DataFrame, airports_ref: DataFrame, load_id: str,
              spec: FactSpec = FLIGHT_SPEC, on_unmatched: str = "keep", aggregates_: bool = True) -> Star:
    """C6-C14 and A7 as one load: cleaned flights ``df`` into the warehouse at ``path``.

    Members that earlier loads know keep their keys, new ones follow; the years that ``df`` holds are replaced,
    the other years' files stay. Everything becomes visible with one manifest. A load that was
    committed before (``load_id``) changes nothing.
    """
    warehouse = Warehouse(spark, path)
    if not warehouse.committed(load_id):
        load = warehouse.begin(load_id)
        tables = keyed_tables(load, df, spec, on_unmatched)
        stage_star(load, build_star(tables, airlines_ref, airports_ref, spec), aggregates_=aggregates_)
        load.commit()
    return read_star(spark, path)


# --------------------------------------------------------------------------- C15
def unpivot_causes(wide: DataFrame, cols: list, labels: list, ids=(),
                   var: str = "category", val: str = "avg_minutes") -> DataFrame:
    """Wide -> long with relabelled categories (``melt`` + ``replace``)."""
    renamed = wide.select(*ids, *[F.col(c).alias(lbl) for c, lbl in zip(cols, labels)])
    return renamed.unpivot(list(ids), labels, var, val)


def all_members(df: DataFrame, spec: FactSpec = FLIGHT_SPEC) -> DataFrame:
    """C6 + C7 in ONE scan: ``(dim, code)`` for airlines and airports, distinct."""
    return (df.select(F.explode(F.array(
        F.struct(F.lit("airlines").alias("dim"), F.col(spec.carrier).cast("string").alias("code")),
        F.struct(F.lit("airports").alias("dim"), F.col(spec.origin).cast("string").alias("code")),
        F.struct(F.lit("airports").alias("dim"),
                 F.col(spec.destination).cast("string").alias("code")))).alias("m"))
        .select("m.*").where(F.col("code").isNotNull()).distinct())


#: Names of the normalized dimensions: dimension, column of the code, column of the id.
NORMALIZED = (("airlines", "AIRLINE", "AIRLINE_ID"), ("airports", "AIRPORT", "AIRPORT_ID"))


def _by_dimension(keys: DataFrame) -> dict:
    return {dim: keys.where(F.col("dim") == dim).select(F.col("code").alias(code), F.col("key").alias(key))
            for dim, code, key in NORMALIZED}


def read_keys(spark, path: str) -> dict:
    """Normalized dimensions of the warehouse at ``path``: airlines(AIRLINE, AIRLINE_ID) and airports(AIRPORT, AIRPORT_ID)."""
    return _by_dimension(registry(Warehouse(spark, path)))


def keyed_tables(load: Load, df: DataFrame, spec: FactSpec = FLIGHT_SPEC, on_unmatched: str = "keep") -> Tables:
    """C10 in a load: members of both dimensions from one scan of ``df``, their keys looked up or numbered
    (``keys.register``), natural codes replaced. The members' counts bound every later broadcast.

    Members come from ``df`` itself, so every non-null code matches; NULL
    codes get NULL keys (``keep``), which the load check (K10) on the
    written fact reports -- no extra pass. ``raise`` adds that pass here.
    """
    current, count = register(load, all_members(df, spec))
    counts = {dim: count.get(dim, 0) for dim, _, _ in NORMALIZED}
    keyed = _by_dimension(current)
    tables = Tables(airlines=keyed["airlines"], airports=keyed["airports"], flights=df, counts=counts)
    tables.flights = key_flights(df, tables, spec, on_unmatched)
    return tables


def key_flights(df: DataFrame, tables: Tables, spec: FactSpec = FLIGHT_SPEC, on_unmatched: str = "keep") -> DataFrame:
    """Flights with ids in place of natural codes."""
    airports = (tables.airports, "AIRPORT", "AIRPORT_ID")
    return map_keys(df, [
        (spec.carrier, tables.airlines, "AIRLINE", "AIRLINE_ID", "AIRLINE_ID", tables.counts.get("airlines")),
        (spec.origin, *airports, "ORIGIN_AIRPORT_ID", tables.counts.get("airports")),
        (spec.destination, *airports, "DESTINATION_AIRPORT_ID", tables.counts.get("airports")),
    ], on_unmatched=on_unmatched).drop(spec.carrier, spec.origin, spec.destination)


def normalize_written(spark, df: DataFrame, path: str, spec: FactSpec = FLIGHT_SPEC,
                      on_unmatched: str = "keep") -> Tables:
    """C10 alone: the keys of ``df``'s members are published in the warehouse at ``path``; flights are keyed lazily."""
    load = Warehouse(spark, path).begin(f"keys-{uuid.uuid4().hex[:12]}")
    tables = keyed_tables(load, df, spec, on_unmatched)
    load.commit()
    return tables
