"""Rule-based data quality (K1-K16) and the KPI audit.

Every check returns rows ``(layer, family, check, checked, failures, status)``
so results union into one table that K9/K13 aggregate. Checks on the same
table are fused into ONE conditional aggregate (the reference ran one query
per rule); orphan checks are left joins against the (counted, bounded)
dimension keys, evaluated in the same fact pass. ``NOT IN`` is rewritten with
explicit null handling (S9): only non-null foreign keys can be orphans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.scalar import count_when, one_row
from contrail.operators.model import bounded
from contrail.operators.profile import distinct_row_count, is_missing
from contrail.session import scratch_path
from contrail.spec import (DELAY_COLUMNS, MATRIX_LABELS, MATRIX_RULES, MATRIX_WARN_BELOW,
                           SPARSE_COLUMNS, Star)

RESULT_COLUMNS = ["layer", "family", "check", "checked", "failures", "status"]


def _rows(wide: DataFrame, layer: str, family: str, items) -> DataFrame:
    """Long result rows from a one-row aggregate.

    ``items``: list of (check name, checked column/expr, failures column/expr,
    status expr taking the failures column).
    """
    structs = []
    for name, checked, failures, status in items:
        fcol = failures if isinstance(failures, Column) else F.col(failures)
        ccol = checked if isinstance(checked, Column) else F.col(checked)
        structs.append(F.struct(F.lit(layer).alias("layer"), F.lit(family).alias("family"),
                                F.lit(name).alias("check"), ccol.cast("bigint").alias("checked"),
                                fcol.cast("bigint").alias("failures"),
                                status(fcol).alias("status")))
    return wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def pass_fail(f: Column) -> Column:
    return F.when(f == 0, "PASS").otherwise("FAIL")


def _absent(names) -> list:
    """FAIL rows for required columns that are missing."""
    return [(f"{n} (column missing)", F.lit(0), F.lit(None).cast("bigint"),
             lambda f: F.lit("FAIL")) for n in names]


# --------------------------------------------------------------------------- K1
def null_check(df: DataFrame, cols=("AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT"),
               layer: str = "raw") -> DataFrame:
    """0 % null threshold on critical columns; a missing column is a FAIL."""
    present = [c for c in cols if c in df.columns]
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[count_when(is_missing(df, c)).alias(f"_null_{c}") for c in present])
    items = [(f"{c} nulls", "_n", f"_null_{c}", pass_fail) for c in present]
    items += _absent([c for c in cols if c not in df.columns])
    return _rows(wide, layer, "null", items)


# --------------------------------------------------------------------------- K2
def duplicate_check(df: DataFrame, keys=None, name: str | None = None,
                    layer: str = "raw") -> DataFrame:
    """Surplus rows over distinct key values (whole rows when ``keys`` is None)."""
    base = df if keys is None else df.select(*keys)
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    uniq = distinct_row_count(base, "_u")
    label = name or ("duplicate rows" if keys is None else f"duplicate {'+'.join(keys)}")
    return _rows(one_row(total, uniq), layer, "duplicate",
                 [(label, "_n", F.col("_n") - F.col("_u"), pass_fail)])


# --------------------------------------------------------------------------- K3
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMERIC = INTEGRAL + (T.FloatType, T.DoubleType, T.DecimalType)


def type_check(df: DataFrame, integral=("YEAR", "MONTH", "DAY"), numeric=DELAY_COLUMNS,
               layer: str = "cleaned") -> DataFrame:
    """Schema conformance (metadata only): integer date parts, numeric delays."""
    spark = df.sparkSession
    rows = []
    for cols, kinds, label in ((integral, INTEGRAL, "integer"), (numeric, NUMERIC, "numeric")):
        for c in cols:
            ok = c in df.columns and isinstance(df.schema[c].dataType, kinds)
            rows.append((layer, "type", f"{c} is {label}", 1, 0 if ok else 1,
                         "PASS" if ok else "FAIL"))
    schema = "layer string, family string, check string, checked bigint, failures bigint, " \
             "status string"
    return spark.createDataFrame(rows, schema)


# --------------------------------------------------------------------------- K4
def rule_check(df: DataFrame, early: float = -60, max_outliers: int = 5,
               dep: str = "DEPARTURE_DELAY", arr: str = "ARRIVAL_DELAY",
               cancelled: str = "CANCELLED", diverted: str = "DIVERTED",
               layer: str = "cleaned") -> DataFrame:
    """Delays >= ``early`` with up to ``max_outliers`` tolerated (WARN), more is
    FAIL; cancellation and diversion rates within [0, 100]."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    items, missing = [], []

    def tolerant(f):
        return F.when(f == 0, "PASS").when(f <= max_outliers, "WARN").otherwise("FAIL")

    for c in (dep, arr):
        if c in df.columns:
            aggs += [F.count(c).alias(f"_nn_{c}"), count_when(F.col(c) < early).alias(f"_v_{c}")]
            items.append((f"{c} >= {early:g}", f"_nn_{c}", f"_v_{c}", tolerant))
        else:
            missing.append(c)
    for c, label in ((cancelled, "cancellation rate in [0, 100]"),
                     (diverted, "diversion rate in [0, 100]")):
        if c in df.columns:
            aggs.append(F.try_divide(F.sum(c).cast("double"), F.count(F.lit(1)).cast("double"))
                        .alias(f"_r_{c}"))
            bad = F.when(F.coalesce(F.col(f"_r_{c}") * 100, F.lit(0.0)).between(0, 100), 0)
            items.append((label, "_n", bad.otherwise(1), pass_fail))
        else:
            missing.append(c)
    wide = df.agg(*aggs)
    return _rows(wide, layer, "business_rule", items + _absent(missing))


# --------------------------------------------------------------------------- K5
def ref_check(df: DataFrame, col: str, ref: DataFrame, ref_col: str = "IATA_CODE",
              on_fail: str = "FAIL", layer: str = "raw") -> DataFrame:
    """File-level integrity: distinct codes of ``col`` absent from the reference."""
    codes = df.select(F.col(col).cast("string").alias("_c")).where(F.col("_c").isNotNull()).distinct()
    known = ref.select(F.col(ref_col).cast("string").alias("_c")).where(F.col("_c").isNotNull())
    miss = codes.join(known, "_c", "left_anti").agg(F.count(F.lit(1)).alias("_m"))
    tot = codes.agg(F.count(F.lit(1)).alias("_d"))
    return _rows(one_row(tot, miss), layer, "reference",
                 [(f"{col} in reference", "_d", "_m",
                   lambda f: F.when(f == 0, "PASS").otherwise(on_fail))])


# --------------------------------------------------------------------------- K6, E9
def orphan_counts(fks) -> list[Column]:
    """Aggregates counting rows whose non-null foreign key has no dimension row.

    ``fks``: list of (fk column, matched-flag column) produced by ``attach_keys``.
    """
    return [count_when(F.col(fk).isNotNull() & F.col(flag).isNull()).alias(f"_orph_{fk}")
            for fk, flag in fks]


def attach_keys(df: DataFrame, lookups) -> tuple[DataFrame, list]:
    """Left-join distinct dimension keys as match flags.

    ``lookups``: list of (fk, dim DataFrame, pk, rows-or-None). Distinct keys
    are joined (NULL keys dropped: S9), broadcast only below a known bound.
    """
    out, flags = df, []
    for fk, dim, pk, rows in lookups:
        flag = f"_hit_{fk}"
        keys = (dim.select(F.col(pk).alias(flag)).where(F.col(flag).isNotNull()).distinct())
        out = out.join(bounded(keys, rows), out[fk] == keys[flag], "left")
        flags.append((fk, flag))
    return out, flags


def orphan_check(df: DataFrame, lookups, layer: str = "warehouse") -> DataFrame:
    """K6: orphan counts for several foreign keys in one pass over ``df``."""
    j, flags = attach_keys(df.select(*[fk for fk, *_ in lookups]), lookups)
    wide = j.agg(F.count(F.lit(1)).alias("_n"), *orphan_counts(flags))
    return _rows(wide, layer, "orphan",
                 [(f"orphan {fk}", "_n", f"_orph_{fk}", pass_fail) for fk, _ in flags])


# --------------------------------------------------------------------------- K7
def dq_scores(raw: DataFrame, cleaned: DataFrame, sparse=SPARSE_COLUMNS, early: float = -60,
              digits: int | None = 1) -> DataFrame:
    """Completeness (dense columns), validity (rows without a delay < early),
    consistency (1 - duplicate rate), overall = mean. Measured values only (S14)."""
    dense = [c for c in raw.columns if c not in sparse]
    comp = raw.agg(F.count(F.lit(1)).alias("_rn"),
                   sum((count_when(is_missing(raw, c)) for c in dense), F.lit(0)).alias("_nulls"))
    inval = cleaned.agg(F.count(F.lit(1)).alias("_cn"), count_when(
        F.coalesce(F.col("DEPARTURE_DELAY") < early, F.lit(False))
        | F.coalesce(F.col("ARRIVAL_DELAY") < early, F.lit(False))).alias("_bad"))
    uniq = distinct_row_count(raw, "_ru")

    def r(x):
        return F.round(x, digits) if digits is not None else x

    j = one_row(comp, inval, uniq)
    c = r((1 - F.col("_nulls") / (F.col("_rn") * len(dense))) * 100)
    v = r((1 - F.col("_bad") / F.col("_cn")) * 100)
    k = r((1 - (F.col("_rn") - F.col("_ru")) / F.col("_rn")) * 100)
    return j.select(c.alias("completeness"), v.alias("validity"), k.alias("consistency")).select(
        "*", r((F.col("completeness") + F.col("validity") + F.col("consistency")) / 3)
        .alias("overall"))


# --------------------------------------------------------------------------- K8
def reconcile(counts: dict) -> DataFrame:
    """raw = cleaned = loaded = published. ``counts``: layer -> DataFrame whose
    row count is the layer count, or (DataFrame, column) holding the published
    count in its first row."""
    out = None
    for layer, src in counts.items():
        if isinstance(src, tuple):
            df, colname = src
            one = df.agg(F.max(F.col(colname)).cast("bigint").alias(layer))
        else:
            one = src.agg(F.count(F.lit(1)).alias(layer))
        out = one if out is None else one_row(out, one)
    names = list(counts)
    equal = F.lit(True)
    for n in names[1:]:
        equal = equal & (F.col(n) == F.col(names[0]))
    return out.withColumn("status", F.when(equal, "PASS").otherwise("FAIL"))


def content_checksums(df: DataFrame, key, columns, buckets: int) -> DataFrame:
    """(bucket, rows, sum_high, sum_low): sums over the rows' hashes by a hash of the key, whatever their order
    or partitions. Both halves of the hash are summed, so repeated rows don't cancel out."""
    h = F.xxhash64(*[F.col(c) for c in columns])
    return (df.select(F.pmod(F.xxhash64(*[F.col(c) for c in key]), F.lit(buckets)).cast("int").alias("bucket"), h.alias("h"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.shiftrightunsigned("h", 32)).alias("sum_high"),
                                   F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("sum_low")))


def reconcile_content(layers: dict, key, columns=None, buckets: int = 4096) -> tuple[DataFrame, DataFrame]:
    """K8 by content: do the layers hold the same rows, not only as many?

    ``layers``: name -> DataFrame; the first is the base. Rows are compared in ``columns`` (default: those of the
    base). Each layer is read once for checksums by key bucket; only rows of differing buckets are then compared
    one by one. Returns ``(status, rows)``: (layer, rows, differing_buckets, status) of each layer but the base, and
    (layer, side, copies, columns..) of the rows that it lacks ("missing") or has beyond the base ("added").
    """
    names = list(layers)
    base, others = layers[names[0]], names[1:]
    key = [key] if isinstance(key, str) else list(key)
    columns = list(columns) if columns is not None else base.columns
    spark, path = base.sparkSession, scratch_path(base.sparkSession, "checksums")
    sums = None
    for n in names:
        one = content_checksums(layers[n], key, columns, buckets).withColumn("layer", F.lit(n))
        sums = one if sums is None else sums.unionByName(one)
    sums.write.parquet(path)  # layers x buckets rows at most
    sums = spark.read.schema(sums.schema).parquet(path)
    measures = ["rows", "sum_high", "sum_low"]
    mine = sums.where(F.col("layer") == names[0]).select("bucket", F.struct(*measures).alias("base"))
    theirs = sums.where(F.col("layer") != names[0]).select("layer", "bucket", F.struct(*measures).alias("own"))
    grid = mine.withColumn("layer", F.explode(F.array(*map(F.lit, others))))
    both = grid.join(theirs, ["layer", "bucket"], "full_outer")
    differing = both.where(~F.col("base").eqNullSafe(F.col("own"))).select("layer", "bucket")
    counted = (both.groupBy("layer").agg(F.coalesce(F.sum("own.rows"), F.lit(0)).alias("rows"),
                                         F.count_if(~F.col("base").eqNullSafe(F.col("own"))).alias("differing_buckets")))
    status = counted.withColumn("status", F.when(F.col("differing_buckets") == 0, "PASS").otherwise("FAIL"))

    rows = None
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in key]), F.lit(buckets)).cast("int")
    for n in others:
        wanted = F.broadcast(differing.where(F.col("layer") == n).select(F.col("bucket").alias("__bucket")))  # buckets at most
        signed = None
        for df, sign in ((layers[n], 1), (base, -1)):
            x = df.withColumn("__bucket", bucket).join(wanted, "__bucket", "left_semi").select(*columns, F.lit(sign).cast("long").alias("__sign"))
            signed = x if signed is None else signed.unionByName(x)
        found = (signed.groupBy(*columns).agg(F.sum("__sign").alias("__sign")).where("__sign <> 0")
                 .select(F.lit(n).alias("layer"), F.when(F.col("__sign") > 0, "added").otherwise("missing").alias("side"),
                         F.abs("__sign").alias("copies"), *columns))
        rows = found if rows is None else rows.unionByName(found)
    return status, rows


# --------------------------------------------------------------------------- K9
def dq_rollup(results: DataFrame) -> DataFrame:
    """Overall status: FAIL if any FAIL (a failed source check fails the run),
    WARN if any WARN, else PASS; sorted list of failed checks."""
    g = results.agg(
        F.count(F.lit(1)).alias("checks"),
        count_when(F.col("status") == "FAIL").alias("failed"),
        count_when(F.col("status").isin("WARN", "WARNING")).alias("warned"),
        F.array_join(F.array_sort(F.collect_list(
            F.when(F.col("status") == "FAIL", F.concat_ws(":", "layer", "check")))), "; ")
        .alias("failed_checks"))
    return g.withColumn("overall_status", F.when(F.col("failed") > 0, "FAIL")
                        .when(F.col("warned") > 0, "WARN").otherwise("PASS"))


# --------------------------------------------------------------------------- K10
def load_check(tables) -> DataFrame:
    """Row counts per normalized table and null foreign keys of the fact."""
    f = tables.flights.agg(
        F.count(F.lit(1)).alias("_n"),
        *[count_when(F.col(c).isNull()).alias(f"_null_{c}")
          for c in ("AIRLINE_ID", "ORIGIN_AIRPORT_ID", "DESTINATION_AIRPORT_ID")])
    a = tables.airlines.agg(F.count(F.lit(1)).alias("_a"))
    p = tables.airports.agg(F.count(F.lit(1)).alias("_p"))
    wide = one_row(f, a, p)

    def nonempty(x):
        return F.when(x > 0, "PASS").otherwise("FAIL")

    items = [("flights rows", "_n", "_n", nonempty), ("airlines rows", "_a", "_a", nonempty),
             ("airports rows", "_p", "_p", nonempty)]
    items += [(f"null {c}", "_n", f"_null_{c}", pass_fail)
              for c in ("AIRLINE_ID", "ORIGIN_AIRPORT_ID", "DESTINATION_AIRPORT_ID")]
    return _rows(wide, "normalized", "load", items)


def assert_loaded(report: DataFrame) -> None:
    """Raise with per-check counts when the load check failed."""
    bad = report.where(F.col("status") == "FAIL").collect()  # at most 6 rows
    if bad:
        raise ValueError("load validation failed: "
                         + ", ".join(f"{r['check']}={r['failures']}" for r in bad))


# --------------------------------------------------------------------------- K11, K12
def _star_pass(star: Star) -> DataFrame:
    """ONE pass over the fact: row count, 4 null-key and 4 orphan counts, delay nulls."""
    fk = [("airline_key", star.dim_airline, "airline_key", star.rows.get("dim_airline")),
          ("origin_airport_key", star.dim_airport, "airport_key", star.rows.get("dim_airport")),
          ("dest_airport_key", star.dim_airport, "airport_key", star.rows.get("dim_airport")),
          ("date_key", star.dim_date, "date_key", star.rows.get("dim_date"))]
    f = star.fact.select("airline_key", "origin_airport_key", "dest_airport_key", "date_key",
                         "DEPARTURE_DELAY", "ARRIVAL_DELAY")
    j, flags = attach_keys(f, fk)
    return j.agg(F.count(F.lit(1)).alias("fact_rows"),
                 *[count_when(F.col(k).isNull()).alias(f"null_{k}") for k, *_ in fk],
                 *[count_when(F.col(k).isNotNull() & F.col(h).isNull()).alias(f"orphan_{k}")
                   for k, h in flags],
                 count_when(F.col("DEPARTURE_DELAY").isNull()).alias("null_dep"),
                 count_when(F.col("ARRIVAL_DELAY").isNull()).alias("null_arr"))


def _dup_keys(dim: DataFrame, key: str, alias: str) -> DataFrame:
    """Number of key values that occur more than once, and the dimension size."""
    g = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(count_when(F.col("_c") > 1).alias(f"dup_{alias}"),
                 F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias(f"rows_{alias}"))


def _star_wide(star: Star) -> DataFrame:
    return one_row(_star_pass(star), _dup_keys(star.dim_airline, "airline_key", "airline"),
                   _dup_keys(star.dim_airport, "airport_key", "airport"),
                   _dup_keys(star.dim_date, "date_key", "date"))


STAR_CHECKS = [
    ("fact_flights rows", "fact_rows"), ("dim_airline rows", "rows_airline"),
    ("dim_airport rows", "rows_airport"), ("dim_date rows", "rows_date"),
    ("orphan airline keys", "orphan_airline_key"), ("orphan origin airport keys",
                                                    "orphan_origin_airport_key"),
    ("orphan dest airport keys", "orphan_dest_airport_key"), ("orphan date keys", "orphan_date_key"),
    ("null airline keys", "null_airline_key"), ("null origin airport keys", "null_origin_airport_key"),
    ("null dest airport keys", "null_dest_airport_key"), ("null date keys", "null_date_key"),
    ("duplicate airline keys", "dup_airline"), ("duplicate airport keys", "dup_airport"),
    ("duplicate date keys", "dup_date"),
]


def star_checks(star: Star) -> DataFrame:
    """Row counts plus the 11 issue counts (long), with ``is_issue``."""
    w = _star_wide(star)
    return w.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("check"), F.col(c).cast("bigint").alias("value"),
                 F.lit(not n.endswith(" rows")).alias("is_issue")) for n, c in STAR_CHECKS]))
        .alias("r")).select("r.*")


def star_status(checks: DataFrame) -> DataFrame:
    """K11 overall: SUCCESS iff the issue counts sum to 0."""
    g = checks.agg(F.coalesce(F.sum(F.when(F.col("is_issue"), F.col("value"))), F.lit(0))
                   .cast("bigint").alias("total_issues"))
    return g.withColumn("status", F.when(F.col("total_issues") == 0, "SUCCESS").otherwise("FAILED"))


def matrix_status(f: Column) -> Column:
    """PASS at 0, WARNING below 10, FAIL from 10."""
    return F.when(f == 0, "PASS").when(f < MATRIX_WARN_BELOW, "WARNING").otherwise("FAIL")


def rule_matrix(star: Star) -> DataFrame:
    """The 12-rule matrix: rule, records checked, failures, status."""
    w = _star_wide(star)
    return w.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(c).cast("bigint").alias("records_checked"),
                 F.col(f).cast("bigint").alias("failures"),
                 matrix_status(F.col(f)).alias("status")) for n, c, f in MATRIX_RULES]))
        .alias("r")).select("r.*")


def matrix_score(matrix: DataFrame, digits: int | None = 1) -> DataFrame:
    """score = 100 - non-PASS share * 100; EXCELLENT / GOOD / FAIR / CRITICAL."""
    g = matrix.agg(F.count(F.lit(1)).alias("total_checks"),
                   count_when(F.col("status") == "PASS").alias("passed_checks"))
    g = g.withColumn("failed_checks", F.col("total_checks") - F.col("passed_checks"))
    s = F.lit(100.0) - F.col("failed_checks") / F.col("total_checks") * 100
    g = g.withColumn("dq_score", F.round(s, digits) if digits is not None else s)
    label = None
    for threshold, name in MATRIX_LABELS:
        if threshold is None:
            label = label.otherwise(name)
        else:
            cond = F.col("dq_score") >= threshold
            label = F.when(cond, name) if label is None else label.when(cond, name)
    return g.withColumn("score_label", label)


def dq_insights(matrix: DataFrame, star: Star) -> DataFrame:
    """Totals per rule family and warehouse coverage, one row per insight."""
    fam = (matrix.withColumn("family", F.regexp_extract("rule", r"^(Null|Orphan|Duplicate)", 1))
           .where(F.col("family") != "")
           .groupBy("family").agg(F.sum("failures").cast("bigint").alias("value")))
    fam = fam.select(F.concat(F.lower("family"), F.lit("_total")).alias("insight"), "value")
    cov = one_row(star.dim_date.agg(F.count(F.lit(1)).alias("dates")),
                  star.dim_airline.agg(F.count(F.lit(1)).alias("airlines")),
                  star.dim_airport.agg(F.count(F.lit(1)).alias("airports")),
                  star.fact.agg(F.count(F.lit(1)).alias("flights")))
    cov = cov.select(F.explode(F.array(*[
        F.struct(F.lit(f"coverage_{n}").alias("insight"), F.col(n).cast("bigint").alias("value"))
        for n in ("flights", "dates", "airlines", "airports")])).alias("r")).select("r.*")
    return fam.unionByName(cov)


# --------------------------------------------------------------------------- F39
def kpi_audit(published: DataFrame, recomputed: DataFrame, tol: float = 0.1) -> DataFrame:
    """Compare a published executive summary (F7 columns) with a recomputation:
    counts exactly; of rates (2 dp) and averages (1 dp) the recomputed side is
    rounded, the published one is taken as it is, and |diff| <= tol (the
    difference is rounded to 9 dp, so that float noise at the limit doesn't decide)."""
    spec = [("TOTAL_FLIGHTS", None), ("TOTAL_AIRLINES", None), ("TOTAL_AIRPORTS", None),
            ("CANCELLATION_RATE", 2), ("DIVERSION_RATE", 2), ("AVG_DEPARTURE_DELAY", 1),
            ("AVG_ARRIVAL_DELAY", 1)]

    def long(df, name, rounded):
        return df.select(F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"),
                     (F.round(F.col(m).cast("double"), d) if rounded and d is not None
                      else F.col(m).cast("double")).alias(name)) for m, d in spec])).alias("r")
        ).select("r.*")

    j = long(published, "published", False).join(long(recomputed, "recomputed", True), "metric")
    exact = F.col("metric").isin("TOTAL_FLIGHTS", "TOTAL_AIRLINES", "TOTAL_AIRPORTS")
    diff = F.round(F.abs(F.col("published") - F.col("recomputed")), 9)
    ok = F.when(exact, diff == 0).otherwise(diff <= tol)
    return j.select("metric", "published", "recomputed", diff.alias("diff"),
                    F.when(ok, "PASS").otherwise("FAIL").alias("status"))


# --------------------------------------------------------------------------- Entry 4: a DQ run
def run_checks(raw: DataFrame, cleaned: DataFrame, airlines_ref: DataFrame,
               airports_ref: DataFrame, star: Star | None = None) -> DataFrame:
    """All file- and table-level checks of one data-quality run, as one long
    result table (K1, K2, K3, K4, K5 and, with a star, K6); feed it to
    ``dq_rollup`` (K9). Every family is one aggregate pass over its input."""
    parts = [
        null_check(raw),
        duplicate_check(airlines_ref, ["IATA_CODE"], "duplicate airline IATA_CODE", "reference"),
        duplicate_check(airports_ref, ["IATA_CODE"], "duplicate airport IATA_CODE", "reference"),
        duplicate_check(raw),
        type_check(cleaned),
        rule_check(cleaned),
        ref_check(raw, "AIRLINE", airlines_ref, on_fail="FAIL"),
        ref_check(raw, "ORIGIN_AIRPORT", airports_ref, on_fail="WARN"),
        ref_check(raw, "DESTINATION_AIRPORT", airports_ref, on_fail="WARN"),
    ]
    if star is not None:
        parts.append(orphan_check(star.fact, [
            ("airline_key", star.dim_airline, "airline_key", star.rows.get("dim_airline")),
            ("origin_airport_key", star.dim_airport, "airport_key", star.rows.get("dim_airport")),
            ("dest_airport_key", star.dim_airport, "airport_key", star.rows.get("dim_airport")),
            ("date_key", star.dim_date, "date_key", star.rows.get("dim_date"))]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
