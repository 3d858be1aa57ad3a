"""Additive aggregates of the fact (F7-F34), kept up by loads.

``agg_flights`` holds counts, flag counts, sums and non-null counts at three grains:
by day, by month and airline, by month, origin and destination. They add up: any
coarser total is a sum of its rows, so dashboards read thousands of rows instead of the
fact. A load brings the table up to date from its own rows alone: a signed delta (new
rows count +1, removed ones -1) is added to the rows of the years that it touches; the other
years keep their files (``sources/warehouse.py``), and the table becomes visible with
the fact.

``sums`` is how a query asks for partial sums: it reads the aggregates if they hold
what is asked for, else the fact, with the same columns either way. All sums are of
doubles; minutes and miles are whole numbers, which add up exactly in any order.

A grain has at most (days), (months x airlines) and (months x airport pairs) rows. Partial
aggregation before the shuffle reduces days, routes and the airlines that hold many rows.
A month of any other airline has few rows, so a task's partial sums would be about as many as its rows
and many times as wide: these rows are dealt as they are and summed up once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalar import count_when, is_flag
from contrail.spec import ARR, CANC, CAUSES, DEP, DIST, DIVR

TABLE = "agg_flights"
AIRLINE, ORIGIN, DESTINATION = "airline_key", "origin_airport_key", "dest_airport_key"
GRAINS = {"day": ("date_key",), "airline": ("month_key", AIRLINE), "route": ("month_key", ORIGIN, DESTINATION)}
KEYS = ["date_key", "month_key", AIRLINE, ORIGIN, DESTINATION]
LATE_GT, POSITIVE_GT = 15, 0  # the thresholds held: late departures, arrivals with a delay
VALUES = [DEP, ARR, DIST, *(c for _, c in CAUSES)]
POSITIVE = [ARR, *(c for _, c in CAUSES)]  # also summed over arrivals with a delay
HOT_SHARE = 200  # airlines with more than one in so many rows are summed up before the shuffle
MEASURES = ["_n", "_late", "_p_n", f"_f_{CANC}", f"_f_{DIVR}", *(f"_{k}_{v}" for v in VALUES for k in "sc"), *(f"_p_{k}_{v}" for v in POSITIVE for k in "sc")]


def aggregate(fact: DataFrame) -> DataFrame:
    """(year, grain, keys, measures) of fact rows; a column that the fact lacks counts as NULL."""
    def value(c: str):
        return F.col(c).cast("double") if c in fact.columns else F.lit(None).cast("double")

    late = F.col(ARR) > POSITIVE_GT
    rows = fact.withColumn("year", (F.col("date_key") / 10000).cast("int")).withColumn("month_key", (F.col("date_key") / 100).cast("int"))
    kept = [CANC, DIVR, *[c for c in VALUES if c in fact.columns]]
    per = [F.count(F.lit(1)).alias("_n"), count_when(F.col(DEP) > LATE_GT).alias("_late"), count_when(late).alias("_p_n"),
           *[count_when(is_flag(f)).alias(f"_f_{f}") for f in (CANC, DIVR)],
           *[x for v in VALUES for x in (F.coalesce(F.sum(value(v)), F.lit(0.0)).alias(f"_s_{v}"), F.count(value(v)).alias(f"_c_{v}"))],
           *[x for v in POSITIVE for x in (F.coalesce(F.sum(F.when(late, value(v))), F.lit(0.0)).alias(f"_p_s_{v}"), F.count(F.when(late, value(v))).alias(f"_p_c_{v}"))]]

    def own_keys(grain: str) -> list:  # keys that are not the grain's are NULL
        return [F.lit(grain).alias("grain"), *[(F.col(k) if k in GRAINS[grain] else F.lit(None)).cast("int").alias(k) for k in KEYS]]

    hot = F.coalesce(F.col(AIRLINE).isin(_hot_airlines(fact)), F.lit(True))
    # a row of each grain
    grains = F.array(*[F.struct(*own_keys(g)) for g in GRAINS if g != "airline"])
    grains = F.explode(F.when(hot, F.concat(grains, F.array(F.struct(*own_keys("airline"))))).otherwise(grains)).alias("g")
    spread = rows.select("year", *kept, grains).select("year", *kept, "g.*")
    dealt = (rows.where(~hot).select("year", "month_key", AIRLINE, *kept).repartition("year", "month_key", AIRLINE)
             .select("year", *kept, *own_keys("airline")))
    return spread.groupBy("year", "grain", *KEYS).agg(*per).unionByName(dealt.groupBy("year", "grain", *KEYS).agg(*per))


def _hot_airlines(fact: DataFrame) -> list[int]:
    """Airlines that hold more than one in ``HOT_SHARE`` of the rows: fewer than ``HOT_SHARE``."""
    held = fact.groupBy(AIRLINE).agg(F.count(F.lit(1)).alias("_n")).where(F.col(AIRLINE).isNotNull())
    total = held.agg(F.sum("_n").alias("_all"))
    return [r[0] for r in held.crossJoin(F.broadcast(total)).where(F.col("_n") * HOT_SHARE > F.col("_all")).select(AIRLINE).collect()]


def merged(before: DataFrame | None, inserted: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """Aggregates after a signed delta: ``before`` plus those of ``inserted`` less those of ``removed`` (fact rows).
    Groups that hold no row any more are gone."""
    delta = aggregate(inserted)
    if removed is not None:
        delta = delta.unionByName(aggregate(removed).withColumns({m: -F.col(m) for m in MEASURES}))
    if before is None and removed is None:
        return delta
    rows = delta if before is None else before.select(delta.columns).unionByName(delta)
    return rows.groupBy("year", "grain", *KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES]).where("_n <> 0")


def sums(fact: DataFrame, agg: DataFrame | None, keys, values=(DEP, ARR), flags=(CANC, DIVR), arr_gt: float | None = None,
         late_gt: float | None = None, names: dict | None = None) -> DataFrame:
    """Partial sums by ``keys`` (of the star): ``_n``, ``_f_<flag>``, ``_s_<value>``, ``_c_<value>``, with ``late_gt`` also ``_late``.

    ``arr_gt``: only flights with a larger arrival delay. ``names``: what the fact calls the star's keys, if not the same.
    Read from the aggregates (``agg``) if a grain has the keys and the thresholds are the ones held, else from the fact.
    """
    keys, names = list(keys), names or {}
    grain = next((g for g, own in GRAINS.items() if set(keys) <= set(own)), None)
    if agg is not None and grain and arr_gt in (None, POSITIVE_GT) and late_gt in (None, LATE_GT) and not (arr_gt is not None and (
            flags or late_gt is not None or not set(values) <= set(POSITIVE))):
        p = "" if arr_gt is None else "_p"
        out = [F.sum(f"{p}_n").alias("_n"), *[F.sum(f"_f_{f}").alias(f"_f_{f}") for f in flags]]
        for v in values:  # a sum of no values is NULL, as from the fact
            n = F.sum(f"{p}_c_{v}")
            out += [F.when(n > 0, F.sum(f"{p}_s_{v}")).alias(f"_s_{v}"), n.alias(f"_c_{v}")]
        if late_gt is not None:
            out.append(F.sum("_late").alias("_late"))
        rows = agg.where(F.col("grain") == grain)
        if arr_gt is not None:
            rows = rows.where("_p_n > 0")  # no group without such a flight
        return rows.groupBy(*keys).agg(*out)
    rows = fact if arr_gt is None else fact.where(F.col(ARR) > arr_gt)
    out = [F.count(F.lit(1)).alias("_n"), *[count_when(is_flag(f)).alias(f"_f_{f}") for f in flags]]
    for v in values:
        out += [F.sum(v).alias(f"_s_{v}"), F.count(v).alias(f"_c_{v}")]
    if late_gt is not None:
        out.append(count_when(F.col(DEP) > late_gt).alias("_late"))
    return rows.groupBy(*[F.col(names.get(k, k)).alias(k) for k in keys]).agg(*out)
