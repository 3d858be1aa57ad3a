"""Append-only run log (A11) and the queries over it.

Two tables, as the portal reads them:
``etl_run_history(run_id, run_timestamp, overall_status, total_duration,
dq_score, records_loaded)`` and ``etl_phase_log(id, run_id, phase_name,
status, duration_seconds, start_time, end_time)``. The nested JSON form of a
run (array of phase structs) is read with an explicit schema and exploded.
Run logs grow with the number of runs; every query below is a distributed
aggregate or a top-1, so none funnels the log through one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.functions.scalar import capitalize, count_when, hours_between, map_values
from contrail.sources.warehouse import Warehouse
from contrail.spec import (AGING_HOURS, AGING_LABEL, FRESH_HOURS, FRESH_LABEL, HEALTH_LABELS, STALE_LABEL, UNKNOWN_LABEL,
                           RUN_METADATA_SCHEMA)

RUN_COLUMNS = ["run_id", "run_timestamp", "overall_status", "total_duration", "dq_score",
               "records_loaded"]
PHASE_COLUMNS = ["id", "run_id", "phase_name", "status", "duration_seconds", "start_time",
                 "end_time"]


RUNS, PHASES, APPENDED = "etl_run_history", "etl_phase_log", "log_version"


def append_run(runs: DataFrame, phases: DataFrame, path: str, batch: str | None = None) -> int:
    """Append run and phase records; returns the log's version.

    Both tables become visible with one manifest (``sources/warehouse.py``), so a run is never seen
    without its phases. Records are keyed by run: runs that the log holds are left out, with
    their phases, and a ``batch`` that was committed before changes nothing, so a repeated or broken append stands once.
    Records that a batch holds twice for one run are one (the largest).
    """
    log = Warehouse(runs.sparkSession, path)
    load = log.begin(batch or f"append-{uuid.uuid4().hex[:12]}")
    if load.before and batch is not None and log.committed(batch):
        return load.before
    new = runs.select("run_id", F.struct(*RUN_COLUMNS).alias("r")).groupBy("run_id").agg(F.max("r").alias("r")).select("r.*")
    records = phases.select(*PHASE_COLUMNS).dropDuplicates()
    if load.before:
        known = log.read(RUNS).select("run_id")
        new, records = new.join(known, "run_id", "left_anti"), records.join(known, "run_id", "left_anti")
    for table, df in ((RUNS, new.select(*RUN_COLUMNS)), (PHASES, records)):
        load.write(table, df.withColumn(APPENDED, F.lit(load.before + 1)), APPENDED)
    return load.commit()


def compact(spark: SparkSession, path: str) -> int:
    """Rewrites the log's small files as one part of each table; readers see the files before or those after."""
    log = Warehouse(spark, path)
    load = log.begin(f"compact-{uuid.uuid4().hex[:12]}")
    for table in (RUNS, PHASES):
        load.write(table, log.read(table).withColumn(APPENDED, F.lit(load.before + 1)), APPENDED, replace_all=True)
    return load.commit()


def read_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    tables = Warehouse(spark, path).read_all()
    return tables[RUNS].drop(APPENDED), tables[PHASES].drop(APPENDED)


def to_metadata(runs: DataFrame, phases: DataFrame, pipeline: str = "flight-etl",
                version: str = "1.0") -> DataFrame:
    """Nested run metadata (one row per run with an array of phase structs).

    The phases of a run are gathered with ``collect_list`` per run: a run has a
    handful of phases, so each group is bounded by the phase count.
    """
    ph = phases.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("id").alias("_order"), "phase_name", "status", "start_time", "end_time",
        "duration_seconds", F.lit(None).cast("string").alias("error_message")))).alias("_p"))
    j = runs.join(ph, "run_id", "left")
    return j.select(
        F.lit(pipeline).alias("pipeline_name"), F.lit(version).alias("pipeline_version"),
        "run_id", "run_timestamp", F.col("total_duration").alias("total_duration_seconds"),
        "overall_status",
        F.transform("_p", lambda p: F.struct(
            p["phase_name"].alias("phase_name"), p["status"].alias("status"),
            p["start_time"].alias("start_time"), p["end_time"].alias("end_time"),
            p["duration_seconds"].alias("duration_seconds"),
            p["error_message"].alias("error_message"))).alias("phases"))


def read_run_json(spark: SparkSession, path: str, multiline: bool = True
                  ) -> tuple[DataFrame, DataFrame]:
    """Nested JSON run metadata -> (runs, phases) with ``explode``.

    ``multiline=True`` reads one pretty-printed document per file (the
    orchestrator's format); False reads JSON Lines (what Spark writes).
    """
    md = spark.read.schema(RUN_METADATA_SCHEMA).option("multiLine", multiline).json(path)
    runs = md.select("run_id", "run_timestamp", "overall_status",
                     F.col("total_duration_seconds").alias("total_duration"))
    phases = md.select("run_id", F.posexplode("phases").alias("pos", "p")).select(
        (F.col("pos") + 1).cast("bigint").alias("id"), "run_id", "p.phase_name", "p.status",
        "p.duration_seconds", "p.start_time", "p.end_time", "p.error_message")
    return runs, phases


def latest_run(runs: DataFrame) -> DataFrame:
    """the newest run's timestamp, status and duration (top-1)."""
    return (runs.orderBy(F.desc("run_timestamp"), F.desc("run_id")).limit(1)
            .select("run_timestamp", "overall_status", "total_duration"))


def phase_timeline(runs: DataFrame, phases: DataFrame, labels: bool = False) -> DataFrame:
    """Phases of every run, newest run first, phase order inside.

    ``labels=True`` adds the display label (capitalised phase name) and a
    status band (SUCCESS / FAIL / WARNING, anything else OTHER), I13.
    """
    out = (phases.join(runs.select("run_id", "run_timestamp"), "run_id")
           .orderBy(F.desc("run_timestamp"), "id")
           .select("run_timestamp", "phase_name", "status", "duration_seconds", "start_time",
                   "end_time"))
    if labels:
        out = out.withColumns({
            "phase_label": capitalize("phase_name"),
            "status_band": map_values("status", {"SUCCESS": "SUCCESS", "FAIL": "FAIL",
                                                 "FAILED": "FAIL", "WARNING": "WARNING"},
                                      "OTHER")})
    return out


def dq_trend(runs: DataFrame) -> DataFrame:
    """DQ score and records over runs, oldest first."""
    return runs.select("run_timestamp", "dq_score", "records_loaded").orderBy("run_timestamp")


def run_report(phases: DataFrame, digits: int | None = 2) -> DataFrame:
    """per run, phases total / succeeded / failed / skipped, success rate, runtime."""
    g = phases.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_phases"),
        count_when(F.col("status") == "SUCCESS").alias("successful_phases"),
        count_when(F.col("status") == "FAILED").alias("failed_phases"),
        count_when(F.col("status") == "SKIPPED").alias("skipped_phases"),
        F.sum("duration_seconds").alias("_runtime"))
    rate = F.col("successful_phases") / F.col("total_phases") * 100
    return g.select("run_id", "total_phases", "successful_phases", "failed_phases",
                    "skipped_phases",
                    (F.round(rate, digits) if digits is not None else rate).alias("success_rate"),
                    (F.round("_runtime", digits) if digits is not None else F.col("_runtime"))
                    .alias("total_runtime"))


def freshness(runs: DataFrame, now) -> DataFrame:
    """Hours since the latest run: < 24 Fresh, < 72 Aging, else Stale;
    'Unknown' with no run. ``now`` is a timestamp literal (a parameter)."""
    # ISO strings order like the instants; both ends are read in the session
    # time zone, so the difference does not depend on it. ``last_run`` stays text.
    last = runs.agg(F.max("run_timestamp").alias("last_run"))
    h = hours_between(F.to_timestamp(F.lit(now)), F.to_timestamp(F.col("last_run")))
    return last.select(
        "last_run", h.alias("hours_ago"),
        F.when(F.col("last_run").isNull(), UNKNOWN_LABEL)
        .when(h < FRESH_HOURS, FRESH_LABEL).when(h < AGING_HOURS, AGING_LABEL)
        .otherwise(STALE_LABEL).alias("freshness"))


def health(runs: DataFrame) -> DataFrame:
    """Pipeline health from the latest run's status."""
    last = runs.agg(F.max_by("overall_status", F.struct("run_timestamp", "run_id"))
                    .alias("overall_status"))
    s = F.coalesce(F.col("overall_status"), F.lit("UNKNOWN"))
    last = last.select(s.alias("overall_status"),
                       map_values(s, HEALTH_LABELS, None).alias("_h"))
    return last.select("overall_status", F.coalesce("_h", "overall_status").alias("health"))


def phase_order(phases: DataFrame) -> DataFrame:
    """Number phases inside each run by start time (the log's ``id``)."""
    w = Window.partitionBy("run_id").orderBy("start_time", "phase_name")
    return phases.withColumn("id", F.row_number().over(w).cast("bigint"))
