"""Reconciliation by content (K8), idempotent run log (A11), mergeable distinct counts."""

import pytest
from pyspark.sql import functions as F

from contrail.operators import quality
from contrail.plans import sketches
from contrail.sources import runlog, warehouse


def test_a_changed_row_with_equal_counts_is_named(spark):
    base = spark.range(5000).select("id", (F.col("id") % 7).alias("v"), F.lit("x").alias("s"))
    changed = base.withColumn("v", F.when(F.col("id") == 4321, 99).otherwise(F.col("v")))
    status, rows = quality.reconcile_content({"raw": base, "same": base.orderBy(F.desc("id")), "changed": changed}, "id", buckets=64)
    assert {r.layer: (r.rows, r.differing_buckets, r.status) for r in status.collect()} == {"same": (5000, 0, "PASS"), "changed": (5000, 1, "FAIL")}
    assert sorted(map(tuple, rows.collect())) == [("changed", "added", 1, 4321, 99, "x"), ("changed", "missing", 1, 4321, 4321 % 7, "x")]


def test_repeated_missing_and_null_rows(spark):
    base = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "n"), (3, "c")], "k int, v string")
    other = spark.createDataFrame([(1, "a"), (2, None), (None, "n"), (3, "c"), (4, "d"), (4, "d")], "k int, v string")
    _, rows = quality.reconcile_content({"raw": base, "b": other, "none": base.limit(0)}, "k")
    got = sorted((tuple(r) for r in rows.collect()), key=str)
    assert got == sorted([("b", "missing", 1, 1, "a"), ("b", "added", 2, 4, "d"), ("none", "missing", 2, 1, "a"), ("none", "missing", 1, 2, None),
                          ("none", "missing", 1, None, "n"), ("none", "missing", 1, 3, "c")], key=str)
    status, rows = quality.reconcile_content({"raw": base.limit(0), "b": base.limit(0)}, "k")
    assert rows.count() == 0


def records(spark, ids):
    runs = spark.createDataFrame([(i, f"2024-01-0{k + 1}T00:00:00", "SUCCESS", 1.0, 90.0, 10) for k, i in enumerate(ids)],
                                 "run_id string, run_timestamp string, overall_status string, total_duration double, dq_score double, records_loaded long")
    phases = spark.createDataFrame([(n, i, p, "SUCCESS", 1.0, "a", "b") for i in ids for n, p in enumerate(("extract", "load"), 1)],
                                   "id long, run_id string, phase_name string, status string, duration_seconds double, start_time string, end_time string")
    return runs, phases


def logged(spark, path):
    runs, phases = runlog.read_log(spark, path)
    return sorted(r.run_id for r in runs.collect()), phases.count()


def test_a_run_appended_twice_stands_once(spark, tmp_out):
    runlog.append_run(*records(spark, ["r1", "r2"]), tmp_out, "batch-1")
    runlog.append_run(*records(spark, ["r1", "r2"]), tmp_out, "batch-1")
    assert logged(spark, tmp_out) == (["r1", "r2"], 4)
    runlog.append_run(*records(spark, ["r2", "r3"]), tmp_out)  # another batch with a run that is there
    runs, phases = records(spark, ["r4", "r4"])
    runlog.append_run(runs, phases, tmp_out)
    assert logged(spark, tmp_out) == (["r1", "r2", "r3", "r4"], 8)
    runlog.compact(spark, tmp_out)
    assert logged(spark, tmp_out) == (["r1", "r2", "r3", "r4"], 8)
    assert len(runlog.read_log(spark, tmp_out)[0].inputFiles()) == 1


def test_a_broken_append_is_not_seen_and_can_be_repeated(spark, tmp_out, monkeypatch):
    runlog.append_run(*records(spark, ["r1"]), tmp_out, "one")
    write = warehouse.Load.write

    def broken(self, table, *a, **k):
        if table == runlog.PHASES:
            raise OSError("lost")
        return write(self, table, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(warehouse.Load, "write", broken)
        with pytest.raises(OSError):
            runlog.append_run(*records(spark, ["r2"]), tmp_out, "two")
    assert logged(spark, tmp_out) == (["r1"], 2)  # no run without its phases
    runlog.append_run(*records(spark, ["r2"]), tmp_out, "two")
    assert logged(spark, tmp_out) == (["r1", "r2"], 4)


def test_sketches_of_days_merge_for_any_range(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.xxhash64("id") % 20_000).alias("a"), (F.col("id") % 5).alias("b"), F.lit(None).cast("string").alias("c"))
    daily = sketches.distinct_sketches(df, ["a", "b", "c"], "day")
    assert daily.count() == 90
    for lo, hi in ((0, 1), (3, 12), (0, 30)):
        part = df.where(f"day >= {lo} AND day < {hi}")
        got = sketches.with_exact(sketches.merged_counts(daily.where(f"day >= {lo} AND day < {hi}")), part, ["a", "b", "c"]).collect()
        assert len(got) == 3 and all(r.within for r in got)
        exact = {r.column_name: r.exact_count for r in got}
        assert exact["c"] == 0 and exact["a"] == part.select("a").distinct().count()
