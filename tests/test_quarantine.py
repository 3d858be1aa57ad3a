"""Headers by file (A1, A2) and quarantine."""

import json
import os

import pytest
from pyspark.sql import types as T

from contrail.operators import quarantine
from contrail.plans import catalog
from contrail.sources import bindings, io
from contrail.spec import AIRLINES_SCHEMA

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("delay", T.DoubleType()), T.StructField("name", T.StringType())])


def put(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    return folder


def test_files_of_a_folder_are_read_by_their_own_header(spark, tmp_out):
    path = put(f"{tmp_out}/airlines", {
        "a.csv": "IATA_CODE,AIRLINE\nUA,United\nAA,American\n",
        "b.csv": "AIRLINE,IATA_CODE\nDelta,DL\n\"Sky, West\",OO\n",
        "c.csv": "IATA_CODE\nXX\n",  # lacks a column
        "d.csv": "EXTRA,AIRLINE,IATA_CODE,AIRLINE\n1,First,FF,Second\n",  # more columns, a name twice
        "e.csv": "",  # empty
        "f.csv": "\ufeffIATA_CODE,AIRLINE\r\nBO,Bom\r\n",
        "g.csv": "AIRLINE,IATA_CODE\n"})  # no rows
    got = sorted(map(tuple, io.read_csv(spark, path, AIRLINES_SCHEMA).collect()), key=str)
    assert got == [("AA", "American"), ("BO", "Bom"), ("DL", "Delta"), ("FF", "First"), ("OO", "Sky, West"), ("UA", "United"), ("XX", None)]


def test_many_files_are_grouped_by_few_headers(spark, tmp_out):
    files = {f"{i:03d}.csv": ("id,delay,name\n%d,1.5,a\n" if i % 2 else "name,id\na,%d\n") % i + "" for i in range(60)}
    groups = io.header_groups(spark, put(f"{tmp_out}/many", files))
    assert [(n, len(f)) for n, f in groups] == [(["id", "delay", "name"], 30), (["name", "id"], 30)]
    df = io.read_csv(spark, f"{tmp_out}/many", SCHEMA)
    assert sorted(r.id for r in df.collect()) == list(range(60)) and df.where("delay IS NULL").count() == 30


def test_a_large_file_is_split_and_its_header_read_from_the_start_only(spark, tmp_out):
    rows = "".join(f"{i},{i}.5,n{i}\n" for i in range(200_000))
    path = put(f"{tmp_out}/large", {"x.csv": "id,delay,name\n" + rows, "y.csv": "name,delay,id\nz,-1,-7\n"})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500_000)
    try:
        df = io.read_csv(spark, path, SCHEMA)
        assert df.rdd.getNumPartitions() > 3
        got = df.selectExpr("count(*) AS n", "sum(id) AS s", "min(delay) AS d").first()
        assert (got.n, got.s, got.d) == (200_001, sum(range(200_000)) - 7, -1.0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_missing_and_empty_paths(spark, tmp_out):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        io.read_csv(spark, f"{tmp_out}/nowhere", SCHEMA)
    assert io.read_csv(spark, put(f"{tmp_out}/empty", {"a.csv": ""}), SCHEMA).count() == 0


def test_good_and_rejected_rows_add_up(spark, tmp_out):
    path = put(f"{tmp_out}/raw", {
        "a.csv": "id,delay,name\n1, -15.5 ,x\n2,abc,y\n3,nan,z\n,4,w\n5x,1e400,v\n",
        "b.csv": "name,id\nq,7.0\nr,999\n,8\n"})
    got = quarantine.read_csv_split(spark, path, SCHEMA, required=["id"], ranges={"id": (1, 100)})
    good = sorted(map(tuple, got.good.collect()), key=str)
    cells = [(os.path.basename(r.file), r.column_name, r.value, r.reason) for r in got.cells.collect()]
    assert ("a.csv", "delay", "abc", "unparsable") in cells and ("a.csv", "id", "5x", "unparsable") in cells
    assert ("b.csv", "id", "999", "out of range") in cells and ("a.csv", "id", None, "missing") in cells
    assert (1, -15.5, "x") in good and (3, None, "z") in good and (7, None, "q") in good and (8, None, None) in good
    rows = got.rows.collect()
    assert len(good) + len(rows) == 8 and len({r.row_id for r in rows}) == len(rows)
    assert {json.loads(r.row).get("id") for r in rows} == {"2", None, "5x", "999"}
    assert {r.row_id for r in got.cells.collect()} == {r.row_id for r in rows}


def test_quarantine_refuses_unknown_columns(spark):
    with pytest.raises(ValueError, match="no such column"):
        quarantine.split(spark.createDataFrame([("1",)], "id string"), T.StructType([T.StructField("id", T.IntegerType())]), required=["x"])


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.startswith("part-"))


def test_rows_are_written_once_and_small(spark, tmp_out, monkeypatch):
    rows = [(f"{i}", f"{i % 90}.5" if i % 3 else "N/A", f"name {i % 50}") for i in range(30_000)]
    df = spark.createDataFrame(rows, "id string, delay string, name string").repartition(3)
    io.write_table(df.where("id < 15000"), f"{tmp_out}/raw/a", fmt="csv")
    io.write_table(df.where("id >= 15000").select("name", "delay", "id"), f"{tmp_out}/raw/b", fmt="csv")
    monkeypatch.setattr(quarantine, "scratch_path", lambda spark, name: f"{tmp_out}/{name}")
    got = quarantine.read_csv_split(spark, [f"{tmp_out}/raw/a", f"{tmp_out}/raw/b"], SCHEMA, required=["id"], ranges={"id": (0, 20_000)})
    bad = {i for i in range(30_000) if i % 3 == 0 or i > 20_000}
    assert {r.id for r in got.good.collect()} == set(range(30_000)) - bad
    kept = {r.row_id: json.loads(r.row) for r in got.rows.collect()}
    assert len(kept) == len(bad) and sorted(int(r["id"]) for r in kept.values()) == sorted(bad)
    cells = got.cells.collect()
    assert len(cells) == sum((i % 3 == 0) + (i > 20_000) for i in bad) and all(kept[c.row_id][c.column_name] == c.value for c in cells)
    assert size(f"{tmp_out}/quarantine") < size(f"{tmp_out}/raw") / 2  # by far more than the input when rejected rows were kept as JSON
    assert spark.conf.get("spark.sql.codegen.wholeStage") == "true"


def test_the_text_feed_is_packed(spark, tmp_out, monkeypatch):
    names = ["DEPARTURE_DELAY", "DISTANCE", "CANCELLED", "MONTH", "AIRLINE"]
    feed = spark.createDataFrame([("N/A" if i % 5 == 0 else "3.0", float(i % 1000), int(i % 5 == 0), i % 12 + 1, "UA") for i in range(6000)],
                                 "DEPARTURE_DELAY string, DISTANCE double, CANCELLED int, MONTH int, AIRLINE string").select(names)
    monkeypatch.setattr(bindings, "text_flights", lambda spark, sf_dir: feed)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{tmp_out}/{name}")
    got = {(r.column_name, r.reason): r.cells for r in catalog.QUERIES["q_c03_quarantine"](spark, "unused").collect()}
    far, cancelled = {i for i in range(6000) if i % 1000 > 500}, {i for i in range(6000) if i % 5 == 0}
    assert got == {("*", "good"): 6000 - len(far | cancelled), ("*", "rejected"): len(far | cancelled),
                   ("DEPARTURE_DELAY", "unparsable"): len(cancelled), ("DISTANCE", "out of range"): len(far)}
    io.write_table(feed, f"{tmp_out}/plain", fmt="csv")
    assert size(f"{tmp_out}/feed") < size(f"{tmp_out}/plain") / 2
