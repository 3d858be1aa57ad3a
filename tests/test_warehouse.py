"""Stable keys over loads, atomic publication, replacement by partition, pruning."""

import pytest
from pyspark.sql import functions as F

from contrail.operators import keys, model
from contrail.plans import metrics
from contrail.sources.warehouse import Warehouse

COLUMNS = ("YEAR int, MONTH int, DAY int, AIRLINE string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, "
           "DEPARTURE_DELAY double, ARRIVAL_DELAY double, CANCELLED int, DIVERTED int")


@pytest.fixture()
def refs(spark):
    airlines = spark.createDataFrame([(c, f"name {c}") for c in ("AA", "BB", "MM", "ZZ")], "IATA_CODE string, AIRLINE string")
    airports = spark.createDataFrame([(c, c, c, c, "X", 1.0, 2.0) for c in ("JFK", "LAX", "ATL")],
                                     "IATA_CODE string, AIRPORT string, CITY string, STATE string, COUNTRY string, LATITUDE double, LONGITUDE double")
    return airlines, airports


def flights(spark, rows):
    return spark.createDataFrame([(y, 1, d, a, o, t, 1.0, 2.0, 0, 0) for y, d, a, o, t in rows], COLUMNS)


def codes(spark, path):
    return {(r.dim, r.code): r.key for r in keys.registry(Warehouse(spark, path)).collect()}


def facts(star):
    """Facts with their codes: what the keys of the fact mean."""
    return sorted(tuple(r) for r in star.fact.join(star.dim_airline, "airline_key").select("date_key", "airline_code", "airline_name").collect())


def test_keys_stay_and_new_ones_follow_without_gaps(spark, tmp_out, refs):
    first = flights(spark, [(2015, 1, "MM", "LAX", "JFK"), (2015, 2, "ZZ", "JFK", "LAX")])
    model.load_star(spark, first, tmp_out, *refs, "one")
    before = codes(spark, tmp_out)
    assert before == {("airlines", "MM"): 1, ("airlines", "ZZ"): 2, ("airports", "JFK"): 1, ("airports", "LAX"): 2}
    second = flights(spark, [(2016, 1, "AA", "ATL", "JFK"), (2016, 2, "BB", "JFK", "LAX"), (2016, 3, "ZZ", None, "LAX")])
    star = model.load_star(spark, second, tmp_out, *refs, "two")
    after = codes(spark, tmp_out)
    assert before.items() <= after.items()
    assert {k: v for k, v in after.items() if k not in before} == {("airlines", "AA"): 3, ("airlines", "BB"): 4, ("airports", "ATL"): 3}
    assert facts(star) == [(20150101, "MM", "name MM"), (20150102, "ZZ", "name ZZ"), (20160101, "AA", "name AA"), (20160102, "BB", "name BB"), (20160103, "ZZ", "name ZZ")]
    assert star.rows == {"dim_airline": 4, "dim_airport": 3, "dim_date": 5}
    # a load that was committed before changes nothing
    model.load_star(spark, second, tmp_out, *refs, "two")
    assert codes(spark, tmp_out) == after and Warehouse(spark, tmp_out).version() == 2
    # the version before still reads as it was
    assert facts(model.read_star(spark, tmp_out, 1)) == [(20150101, "MM", "name MM"), (20150102, "ZZ", "name ZZ")]


def test_many_new_members_are_numbered_by_ranges(spark, tmp_out, monkeypatch):
    """Beyond the bound of one window the same numbers come out."""
    from contrail.functions import ranking
    monkeypatch.setattr(ranking, "WINDOW_ROWS", 10)
    w = Warehouse(spark, tmp_out)
    for load_id, lo, hi in (("a", 0, 500), ("b", 200, 1200)):
        load = w.begin(load_id)
        members = spark.range(lo, hi).select(F.explode(F.array(F.lit("x"), F.lit("y"))).alias("dim"), F.format_string("c%05d", "id").alias("code"))
        keys.register(load, members)
        load.commit()
    got = keys.registry(w)
    assert got.count() == 2400
    assert got.filter("key <> cast(substr(code, 2) as int) + 1").count() == 0


@pytest.mark.parametrize("broken", ["dim_airline", "dim_airport", "dim_date", "commit"])
def test_a_load_that_breaks_is_not_seen(spark, tmp_out, refs, monkeypatch, broken):
    from contrail.sources import warehouse

    model.load_star(spark, flights(spark, [(2015, 1, "MM", "LAX", "JFK")]), tmp_out, *refs, "one")
    write, commit = warehouse.Load.write, warehouse.Load.commit

    def failing_write(self, table, *a, **k):
        if table == broken:
            raise OSError("lost")
        return write(self, table, *a, **k)

    def failing_commit(self):
        raise OSError("lost")

    second = flights(spark, [(2015, 2, "AA", "ATL", "JFK"), (2016, 1, "ZZ", "JFK", "LAX")])
    with monkeypatch.context() as m:
        m.setattr(warehouse.Load, "write", failing_write)
        if broken == "commit":
            m.setattr(warehouse.Load, "commit", failing_commit)
        with pytest.raises(OSError):
            model.load_star(spark, second, tmp_out, *refs, "two")
    star = model.read_star(spark, tmp_out)
    assert facts(star) == [(20150101, "MM", "name MM")]
    assert star.rows == {"dim_airline": 1, "dim_airport": 2, "dim_date": 1}
    assert codes(spark, tmp_out) == {("airlines", "MM"): 1, ("airports", "JFK"): 1, ("airports", "LAX"): 2}
    assert commit is warehouse.Load.commit
    # the same load, repeated, is whole
    star = model.load_star(spark, second, tmp_out, *refs, "two")
    assert facts(star) == [(20150102, "AA", "name AA"), (20160101, "ZZ", "name ZZ")]  # 2015 was replaced by what the load holds


def test_untouched_years_keep_their_files(spark, tmp_out, refs):
    model.load_star(spark, flights(spark, [(2014, 1, "AA", "JFK", "LAX"), (2015, 1, "AA", "JFK", "LAX"), (2016, 1, "AA", "JFK", "LAX")]), tmp_out, *refs, "one")
    files = lambda: {f.rsplit("/", 3)[1]: f for f in model.read_star(spark, tmp_out).fact.inputFiles()}
    before = files()
    model.load_star(spark, flights(spark, [(2015, 7, "BB", "JFK", "ATL")]), tmp_out, *refs, "two")
    after = files()
    assert sorted(before) == sorted(after) == ["year=2014", "year=2015", "year=2016"]
    assert {y for y in before if before[y] != after[y]} == {"year=2015"}
    assert {r.date_key for r in model.read_star(spark, tmp_out).dim_date.collect()} == {20140101, 20150107, 20160101}


def test_two_writers_cannot_commit_one_version(spark, tmp_out):
    w = Warehouse(spark, tmp_out)
    one, two = w.begin("one"), w.begin("two")
    one.write("t", spark.range(3))
    two.write("t", spark.range(5))
    one.commit()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        two.commit()
    assert w.read("t").count() == 3 and [r.load_id for r in w.loads().collect()] == ["one"]


def test_empty_partitioned_table_keeps_its_schema(spark, tmp_out):
    w = Warehouse(spark, tmp_out)
    load = w.begin("one")
    load.write("t", spark.range(0).withColumn("year", F.lit(1)), "year")
    load.commit()
    assert w.read("t").columns == ["id", "year"] and w.read("t").count() == 0
    with pytest.raises(ValueError, match="no version"):
        w.read("u")


def test_calendar_filters_prune_years_at_run_time(spark, tmp_out, refs):
    rows = [(y, d, "AA", "JFK", "LAX") for y in range(2010, 2020) for d in (1, 2, 3)]
    star = model.load_star(spark, flights(spark, rows), tmp_out, *refs, "one")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    got = metrics.calendar_slice(star, [F.col("full_date") >= "2018-01-01"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == old
    assert {(r.year, r.flights) for r in got.groupBy("year").agg(F.sum("flights").alias("flights")).collect()} == {(2018, 3), (2019, 3)}


def test_a_load_without_new_members_keeps_all_keys(spark, tmp_out, refs):
    model.load_star(spark, flights(spark, [(2015, 1, "MM", "LAX", "JFK"), (2015, 2, "ZZ", "JFK", "LAX")]), tmp_out, *refs, "one")
    star = model.load_star(spark, flights(spark, [(2016, 1, "ZZ", "LAX", "JFK")]), tmp_out, *refs, "two")
    assert facts(star) == [(20150101, "MM", "name MM"), (20150102, "ZZ", "name ZZ"), (20160101, "ZZ", "name ZZ")]
    assert star.rows == {"dim_airline": 2, "dim_airport": 2, "dim_date": 3}


def test_an_empty_load(spark, tmp_out, refs):
    empty = flights(spark, [])
    star = model.load_star(spark, empty, tmp_out, *refs, "none")
    assert star.rows == {"dim_airline": 0, "dim_airport": 0, "dim_date": 0} and star.fact.count() == 0
    star = model.load_star(spark, flights(spark, [(2015, 1, "MM", "LAX", "JFK")]), tmp_out, *refs, "one")
    assert facts(star) == [(20150101, "MM", "name MM")]
