"""Readers, writers and source/contract checks.

Readers always take an explicit schema (never ``inferSchema`` on the fact).
Status results are DataFrames ``(name, check, status, detail)``; the checks
themselves are metadata lookups or one guarded read per path (a handful of
paths, so the driver-side loop is bounded by the number of sources).
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.spec import AIRLINES_SCHEMA, AIRPORTS_SCHEMA, FLIGHTS_SCHEMA

STATUS_SCHEMA = "name string, check string, status string, detail string"


#: Distinct headers that a folder may have; more point to files without any.
MOST_HEADERS = 1_000
#: Larger than any split: each split is a task of its own.
OPEN_COST = 1 << 40
#: Writer's options of large text tables between two steps: packed at little cost; as packed files are not split, they are kept small.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}


def headers(spark: SparkSession, path) -> DataFrame:
    """(file, header): the first line of each file under ``path``; empty files have none.

    The session's copy gives each split of a file its own task; the first row of the split at a file's start
    is kept. Lines are read by Spark's text reader alone, a split a task, however large the files are.
    """
    own = spark.newSession()  # shares the context, has settings of its own
    own.conf.set("spark.sql.files.openCostInBytes", OPEN_COST)
    own.conf.set("spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (own.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"),
                                       F.col("_metadata.file_block_start").alias("start"), in_task.alias("row"))
            .where("start = 0 AND row = 0").select("file", "header"))


def header_groups(spark: SparkSession, path, delimiter: str = ",") -> list[tuple[list[str], list[str]]]:
    """(column names, files) of each distinct header under ``path``: file metadata, never rows."""
    found: dict[str, list[str]] = {}
    for r in headers(spark, path).collect():  # a row a file
        found.setdefault(r["header"].removeprefix("\ufeff").rstrip("\r"), []).append(r["file"])
        if len(found) > MOST_HEADERS:
            raise ValueError(f"over {MOST_HEADERS} different headers under {path}: files without a header?")
    return sorted((next(csv.reader([h], delimiter=delimiter), []), sorted(files)) for h, files in found.items())


def read_text_columns(spark: SparkSession, path, schema: T.StructType, encoding: str = "utf-8") -> DataFrame:
    """The cells of CSV files as text, in the columns of ``schema`` by NAME, and ``_file``.

    Files are grouped by their own header and each group is read by it, so files of a folder may have their
    columns in any order, lack some (NULL) or have more (ignored). A name that stands twice in a header is
    taken at its first place. Files are read by Spark's CSV reader, split as usual.
    """
    groups = header_groups(spark, path)
    out = None
    for names, files in groups:
        # one header: the path as it is; columns are bound by position here, under names of our own
        shape = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(max(len(names), 1))])
        raw = (spark.read.schema(shape).option("header", True).option("enforceSchema", True).option("encoding", encoding)
               .csv(path if len(groups) == 1 else files))
        place = {n: i for i, n in reversed(list(enumerate(names)))}
        part = raw.select(*[(F.col(f"c{place[f.name]}") if f.name in place else F.lit(None).cast("string")).alias(f.name) for f in schema.fields],
                          F.col("_metadata.file_path").alias("_file"))
        out = part if out is None else out.unionByName(part)
    if out is None:  # no file holds a line
        spark.read.text(path).schema  # raises for a missing path
        return spark.createDataFrame([], T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields], T.StructField("_file", T.StringType())]))
    return out


def read_csv(spark: SparkSession, path, schema: T.StructType,
             encoding: str = "utf-8") -> DataFrame:
    """CSV with a header, columns matched to ``schema`` by NAME, file by file.

    A user schema on Spark's CSV reader binds columns by position, and one header for a whole folder
    misreads the files that have another. Cells are taken as text by each file's own header
    (``read_text_columns``; no inference pass) and parsed (``parsed``).
    """
    raw = read_text_columns(spark, path, schema, encoding)
    return raw.select(*[parsed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields])


def parsed(text, kind: T.DataType):
    """CSV text as a column of a type; NULL if it can't be. Integral text with a
    fraction of zero ('2354.0', as imputed integer columns are written) is an integer."""
    value = text.try_cast(kind)
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        number = text.try_cast("double")
        value = F.coalesce(value, F.when(number == F.floor(number), number.try_cast(kind)))
    return value


def unparsable(spark: SparkSession, path, schema: T.StructType, encoding: str = "utf-8") -> DataFrame:
    """(column, cells): how many cells of each column hold text that ``read_csv`` reads as NULL.
    The cells themselves, with their files: ``operators.quarantine``."""
    raw = read_text_columns(spark, path, schema, encoding)
    wide = raw.agg(*[F.count_if(F.col(f"`{f.name}`").isNotNull() & parsed(F.col(f"`{f.name}`"), f.dataType).isNull())
                     .alias(f.name) for f in schema.fields])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("cells"))
                                          for f in schema.fields])))


def read_reference(spark: SparkSession, path: str, schema: T.StructType,
                   encoding: str = "utf-8", require_rows: bool = True) -> DataFrame:
    """A1: whole reference CSV with header and explicit schema.

    A missing path raises (Spark's analysis error); an empty file raises
    ``ValueError`` (one ``isEmpty`` probe, only at this entry point).
    """
    df = read_csv(spark, path, schema, encoding)
    if require_rows and df.isEmpty():
        raise ValueError(f"reference file is empty: {path}")
    return df


def read_fact(spark: SparkSession, path: str, schema: T.StructType = FLIGHTS_SCHEMA,
              row_limit: int | None = None, fraction: float | None = None,
              seed: int | None = None, encoding: str = "utf-8") -> DataFrame:
    """A2: fact CSV with explicit schema; ``row_limit`` = first N rows (S1),
    ``fraction``/``seed`` = Bernoulli sample; default reads everything (S2)."""
    if row_limit is not None and row_limit <= 0:
        raise ValueError("row_limit must be positive")
    df = read_csv(spark, path, schema, encoding)
    if fraction is not None:
        df = df.sample(fraction=fraction, seed=seed)
    return df.limit(row_limit) if row_limit is not None else df


@dataclass
class Sources:
    flights: DataFrame
    airlines: DataFrame
    airports: DataFrame
    profiles: DataFrame


def extract(spark: SparkSession, paths: dict, row_limit: int | None = None) -> Sources:
    """A3: the three sources plus a one-row profile per source (unioned)."""
    from contrail.operators.profile import profile

    flights = read_fact(spark, paths["flights"], row_limit=row_limit)
    airlines = read_reference(spark, paths["airlines"], AIRLINES_SCHEMA)
    airports = read_reference(spark, paths["airports"], AIRPORTS_SCHEMA)
    prof = (profile(flights, "flights").unionByName(profile(airlines, "airlines"))
            .unionByName(profile(airports, "airports")))
    return Sources(flights, airlines, airports, prof)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(),
                mode: str = "overwrite", header: bool = True,
                require_rows: bool = False, options: dict | None = None) -> None:
    """Idempotent (overwrite) or append write; CSV with header. ``options``: the writer's own."""
    if require_rows and df.isEmpty():
        raise ValueError(f"refusing to write an empty dataset to {path}")
    w = df.write.mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", header).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """A5: re-read a written dataset (CSV needs the schema)."""
    if fmt == "csv":
        if schema is None:
            raise ValueError("reading CSV needs a schema")
        return read_csv(spark, path, schema)
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.format(fmt).load(path)


def _status(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def check_tables(spark: SparkSession, tables: dict) -> DataFrame:
    """Required tables exist and are non-empty.

    ``tables``: name -> catalog table name, path, or the table itself (None: it
    doesn't exist). Empty tables WARN.
    """
    rows = []
    for name, ref in tables.items():
        if ref is None or isinstance(ref, DataFrame):
            rows.append((name, "exists", "FAIL" if ref is None else "PASS", "not published" if ref is None else None))
            if ref is not None:
                rows.append((name, "non_empty", "WARN" if ref.isEmpty() else "PASS", None))
            continue
        is_path = "/" in ref or ":" in ref
        try:
            df = (spark.read.parquet(ref) if is_path or not spark.catalog.tableExists(ref)
                  else spark.table(ref))
        except AnalysisException as e:
            rows.append((name, "exists", "FAIL", str(e).splitlines()[0]))
            continue
        rows.append((name, "exists", "PASS", None))
        rows.append((name, "non_empty", "WARN" if df.isEmpty() else "PASS", None))
    return _status(spark, rows)


def require_columns(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c not in df.columns]


def check_contract(df: DataFrame, name: str, required) -> DataFrame:
    """A10: dataset contract: required columns present and at least one row."""
    missing = require_columns(df, required)
    has_rows = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return has_rows.select(
        F.lit(name).alias("name"), F.lit("contract").alias("check"),
        F.when((F.col("n") > 0) & F.lit(not missing), "PASS").otherwise("FAIL").alias("status"),
        F.when(F.lit(bool(missing)), F.lit("missing columns: " + ",".join(missing)))
        .when(F.col("n") == 0, F.lit("no rows")).alias("detail"))


def check_sources(spark: SparkSession, paths: dict, fmt: str = "csv") -> DataFrame:
    """Per source PASS/FAIL with a guarded read (path listing only)."""
    rows = []
    for name, p in paths.items():
        try:
            spark.read.format(fmt).load(p).schema  # resolves the file listing
            rows.append((name, "source_present", "PASS", p))
        except AnalysisException:
            rows.append((name, "source_present", "FAIL", p))
    return _status(spark, rows)


def load_layers(spark: SparkSession, paths: dict) -> tuple[dict, DataFrame]:
    """Raw flights, airlines, airports and cleaned flights; a missing
    cleaned set falls back to raw and is flagged WARN."""
    layers, rows = {}, []
    layers["raw_flights"] = read_fact(spark, paths["flights"])
    layers["airlines"] = read_reference(spark, paths["airlines"], AIRLINES_SCHEMA)
    layers["airports"] = read_reference(spark, paths["airports"], AIRPORTS_SCHEMA)
    try:
        layers["cleaned_flights"] = read_table(spark, paths["cleaned"])
        rows.append(("cleaned_flights", "layer", "PASS", paths["cleaned"]))
    except (AnalysisException, KeyError):
        layers["cleaned_flights"] = layers["raw_flights"]
        rows.append(("cleaned_flights", "layer", "WARN", "fell back to raw flights"))
    return layers, _status(spark, rows)


def table_inventory(tables: dict) -> DataFrame:
    """Table, column, type and row count of every table (one count job
    per table, unioned lazily)."""
    out = None
    for name, df in tables.items():
        inv = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.explode(F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                                         F.lit(f.dataType.simpleString()).alias("data_type"))
                                for f in df.schema.fields])).alias("c"), "row_count"
        ).select("table_name", "c.column_name", "c.data_type", "row_count")
        out = inv if out is None else out.unionByName(inv)
    return out
