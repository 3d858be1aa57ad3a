"""Tables that are published together: versions, a manifest written last.

A warehouse is a folder. A load writes its tables into folders that no reader
looks at yet (``<table>/[<partition>=.../]load=<id>``) and, when all of them are
complete, one manifest: a Parquet file that lists the folders of every table as
of this version. The manifest is the commit. Readers take the tables of the
newest version that has one, so they see the whole star before a load or the
whole star after it, whatever breaks in between; folders that no manifest names
are never read.

A partitioned table is replaced by partition: a load rewrites the partitions
(years) that it holds, the folders of the others are carried over as they are
(C14). Readers get a plain Parquet relation with its partition columns, so static
and dynamic partition pruning work as on any partitioned table.

What passes through the driver is metadata: a row a folder (tables times their
partitions), never rows of data. Versions commit one after another (one writer);
a version's number is taken once: the commit fails if another writer was faster.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, load_id string, table_name string, part string, folder string"
LOAD = "load"  # the partition column that tells loads apart
NULL_PART = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name of a NULL partition


class Warehouse:
    """Versioned tables under ``path`` (a folder that all executors share)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # ----------------------------------------------------------------- versions
    def manifests(self) -> DataFrame:
        """All manifests: (version, load_id, table_name, part, folder)."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/_manifests/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def version(self) -> int:
        """The newest committed version; 0 before the first."""
        return self.manifests().agg(F.max("version")).first()[0] or 0

    def loads(self) -> DataFrame:
        """(version, load_id) of the committed loads, in order."""
        return self.manifests().select("version", "load_id").distinct().orderBy("version")

    def committed(self, load_id: str) -> bool:
        return not self.manifests().filter(F.col("load_id") == load_id).isEmpty()

    def _folders(self, version: int | None = None) -> dict[str, dict[str, str]]:
        """Table -> partition -> folder, as of a version (the newest, if not given)."""
        m = self.manifests()
        if version is not None:
            m = m.filter(F.col("version") == version)
        newest = (m.groupBy("version").agg(F.collect_list(F.struct("table_name", "part", "folder")).alias("folders"))
                  .orderBy(F.desc("version")).limit(1).collect())
        out: dict[str, dict[str, str]] = {}
        for r in newest[0]["folders"] if newest else []:  # a row a folder
            out.setdefault(r["table_name"], {})[r["part"]] = r["folder"]
        return out

    # ----------------------------------------------------------------- reading
    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as of a version (the newest, if not given); partition columns are part of it."""
        folders = self._folders(version).get(table)
        if folders is None:
            raise ValueError(f"no version of {table!r} in {self.path}")
        return self._open(table, folders)

    def read_all(self, version: int | None = None) -> dict[str, DataFrame]:
        """All tables of one version."""
        return {t: self._open(t, f) for t, f in self._folders(version).items()}

    def _open(self, table: str, folders: dict[str, str]) -> DataFrame:
        base = f"{self.path}/{table}"
        return (self.spark.read.option("basePath", base)
                .parquet(*[f"{self.path}/{f}" for f in sorted(folders.values())]).drop(LOAD))

    # ----------------------------------------------------------------- writing
    def begin(self, load_id: str) -> Load:
        """A load to write tables into; nothing is visible before its ``commit``."""
        return Load(self, load_id)


class Load:
    """One load of a warehouse: tables are staged, then committed together."""

    def __init__(self, warehouse: Warehouse, load_id: str) -> None:
        self.warehouse, self.load_id = warehouse, load_id
        self.name = uuid.uuid4().hex[:12]  # an attempt's own folders: a broken one leaves nothing that is read
        self.before = warehouse.version()
        self.writes = 0
        self.staged: dict[str, dict[str, str]] = {}
        self.gone: dict[str, set[str] | None] = {}  # partitions whose earlier folders go; None: all

    def write(self, table: str, df: DataFrame, partition_by: str | None = None, replace_all: bool = False,
              append: bool = False, parts: list | None = None) -> DataFrame:
        """Stages a table and returns what was written.

        Without ``partition_by`` the whole table is replaced. With it, the partitions that ``df`` holds are (all,
        with ``replace_all``; also those of ``parts``, which may be left without rows); with ``append`` they keep
        what they hold. A partition column holds whole numbers (years, months, versions).
        """
        root = f"{self.warehouse.path}/{table}"
        name = f"{self.name}-{self.writes}"
        self.writes += 1
        if partition_by:
            # rebalanced by the partition column: files follow the data's size, not tasks x partitions
            (df.hint("rebalance", partition_by).withColumn(LOAD, F.lit(name)).write.mode("append")
             .option("maxRecordsPerFile", 5_000_000).partitionBy(partition_by, LOAD).parquet(root))
            mine = self._partitions(table, partition_by, name)
        else:
            mine = {"": f"{table}/{LOAD}={name}"}
            df.write.parquet(f"{root}/{LOAD}={name}")
        if not mine and (replace_all or table not in self.warehouse._folders()) and not self.staged.get(table):
            mine = {NULL_PART: f"{table}/{partition_by}={NULL_PART}/{LOAD}={name}"}  # no rows: an empty file keeps the schema
            df.drop(partition_by).limit(0).write.parquet(f"{self.warehouse.path}/{mine[NULL_PART]}")
        gone = self.gone.setdefault(table, set())
        if replace_all or not partition_by:
            self.gone[table] = None
        elif gone is not None and not append:
            gone.update(mine, map(str, parts or []))
        # a folder's name in the manifest: its partition, and the load if there are others beside it
        self.staged.setdefault(table, {}).update({f"{p}+{name}" if append else p: f for p, f in mine.items()})
        return self.warehouse._open(table, mine) if mine else df.limit(0)

    def _partitions(self, table: str, by: str, name: str) -> dict[str, str]:
        """The partitions that this load has written: their names and folders."""
        root = f"{self.warehouse.path}/{table}"
        try:
            rows = self.warehouse.spark.read.option("basePath", root).parquet(f"{root}/{by}=*/{LOAD}={name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        found = rows.select(F.coalesce(F.col(by).cast("string"), F.lit(NULL_PART)).alias("part")).distinct().collect()  # a row a partition
        return {r["part"]: f"{table}/{by}={r['part']}/{LOAD}={name}" for r in found}

    def commit(self) -> int:
        """Makes the staged tables visible, with the folders of all others as they were; returns the version."""
        live = self.warehouse._folders() if self.before else {}
        for table, mine in self.staged.items():
            gone = self.gone[table]
            kept = {} if gone is None else {p: f for p, f in live.get(table, {}).items() if p.split("+")[0] not in gone}
            live[table] = kept | mine
        version = self.before + 1
        rows = [(version, self.load_id, t, p, f) for t, parts in live.items() for p, f in parts.items()]
        manifest = self.warehouse.spark.createDataFrame(rows, MANIFEST)
        # one file, written last; fails if another writer has committed this version
        manifest.coalesce(1).write.mode("errorifexists").parquet(f"{self.warehouse.path}/_manifests/version={version}")
        return version
