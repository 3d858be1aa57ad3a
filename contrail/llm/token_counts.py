"""Operator 1: token counts as delta-maintained rollups.

Method
------
A batch of changes (``op``: insert, delete or revise) becomes signed rows: an insert
adds a document's count, a delete takes away the count on record, a revision does both.
The signed rows summed by source, language and tokenizer version are the batch's
delta; totals are the sum of the deltas of committed batches, so no document is
counted twice and none is read again for the totals.

A rollup is a folder with, for each batch, ``ledger/<batch>`` (signed rows by
document, which later deletes and revisions look up), ``deltas/<batch>`` (sums) and
``manifest/<batch>``, one row that is written last: a batch is committed when it is
there. Committing it again changes nothing; a batch that failed half way left no
manifest and is written anew. Batches commit one after another.

Counting: ``count_tokens`` with a byte-level BPE of a public tokenizer file
(tiktoken ranks; the version is the file's name), in Arrow batches.

Scale: deltas are a few rows a batch. The ledger is parted by a hash of the document
(``PARTS``); a batch reads the parts that hold its documents and looks them up by an
equi-join; all sums are partial sums. Long chains of deltas are summed into one by
``compact``.

Cases: null texts count 0 tokens; null source or language are groups of their own;
rows without a doc_id are documents of their own each (equal ones are counted as often
as they stand there), which later changes cannot name: a delete without an id takes
nothing away, a revision without one inserts. Deletes and revisions of documents that are
not on record take nothing away (a revision then inserts); inserts of documents on
record are revisions; of several changes to one document in a batch the last by
``seq`` counts (then the one with the larger text hash); extra columns are ignored;
empty batches commit an empty delta.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import written

KEY = ["source", "lang", "version"]
LEDGER = "doc_id long, source string, lang string, version string, docs long, tokens long"
PARTS = 64  # folders of a batch's ledger
MANIFEST = "batch string, number long, replaces boolean"
DELTA = "source string, lang string, version string, docs long, tokens long"


@lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("counted", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (doc_id, text, and others) with ``tokens`` in place of ``text``."""
    others = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path)
        for b in batches:
            n = [len(encoding.encode_ordinary(t.as_py() or "")) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in others] + [pa.array(n, pa.int64())], [*others, "tokens"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.select(*others, "text").mapInArrow(run, f"{schema}, tokens long")


class Rollup:
    """Token totals by source, language and tokenizer version in a shared folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def batches(self) -> list[str]:
        """The committed batches that make up the totals, in order."""
        try:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/*").orderBy("number").collect()  # a row a batch
        except AnalysisException:  # none yet
            return []
        whole = [i for i, r in enumerate(rows) if r["replaces"]]
        return [r["batch"] for r in rows[whole[-1] if whole else 0:]]

    def _numbers(self) -> int:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/*").agg(F.max("number")).first()[0] or 0
        except AnalysisException:
            return 0

    def committed(self, batch: str) -> bool:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/{batch}").limit(1).count() == 1
        except AnalysisException:
            return False

    def _all(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{kind}/{b}" for b in self.batches()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _finish(self, batch: str, signed: DataFrame, replaces: bool) -> None:
        number = self._numbers() + 1
        (signed.withColumn("part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"), F.lit(-1)))
         .hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/ledger/{batch}"))
        ledger = self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/{batch}")
        (ledger.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
         .write.mode("overwrite").parquet(f"{self.path}/deltas/{batch}"))
        one = self.spark.range(1).select(F.lit(batch).alias("batch"), F.lit(number).cast("long").alias("number"), F.lit(replaces).alias("replaces"))
        one.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{batch}")

    def on_record(self, parts: list[int] | None = None) -> DataFrame:
        """(doc_id, source, lang, version, docs, tokens): what the committed batches hold of each document,
        of some parts of the ledger or all. Rows without an id are summed up by source, language and version."""
        ledger = None
        for b in self.batches():
            one = self.spark.read.option("basePath", f"{self.path}/ledger/{b}").schema(f"{LEDGER}, part int").parquet(f"{self.path}/ledger/{b}")
            ledger = one if ledger is None else ledger.union(one)
        if ledger is None:
            return self.spark.createDataFrame([], LEDGER)
        if parts is not None:
            ledger = ledger.filter(F.col("part").isin(parts))
        return (ledger.groupBy("doc_id", *KEY).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .filter("docs <> 0 OR tokens <> 0"))

    def commit(self, batch: str, changes: DataFrame, version: str, path: str) -> bool:
        """Applies a batch (op, seq, doc_id, source, lang, text); False if it was committed before."""
        if self.committed(batch):
            return False
        text = F.when(F.col("op") == "delete", "").otherwise(F.coalesce("text", F.lit("")))
        counted = count_tokens(changes.select("op", "seq", F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.xxhash64("text").alias("th"), text.alias("text")), path)
        counted = written(counted, "counted")
        last = (counted.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.struct("seq", "th", "op", "source", "lang", "tokens")).alias("x")).select("doc_id", "x.*"))
        last = written(last, "changes")
        no_id = (counted.filter("doc_id IS NULL AND op <> 'delete'").groupBy("source", "lang").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))
                 .select(F.lit(None).cast("long").alias("doc_id"), "source", "lang", F.lit(version).alias("version"), "docs", "tokens"))
        signed = last.filter("op <> 'delete'").select("doc_id", "source", "lang", F.lit(version).alias("version"), F.lit(1).cast("long").alias("docs"), "tokens").union(no_id)
        if self.batches():
            parts = [r[0] for r in last.select(F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")).distinct().collect()]  # PARTS at most
            old = self.on_record(parts).join(last.select("doc_id"), "doc_id", "left_semi")
            signed = signed.union(old.select("doc_id", *KEY, -F.col("docs"), -F.col("tokens")))
        self._finish(batch, signed, False)
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens): the sums of all committed deltas; groups that are empty again are left out."""
        return self._all("deltas", DELTA).groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 OR tokens <> 0")

    def compact(self, into: str) -> None:
        """Writes the records as one batch, which takes the place of all batches before."""
        if not self.committed(into):
            self._finish(into, self.on_record(), True)
