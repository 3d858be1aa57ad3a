"""Operator 9: benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

Method
------
1. ``seeds``: the n-grams of each test item's words (letters and digits, lower case).
2. ``seed_hits``: one pass over all texts finds where they hold one. Documents are
   counted for each n-gram; an item is looked up by its *rare* ones: those in at most
   ``RARE`` of the documents, and in any case the rarer half of its own. Its other n-grams
   count where two of them lie near one diagonal, so that an item that very many
   documents copy is found in edited copies, too.
3. ``passages``: hits of one document and item near one diagonal make one passage,
   long enough to hold the whole item with insertions; it is cut out of the document.
4. ``aligned``: Smith-Waterman (match 2, other word -1, gap -1) of passage and item; the
   score is divided by that of the item with itself. ``matches`` keeps scores of
   ``LEAST`` or more: exact, edited and partly paraphrased copies.

Scale: seeds are sent to the tasks while their counted size allows it, else the
documents' n-grams are joined to them by a shuffle; a passage is a row and meets its
item by a join, so no task needs all items and no row grows with a document's hits. Documents with passages are found by a broadcast of
their hashes while these are few (by size), else by a shuffle. No document is compared
with an item that it shares no rare n-gram with, and none is left out for having many.

Cases: null texts are empty; items without words match nothing, items shorter than
``N`` words are one n-gram as a whole (of their own length); repeated rows and rows
that share a ``doc_id`` are judged by themselves (equal rows alike); a null ``doc_id`` or
``item_id`` is kept as it is; other columns are ignored (``clean`` passes them through);
empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import few, free_name, written

N, RARE, LEAST = 3, 0.001, 0.5
WORDS = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of words, by their position."""
    out = h[:max(0, len(h) - n + 1)].copy()
    for k in range(1, n):
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[k:len(out) + k]
    return out + np.uint64(n)


def _seeds(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column("item"), b.column("text")):
                words = words_of(text.as_py() or "")
                g = _grams(_hashes(words), min(n, len(words))) if words else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item.as_py()] * len(g), pa.int64()), pa.array(g.view(np.int64)), pa.array(range(len(g)), pa.int32()),
                     pa.array([len(words)] * len(g), pa.int32())], ["item", "gram", "at", "words"])

    return run


def _hits(lengths: list[int], wanted: np.ndarray | None):
    """Positions of n-grams in texts; only of ``wanted`` (sorted) ones, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, grams, places = [], [], []
            for doc, text in zip(b.column("doc").to_pylist(), b.column("text")):
                h = _hashes(words_of(text.as_py()))
                for n in lengths:
                    g = _grams(h, n).view(np.int64)
                    at = np.arange(len(g)) if wanted is None else np.flatnonzero(wanted[np.searchsorted(wanted, g).clip(max=len(wanted) - 1)] == g)
                    docs.append(np.full(len(at), doc))
                    grams.append(g[at])
                    places.append(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), t) for x, t in ((docs, pa.int64()), (grams, pa.int64()), (places, pa.int32()))],
                ["doc", "gram", "pos"])

    return run


def align(passage: list[int], item: list[int]) -> tuple[float, int, int]:
    """Best local alignment: (score, first word, word after the last) in the passage."""
    a, b = np.asarray(passage), np.asarray(item)
    if not len(a) or not len(b):
        return 0.0, 0, 0

    def best(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
        j = np.arange(len(a) + 1)
        row, top, end = np.zeros(len(a) + 1, np.int64), 0, 0
        for w in b:
            new = np.maximum(row - 1, 0)  # a word of the item left out
            new[1:] = np.maximum(new[1:], row[:-1] + np.where(a == w, 2, -1))
            row = np.maximum.accumulate(new + j) - j  # words of the passage left out
            k = int(row.argmax())
            if row[k] > top:
                top, end = int(row[k]), k
        return top, end

    top, end = best(a, b)
    _, back = best(a[:end][::-1], b[::-1])
    return float(top), end - back, end


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each passage, a row a passage."""
    for b in batches:
        for doc, doc_id, text, passages in zip(*(b.column(c) for c in ("doc", "doc_id", "text", "passages"))):
            words = words_of(text.as_py())
            items, begins, parts = [], [], []
            for p in passages.as_py():
                begin = max(0, p["begin"])
                items.append(p["item"])
                begins.append(begin)
                parts.append(" ".join(words[begin:max(begin, p["end"])]))
            k = len(items)
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc.as_py()] * k, pa.int64()), pa.array([doc_id.as_py()] * k, pa.int64()), pa.array(items, pa.int64()), pa.array(begins, pa.int64()), pa.array(parts, pa.string())],
                ["doc", "doc_id", "item", "begin", "part"])


def _align(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, doc_id, name, begin, part, item_text in zip(*(b.column(c).to_pylist() for c in ("doc", "doc_id", "item", "begin", "part", "item_text"))):
                item = words_of(item_text)
                number = {w: i for i, w in enumerate(set(item))}
                score, first, end = align([number.get(w, -1) for w in part.split()], [number[w] for w in item])
                if score >= least * 2 * len(item):
                    out.append((doc, doc_id, name, begin + first, begin + end, score / (2 * len(item))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                ["doc", "doc_id", "item_id", "first_word", "end_word", "score"])

    return run


def matches(docs: DataFrame, benchmark: DataFrame, n: int = N, rare: float = RARE, least: float = LEAST) -> DataFrame:
    """(doc, doc_id, item_id, first_word, end_word, score): the best place of each item in each document that
    holds a copy. ``doc`` is a hash of the row; places count words (end exclusive)."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    items = benchmark.select(F.xxhash64("item_id", "text").alias("item"), F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text"))
    seeds = written(items.select("item", F.col("item_text").alias("text")).dropDuplicates(["item"])
                    .mapInArrow(_seeds(n), "item long, gram long, at int, words int"), "seeds")
    lengths = sorted(min(n, r["words"]) for r in seeds.select(F.least("words", F.lit(n)).alias("words")).distinct().collect())  # n of them at most
    shape = "doc long, gram long, pos int"
    grams = seeds.select("gram").distinct()
    if few(grams, 8):
        wanted = np.sort(np.array([r["gram"] for r in grams.collect()], np.int64))
        hits = rows.select("doc", "text").mapInArrow(_hits(lengths, wanted), shape) if len(wanted) else rows.limit(0).selectExpr("doc", "doc as gram", "0 as pos")
    else:
        hits = rows.select("doc", "text").mapInArrow(_hits(lengths, None), shape).join(grams, "gram").select("doc", "gram", "pos")
    hits = written(hits, "hits")

    # rare: in few documents, or of the rarer half of an item's own; of the others two must lie near one diagonal
    held = hits.select("gram", "doc").distinct().groupBy("gram").agg(F.count("*").alias("df"))
    limit = max(20.0, rare * rows.count())
    by_rarity = Window.partitionBy("item").orderBy("df", "gram", "at")
    chosen = (seeds.join(held, "gram").withColumn("place", F.row_number().over(by_rarity))
              .withColumn("of", F.count("*").over(Window.partitionBy("item")))
              .select("item", "gram", "at", "words", ((F.col("df") <= limit) | (2 * F.col("place") <= F.col("of") + 1)).alias("rare")))
    chosen = written(chosen, "rare-seeds")

    diagonal = F.col("pos") - F.col("at")
    # bands of diagonals overlap by half, so that two hits near each other share one
    band = F.explode(F.array(F.floor(2 * diagonal / F.col("words")), F.floor(2 * diagonal / F.col("words")) + 1))
    passages = (hits.join(chosen, "gram").withColumn("diagonal", diagonal).withColumn("band", band)
                .groupBy("doc", "item", "band", "words")
                .agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.max("rare").alias("rare"), F.count("*").alias("n"))
                .filter((F.col("rare") & (F.col("band") % 2 == 0)) | (F.col("n") > 1))
                .groupBy("doc").agg(F.collect_list(F.struct(
                    "item", (F.col("low") - F.col("words") / 2).cast("int").alias("begin"),
                    (F.col("high") + F.col("words") * 1.5).cast("int").alias("end"))).alias("passages")))
    passages = written(passages, "passages")
    found = passages.select("doc")
    suspects = rows.join(F.broadcast(found), "doc", "left_semi") if few(found, 16) else rows
    parts = (suspects.dropDuplicates(["doc"]).join(passages, "doc").select("doc", "doc_id", "text", "passages")
             .mapInArrow(_cut, "doc long, doc_id long, item long, begin long, part string").dropDuplicates(["doc", "item", "begin", "part"]))
    texts_of = items.select("item", "item_text").dropDuplicates(["item"])
    aligned = (parts.join(texts_of, "item").select("doc", "doc_id", "item", "begin", "part", "item_text")
               .mapInArrow(_align(least), "doc long, doc_id long, item_id long, first_word long, end_word long, score double"))
    best = (aligned.groupBy("doc", "doc_id", F.col("item_id").alias("item"))
            .agg(F.max(F.struct("score", (-F.col("first_word")).alias("first"), "end_word")).alias("b")))
    return (best.join(items.select("item", "item_id").dropDuplicates(["item"]), "item")
            .select("doc", "doc_id", "item_id", (-F.col("b.first")).alias("first_word"), F.col("b.end_word").alias("end_word"), F.col("b.score").alias("score")))


def clean(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``docs`` without the documents that hold a copy of a test item."""
    leaks = written(matches(docs, benchmark, **parameters).select("doc").distinct(), "leaks")
    key = free_name(docs, "doc")
    leaks = leaks.withColumnRenamed("doc", key)
    return docs.withColumn(key, F.xxhash64("doc_id", "text")).join(F.broadcast(leaks) if few(leaks, 16) else leaks, key, "left_anti").drop(key)
