"""Operator 13: ranked lexical search by dense blocked matrix multiplication.

Method
------
Every item is scored against every document by a product of dense tiles. The
items come in blocks of bounded bytes; an item tile has a compact vocabulary of
its own (the terms of its items, numbered from 0), so its matrix of term weights
is dense and small. Documents are held as counts of the block's terms; a batch of
them becomes a dense tile of impacts, and weights times impacts is one BLAS call in
float64. Weights and impacts are whole numbers, and a product covers so few terms
that its partial sums stay below 2^53: every sum is exact, in any order. Sums of
several products are added as 64-bit integers. Each task keeps the best ``k`` of
each item over its tiles, by score and then by ascending ``doc_id``, so that equal
scores at the border of a tile or task are decided as in the whole; the tasks'
best are ranked in two rounds of windows over bounded groups.

Scores: a term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), its impact in a
document (1000000000 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L (whole numbers).

Scale: one pass over the texts for each block of items (``BLOCK_BYTES`` of item
text; the driver sees one block at a time, its terms, and their document counts),
which writes counts of the block's terms, and one over these counts. Nothing is
shuffled but document counts by term and the tasks' best rows.

Cases: a null text has no terms; documents without terms count neither in N nor in
results; items without terms, or of which no document holds a term that weighs,
have no rows; rows that share a ``doc_id`` are documents of their own, and items that
share an ``item_id`` are ranked each by itself; a null ``doc_id`` comes after all others
of the same score; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import texts, written

BLOCK_BYTES = 4 << 20  # item text whose terms and weights a task holds
ITEM_TILE = 64  # items whose terms make one compact vocabulary, at most
TILE_CELLS = 1 << 20  # weights in the matrix of an item tile of more than one item
TERM_TILE = 2048  # terms in a product at most
DOC_TILE = 512  # documents in a product
EXACT = 1 << 53  # whole numbers up to here are exact in float64
IMPACT = 1_000_000  # no impact is larger
NO_ID = (1 << 63) - 1  # stands for a null doc_id
FAN_IN = 256  # tasks whose best rows meet in the first round
#: A-Z to lower case; other bytes below 128 that are neither letters nor digits to a blank.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters and digits and of all else from U+0080 on."""
    return text.translate(TABLE).split()


def _bytes(s: pa.Scalar) -> bytes:
    return s.as_buffer().to_pybytes()


def _count(vocabulary: dict[bytes, int]):
    """Of each text with terms: number of terms, and the block's terms in it with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, ns, found = [], [], []
            for i, t in enumerate(b.column("text")):
                words = terms(_bytes(t))
                if words:
                    at.append(i)
                    ns.append(len(words))
                    found.append(np.unique(np.array([vocabulary[w] for w in words if w in vocabulary], np.int32), return_counts=True))
            ends = pa.array(np.cumsum([0, *(len(c) for c, _ in found)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([x[k] for x in found] or [np.zeros(0)]).astype(kind)))
                     for k, kind in ((0, np.int32), (1, np.int64))]
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(at, pa.int32())), pa.array(ns, pa.int64()), *lists], ["id", "n", "terms", "counts"])

    return run


class ItemTile:
    """Items first..: their compact vocabulary (sorted numbers of the block's terms) and the matrix of weights."""

    def __init__(self, first: int, items: list[list[int]], weights: np.ndarray) -> None:
        self.first = first
        mine = np.unique(np.concatenate([np.array(x, np.int64) for x in items] or [np.zeros(0, np.int64)]))
        self.terms = mine[weights[mine] > 0]
        self.weights = np.zeros((len(items), len(self.terms)))
        for i, x in enumerate(items):
            ids = np.array([t for t in x if weights[t] > 0], np.int64)
            self.weights[i, np.searchsorted(self.terms, ids)] = weights[ids]
        largest = int(self.weights.max(initial=1))
        self.width = max(1, min(TERM_TILE, (EXACT - 1) // (largest * IMPACT)))  # so that partial sums are exact

    def scores(self, rows: np.ndarray, terms_: np.ndarray, impacts: np.ndarray, documents: int) -> np.ndarray:
        """Scores of the items (down) in the documents (across), from the impacts' rows and terms."""
        out = np.zeros((len(self.weights), documents), np.int64)
        place = np.searchsorted(self.terms, terms_)
        place[place == len(self.terms)] = 0
        mine = self.terms[place] == terms_ if len(self.terms) else np.zeros(len(terms_), bool)
        rows, place, impacts = rows[mine], place[mine], impacts[mine]
        for begin in range(0, len(self.terms), self.width):
            part = (place >= begin) & (place < begin + self.width)
            tile = np.zeros((min(self.width, len(self.terms) - begin), documents))
            tile[place[part] - begin, rows[part]] = impacts[part]
            out += (self.weights[:, begin:begin + self.width] @ tile).astype(np.int64)
        return out


class Best:
    """The best k (score, id) of an item so far: higher scores, then smaller ids."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        floor = self.scores[-1] if len(self.scores) == self.k else 1
        at = np.flatnonzero(scores >= floor)
        if len(at):
            s, i = np.concatenate([self.scores, scores[at]]), np.concatenate([self.ids, ids[at]])
            order = np.lexsort((i, -s))[:self.k]
            self.scores, self.ids = s[order], i[order]


def _multiply(tiles: list[ItemTile], n_items: int, n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in range(n_items)]
        for whole in batches:
            for begin in range(0, whole.num_rows, DOC_TILE):
                b = whole.slice(begin, DOC_TILE)
                ids = b.column("id").to_numpy(zero_copy_only=False)
                m = np.array([10 + 90 * n * n_docs // n_terms for n in b.column("n").to_pylist()], np.int64)  # Python's whole numbers: no overflow
                lists = b.column("terms")
                rows = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
                tf = b.column("counts").flatten().to_numpy()
                impacts = 1_000_000_000 * tf // (1000 * tf + 8 * m[rows])
                for tile in tiles:
                    scores = tile.scores(rows, lists.flatten().to_numpy(), impacts, b.num_rows)
                    for i in np.flatnonzero(scores.any(axis=1)):
                        best[tile.first + i].add(scores[i], ids)
        found = [(i, x, s) for i, kept in enumerate(best) for x, s in zip(kept.ids.tolist(), kept.scores.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else ([], [], []), (pa.int32(), pa.int64(), pa.int64()))], ["item", "id", "score"])

    return run


def _ranked(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _tiles(of_items: list[list[int]], weights: np.ndarray) -> list[ItemTile]:
    """Items in tiles of bounded cells (items times terms)."""
    tiles, begin, n = [], 0, 0
    for i, x in enumerate(of_items):
        if i > begin and (i - begin == ITEM_TILE or (i + 1 - begin) * (n + len(x)) > TILE_CELLS):
            tiles.append(ItemTile(begin, of_items[begin:i], weights))
            begin, n = i, 0
        n += len(x)
    return [*tiles, ItemTile(begin, of_items[begin:], weights)]


def _search_block(spark, documents: DataFrame, items: list, n_docs: int | None, n_terms: int | None, k: int):
    """(item, rank, id, score) of one block of items, N and L."""
    vocabulary: dict[bytes, int] = {}
    of_items = [sorted({vocabulary.setdefault(w, len(vocabulary)) for w in terms((r["text"] or "").encode())}) for r in items]
    counts = written(documents.mapInArrow(_count(vocabulary), "id long, n long, terms array<int>, counts array<long>"), "term-counts")
    if n_docs is None:
        n_docs, n_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for t, n in counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*")).toLocalIterator():  # a row a term of the block
        df[t] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) if n else 0 for n in df], np.int64)
    tiles = _tiles(of_items, weights)
    best = counts.filter(F.size("terms") > 0).mapInArrow(_multiply(tiles, len(items), n_docs, n_terms, k), "item int, id long, score long")
    best = _ranked(best.withColumn("group", F.floor(F.spark_partition_id() / FAN_IN)), ["group", "item"], k).drop("group", "rank")
    return _ranked(best, ["item"], k), n_docs, n_terms


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of the highest score above 0, equal scores by ascending doc_id."""
    spark = docs.sparkSession
    documents = texts(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text")
    items = written(items.select("item_id", F.coalesce("text", F.lit("")).alias("text")), "items")
    blocks = math.ceil((items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0) / BLOCK_BYTES)
    out, n_docs, n_terms = None, None, None
    for block in range(max(blocks, 1)):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))) == block).collect()  # about BLOCK_BYTES
        found, n_docs, n_terms = _search_block(spark, documents, mine, n_docs, n_terms, k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(mine)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        found = (found.join(F.broadcast(names), "item")  # a row an item of the block
                 .select("item_id", "rank", F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "score"))
        out = found if out is None else out.union(found)
    return out
