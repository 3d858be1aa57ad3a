"""Operator 10: removal of repeated passages by level-wise doubling.

Method
------
A window is a run of ``window`` words, of any number. Levels go from a short length
(``BASE_WORDS`` words at most) by doubling up to it: 13, 25 and 50 words for 50 (``lengths``). On
each level, of the windows of its length in each full window the one with the
smallest hash stands for it, so that equal full windows always share theirs
while only few windows travel. Those that repeat in another document survive, and
only full windows that one of them stands for are looked at on the next level, at twice the length, until no
candidates are left or the full length is reached. A full window that also starts in a
document with a smaller ``doc_id`` covers its words, and covered words go.

Scale: documents with equal word sequences are one candidate (the smallest
``doc_id`` stands for them, the others lose every word if they hold a window).
Repeats are counted by aggregates with partial sums, written, and looked up by
equi-joins of two scans, which Spark can split, so a passage in a third of all documents is no task's work.
Windows travel as 64-bit hashes. Texts are shuffled only for documents with
survivors (whose ids are broadcast while they are few, by size).

Cases: a null text has no words; texts shorter than a window keep every word; a
null ``doc_id`` counts as larger than all others, and rows with equal ids are one
document for the comparison (neither is smaller) but have a row each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import few, texts, written

#: An odd multiplier of the rolling hash, and its inverse modulo 2^64 (fixed values).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
LAST = (1 << 63) - 1  # stands for a null doc_id
BASE_WORDS = 16  # words of the first level at most
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64; kept and doubled as longer texts come."""
    if len(_powers.get(base, ())) <= n:
        p = np.full(max(2 * n, 4096), base, np.uint64)
        p[0] = 1
        _powers[base] = np.multiply.accumulate(p)
    return _powers[base][:n + 1]


def _words(text: str) -> list[bytes]:
    return text.encode().split()  # bytes split at blank and \t \n \v \f \r


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _windows(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` words."""
    n = len(words)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * _power(INVERSE, n)[:n], out=sums[1:])
    return (sums[length:] - sums[:n + 1 - length]) * _power(BASE, n)[length - 1:n]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def _sequence(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(flat))


def _sketch(base: int, window: int):
    """Of each text: number of words, hash of the sequence, distinct representative base windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, sequences, kept = [], [], []
            for t in b.column("text"):
                words = _words(t.as_py())
                counts.append(len(words))
                sequences.append(_sequence(words))
                kept.append(np.unique(_least(_windows(_hashes(words), base), window - base + 1)) if len(words) >= window else np.zeros(0, np.uint64))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("th"), pa.array(counts, pa.int64()), pa.array(sequences, pa.binary()), _lists(kept)],
                ["id", "th", "n_words", "sequence", "bases"])

    return run


def lengths(window: int) -> list[int]:
    """Window lengths by level: the full one halved (rounded up) until it has ``BASE_WORDS`` words at most, shortest first."""
    out = [window]
    while out[-1] > BASE_WORDS:
        out.append(-(-out[-1] // 2))
    return out[::-1]


def _alive(hashes: np.ndarray, length: int, window: int, survivors: pa.Scalar) -> np.ndarray:
    """Where the full windows start that a surviving window of this length stands for."""
    return np.flatnonzero(np.isin(_least(_windows(hashes, length), window - length + 1), np.asarray(survivors.values).view(np.uint64)))


def _level(shorter: int, longer: int, window: int):
    """Of each text's full windows that survived at one length, the distinct ones of twice that length that stand for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = []
            for t, survivors in zip(b.column("text"), b.column("bases")):
                h = _hashes(_words(t.as_py()))
                kept.append(np.unique(_least(_windows(h, longer), window - longer + 1)[_alive(h, shorter, window, survivors)]))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), _lists(kept)], ["id", "th", "bases"])

    return run


def _extend(base: int, window: int):
    """The full windows that a surviving window of the last level before stands for: (hash, id, th, start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for id_, th, t, survivors in zip(*(b.column(c) for c in ("id", "th", "text", "bases"))):
                h = _hashes(_words(t.as_py()))
                starts = _alive(h, base, window, survivors)
                full = _windows(h, window)[starts]
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [_signed(full), pa.array(np.full(n, id_.as_py())), pa.array(np.full(n, th.as_py())), pa.array(starts, pa.int32())],
                    ["hash", "id", "th", "start"])

    return run


def _remove(window: int):
    """Drops covered words: (doc_id, n_words, n_removed, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, removed, kept = [], [], []
            for t, copy, starts in zip(*(b.column(c) for c in ("text", "copy", "starts"))):
                words = _words(t.as_py())
                gone = len(words) * (copy.as_py() and len(words) >= window)
                if not gone and starts.is_valid:
                    edges = np.zeros(len(words) + 1, np.int64)
                    at = np.asarray(starts.values)
                    np.add.at(edges, at, 1)
                    np.add.at(edges, at + window, -1)
                    covered = np.cumsum(edges[:-1]) > 0
                    gone = int(covered.sum())
                    rest = [w for w, c in zip(words, covered.tolist()) if not c]
                else:
                    rest = [] if gone else words
                counts.append(len(words))
                removed.append(gone)
                kept.append(b" ".join(rest).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "text"])

    return run


def dedup(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, text): each text without its repeated windows' words."""
    if window < 1:
        raise ValueError("a window has one word or more")
    levels = lengths(window)
    rows = texts(docs).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64("text").alias("th"), "text")
    sketch = written(rows.select("id", "th", "text").mapInArrow(
        _sketch(levels[0], window), "id long, th long, n_words long, sequence binary, bases array<long>"), "windows")

    # documents with the same words: one stands for all
    firsts = sketch.groupBy("sequence").agg(F.min(F.struct("id", "th")).alias("first"))
    members = (sketch.select("id", "th", "sequence").distinct().join(firsts, "sequence")
               .select("id", "th", F.col("first.id").alias("first_id"), F.col("first.th").alias("first_th")))
    alone = sketch.filter(F.size("bases") > 0).join(
        firsts.select(F.col("first.id").alias("id"), F.col("first.th").alias("th")), ["id", "th"], "left_semi").dropDuplicates(["id", "th"])

    def repeated(candidates: DataFrame) -> DataFrame:
        """(id, th, bases): of each text, the windows that repeat in another document."""
        bases = candidates.select("id", "th", F.explode("bases").alias("hash"))
        again = written(bases.groupBy("hash").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("hash"), "repeated")
        return written(bases.join(again, "hash").groupBy("id", "th").agg(F.collect_list("hash").alias("bases")), "survivors")

    def with_texts(survivors: DataFrame) -> DataFrame:
        by_doc, ids = rows.select("id", "th", "text"), survivors.select("id", "th")
        if few(ids):  # only texts with survivors are shuffled
            by_doc = by_doc.join(F.broadcast(ids), ["id", "th"], "left_semi")
        return by_doc.join(survivors, ["id", "th"])

    survivors = repeated(alone)
    for shorter, longer in zip(levels, levels[1:-1]):
        survivors = repeated(with_texts(survivors).mapInArrow(_level(shorter, longer, window), "id long, th long, bases array<long>"))
    # the full length: windows that repeat cover words of all documents but the first
    full = with_texts(survivors).mapInArrow(_extend(levels[-2] if len(levels) > 1 else window, window), "hash long, id long, th long, start int")
    first = written(full.groupBy("hash").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("hash", "a"), "first")
    covered = written(
        full.join(first, "hash").filter("id > a").groupBy("id", "th").agg(F.collect_list("start").alias("starts")), "covered")

    fate = written(members.join(covered.withColumnsRenamed({"id": "first_id", "th": "first_th"}), ["first_id", "first_th"], "left")
                   .select("id", "th", (F.col("id") > F.col("first_id")).alias("copy"), "starts").filter("copy OR starts IS NOT NULL"), "fate")
    ids = fate.select("id", "th")
    judged = ["doc_id", "text", "copy", "starts"]
    if few(ids):  # texts that keep every word need no shuffle
        out = (rows.join(F.broadcast(ids), ["id", "th"], "left_semi").join(fate, ["id", "th"]).select(judged)
               .union(rows.join(F.broadcast(ids), ["id", "th"], "left_anti").select("doc_id", "text", F.lit(False), F.lit(None).cast("array<int>"))))
    else:
        out = rows.join(fate, ["id", "th"], "left").withColumn("copy", F.coalesce("copy", F.lit(False))).select(judged)
    return out.mapInArrow(_remove(window), "doc_id long, n_words long, n_removed long, text string")


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
