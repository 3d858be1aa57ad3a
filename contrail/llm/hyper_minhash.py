"""Operator 11: near duplicates by HyperMinHash sketches.

Method
------
A document's set holds the hashes of its distinct word n-grams. In each of
``PERMUTATIONS`` orders the hash space is dealt to ``BUCKETS`` buckets (few, so that the
buckets of short documents fill, too); a register keeps the least hash of its bucket in
16 bits, the number of its leading zeros and ``MANTISSA`` bits that follow the first one. Bands of ``ROWS`` compressed registers are the keys of a first search. Documents
that meet there are compared by all registers: the share of equal ones, less the
equal ones expected by chance between sets of these sizes, estimates their Jaccard
similarity, and pairs whose estimate is not far below the threshold are verified on
their full sets.

Steps
-----
1. Sketch. Equal sets become one node. A node's bands are its keys.
2. A key of more than ``CROWD`` nodes (a passage that a great many documents share makes
   such keys) is refined: its nodes are dealt again by the key and one of the ``STEPS`` next
   bands, for up to ``DEPTH`` times. A pair that links agrees in so many bands that it stays
   together in some of these keys.
3. Each node names a root, the smallest node that it shares a key with. A node goes to
   the unit of a root if nodes that name it are in its keys in ``AGREE`` bands or more, so
   that two nodes that agree in so many bands meet in a unit, while a group of copies makes
   one unit, not a unit for each pair or key. A large unit is dealt as a grid: its nodes go to blocks of bounded
   size and each pair of blocks is compared by itself.
4. In a unit, pairs are picked by their estimates and verified by a product of the
   blocks' incidence matrices, which gives exact overlaps. A unit gives a star for each
   connected part; connected components of the stars are the classes.

Chance of a miss: at a similarity of exactly 0.85 and full registers a band agrees with
probability 0.85^6 = 0.377, and fewer than ``AGREE`` of 42 bands agree with 3e-7; for sets
smaller than the number of registers bands agree more often (small sets have few bands that
are not empty: from those below ``SMALL`` one agreement less is asked for). The estimate may lie ``SIGMAS`` standard
deviations (of a share of the registers that are in use) below the threshold.

Scale: what is shuffled is linear in the documents: a key a band, and sets only of
nodes that share a key with another one, once a unit and block. No pairs are emitted.
Sets travel as 64-bit hashes and are read from the texts of those nodes alone.

Cases: null and empty texts, and texts without words, have an empty set and are their
own component; texts with fewer words than ``n`` are one n-gram as a whole; rows with a
null ``doc_id`` take no part in links and have a null component, and ``kept`` is true for
them; rows that share a ``doc_id`` are one document with several sets; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import few, texts, written
from contrail.llm.components import components
from contrail.llm.jaccard_join import shingles

PERMUTATIONS, BUCKETS = 16, 16
REGISTERS = PERMUTATIONS * BUCKETS
MANTISSA = 10  # bits of a register after its leading zeros (6 bits)
ROWS = 6  # registers in a band
BANDS = REGISTERS // ROWS
CROWD = 4096  # a key of more nodes is refined
STEPS = 6  # bands after a key's last one that refine it
DEPTH = 3
AGREE, SMALL = 3, 32  # bands in which nodes must agree to be compared; members of a small set
BLOCK = 512  # nodes of a unit that meet in a block, on average
BLOCK_MEMBERS = 1 << 20  # and members of their sets
SIGMAS = 6.5
TILE = 4096  # columns of an incidence matrix at a time
MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed odd number
SEEDS = np.array([int(MIX) * (2 * k + 1) * (2 * k + 1) % (1 << 64) for k in range(1, PERMUTATIONS + 1)], np.uint64)  # of the orders
CHUNK = 1 << 14  # members that are ordered at a time
#: Expected share of equal registers by chance is this over 2^MANTISSA, times 4q / (1 + q)^2 for sizes of ratio q (constant of the sketch's paper).
CHANCE = 0.1699194871591


def registers(members: np.ndarray) -> np.ndarray:
    """Compressed registers of a set of hashes; 0 where a bucket is empty."""
    least = np.full(REGISTERS, 1 << 56, np.uint64)
    for begin in range(0, len(members), CHUNK):
        h = (members[begin:begin + CHUNK] ^ SEEDS[:, None]) * MIX
        h ^= h >> np.uint64(32)
        h *= MIX
        h ^= h >> np.uint64(29)
        bucket = (h & np.uint64(BUCKETS - 1)).astype(np.int64) + np.arange(PERMUTATIONS)[:, None] * BUCKETS
        np.minimum.at(least, bucket.ravel(), (h >> np.uint64(8)).ravel())  # 56 bits
    held = least < np.uint64(1 << 56)
    # the position of the first one: 56 bits are two halves that float64 holds exactly
    v = np.maximum(least, np.uint64(1))
    high, low = (v >> np.uint64(28)).astype(np.float64), (v & np.uint64((1 << 28) - 1)).astype(np.float64)
    length = np.where(high > 0, np.frexp(high)[1] + 28, np.frexp(low)[1]).astype(np.uint64)
    zeros = np.uint64(56) - length
    tail = v & ((np.uint64(1) << (length - np.uint64(1))) - np.uint64(1))  # what follows the first one
    shift = length.astype(np.int64) - 1 - MANTISSA
    tail = np.where(shift >= 0, tail >> np.maximum(shift, 0).astype(np.uint64), tail << np.maximum(-shift, 0).astype(np.uint64))
    packed = (np.minimum(zeros, np.uint64(62)) + np.uint64(1)) << np.uint64(MANTISSA) | tail
    return np.where(held, packed, np.uint64(0)).astype(np.uint16)


def band_keys(sketch: np.ndarray) -> list[int | None]:
    """A key for each band, None where all its registers are empty."""
    return [xxhash.xxh3_64_intdigest(part.tobytes(), seed=k) - (1 << 63) if part.any() else None
            for k, part in enumerate(sketch[:BANDS * ROWS].reshape(BANDS, ROWS))]


def estimates(one: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of a sketch with others, and the registers in use."""
    used = ((one != 0) | (others != 0)).sum(axis=1)
    equal = ((one == others) & (one != 0)).sum(axis=1)
    q = size / sizes
    chance = CHANCE / (1 << MANTISSA) * 4 * q / (1 + q) ** 2 * used
    return np.maximum(equal - chance, 0) / np.maximum(used, 1), used


def _sketch(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, sets, keys = [], [], []
            for t in b.column("text"):
                s = shingles(t.as_py(), n)
                sizes.append(len(s))
                sets.append(xxhash.xxh3_128_digest(s.tobytes()))
                keys.append(band_keys(registers(s)) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("th"), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "th", "size", "same", "keys"])

    return run


def _deal(n: int):
    """Each text's set, once for each unit that it goes to, in batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, text, units in zip(b.column("id").to_pylist(), b.column("text"), b.column("units")):
                s = shingles(text.as_py(), n).view(np.int64)
                step = max(1, BLOCK_MEMBERS // len(s))
                own = units.values
                for at in range(0, len(own), step):
                    part = own.slice(at, step)
                    ends = pa.array(np.arange(len(part) + 1) * len(s), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [part.field("unit"), part.field("half"), pa.array([node] * len(part), pa.int64()),
                         pa.ListArray.from_arrays(ends, pa.array(np.tile(s, len(part))))], ["unit", "half", "node", "grams"])

    return run


def _overlaps(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Exact sizes of the overlaps of some sets with all, by tiles of the incidence matrix of shared members."""
    flat, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    column = np.cumsum(counts > 1) - 1
    mine = counts[place] > 1
    owner, column = owner[mine], column[place[mine]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(rows), len(sets)), np.float32)  # whole numbers below 2^24 are exact
    last = int(column[-1]) + 1 if len(column) else 0
    for begin in range(0, last, TILE):
        part = slice(*np.searchsorted(column, (begin, begin + TILE)))
        tile = np.zeros((len(sets), min(TILE, last - begin)), np.float32)
        tile[owner[part], column[part] - begin] = 1
        out += tile[rows] @ tile.T
    return out


def unit_links(labels: list[int], halves: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A star for each connected part of a unit: (smallest label, other label). Nodes of half 0 meet
    those of half 1; nodes of half 2 (the unit is one block) meet each other."""
    sizes = np.array([len(s) for s in sets])
    sketches = np.array([registers(s) for s in sets])
    half = np.array(halves)
    low = percent / 100
    picked = np.zeros((len(sets), len(sets)), bool)
    for i in range(len(sets)):
        mine = (half == 1 if half[i] == 0 else (half == 2) & (np.arange(len(sets)) > i)) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        at = np.flatnonzero(mine)
        if len(at):
            estimate, used = estimates(sketches[i], int(sizes[i]), sketches[at], sizes[at])
            picked[i, at] = estimate >= low - SIGMAS * np.sqrt(low * (1 - low) / np.maximum(used, 1))
    rows = np.flatnonzero(picked.any(axis=1))
    if not len(rows):
        return []
    overlap = _overlaps(sets, rows)
    linked = picked[rows] & ((100 + percent) * overlap.astype(np.int64) >= percent * (sizes[rows][:, None] + sizes))
    root = {x: x for x in labels}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in zip(*np.nonzero(linked)):
        a, b = top(labels[rows[i]]), top(labels[j])
        root[max(a, b)] = min(a, b)
    return [(top(x), x) for x in root if top(x) != x]


def _join_units(percent: int):
    """Rows come sorted by unit; a unit is compared when its rows are complete."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, labels, halves, sets = None, [], [], []

        def finish() -> pa.RecordBatch:
            found = unit_links(labels, halves, sets, percent) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for b in batches:
            for u, h, node, grams in zip(b.column("unit").to_pylist(), b.column("half").to_pylist(), b.column("node").to_pylist(), b.column("grams")):
                if u != unit:
                    yield finish()
                    unit, labels, halves, sets = u, [], [], []
                labels.append(node)
                halves.append(h)
                sets.append(np.asarray(grams.values).view(np.uint64))
        yield finish()

    return run


def _keyed(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, base, key) and (key, least) of all keys that two nodes or more share, crowded ones refined; ``base`` is the first band."""
    bands = reps.select("node", F.posexplode("keys").alias("band", "key")).filter("key IS NOT NULL").withColumn("base", F.col("band"))
    done, heads = None, None
    for depth in range(DEPTH + 1):
        met = written(bands.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least")).filter("n > 1"), "met")
        placed = written(bands.join(F.broadcast(met.select("key", "n")) if few(met, 32) else met.select("key", "n"), "key"), "placed")
        kept = (F.col("n") <= CROWD) | F.lit(depth == DEPTH)
        rows, head = placed.filter(kept).select("node", "base", "key"), met.filter(kept).select("key", "least")
        done, heads = (rows, head) if done is None else (done.union(rows), heads.union(head))
        crowded = placed.filter(~kept)
        if crowded.isEmpty():
            break
        bands = (crowded.join(reps.select("node", "keys"), "node")
                 .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(STEPS))))
                 .withColumn("band", F.expr(f"(band + step) % {BANDS}"))
                 .select("node", "base", "band", F.xxhash64("key", "band", F.expr("keys[band]")).alias("key")))
    return done, heads


def _units(reps: DataFrame) -> DataFrame:
    """(node, units): the units and halves that each node goes to."""
    keyed, heads = _keyed(reps.select("node", "keys"))
    rooted = written(keyed.join(heads, "key").groupBy("node").agg(F.min("least").alias("root")), "roots")
    named = written(keyed.join(rooted, "node").select("key", "root").distinct(), "named")
    reached = keyed.join(named, "key").groupBy("node", F.col("root").alias("unit")).agg(F.countDistinct("base").alias("agree"))
    members = written(reached.join(reps.select("node", "size"), "node").filter(F.col("agree") >= F.when(F.col("size") < SMALL, AGREE - 1).otherwise(AGREE))
                      .select("node", "size", "unit"), "members")
    sized = (members.groupBy("unit").agg(F.count("*").alias("n"), F.sum("size").alias("m")).filter("n > 1")
             .select("unit", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("m") / BLOCK_MEMBERS)).cast("int").alias("blocks")))
    own = F.expr("CAST(pmod(xxhash64(node), blocks) AS INT)")
    sized = written(sized, "sized")
    # a node meets all blocks; its own one once, in a unit of its own
    return (members.join(F.broadcast(sized) if few(sized, 16) else sized, "unit").withColumn("own", own)
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("node", F.struct(F.xxhash64("unit", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
                                     F.expr("CASE WHEN own = other THEN 2 WHEN own < other THEN 0 ELSE 1 END").alias("half")).alias("unit"))
            .groupBy("node").agg(F.collect_list("unit").alias("units")))


def dedup(docs: DataFrame, n: int = 5, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents link when 100 * intersection >= percent * union."""
    rows = texts(docs).select("doc_id", F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"), "text")
    sketch = written(rows.select("id", "th", "text").mapInArrow(_sketch(n), "id long, th long, size long, same binary, keys array<long>"), "sketches")
    # equal sets are one node, named by the smallest id
    reps = written(sketch.filter("size > 0 AND id IS NOT NULL").groupBy("same").agg(F.min(F.struct("id", "th", "keys")).alias("first"), F.first("size").alias("size"))
                   .select(F.col("first.id").alias("node"), "first.th", "first.keys", "size", "same"), "nodes")
    units = written(_units(reps).withColumnRenamed("node", "id").join(reps.select(F.col("node").alias("id"), "th").distinct(), "id"), "units")
    ids = units.select("id", "th").distinct()
    mine = rows.select("id", "th", "text")
    if few(ids):  # only texts that go to units are shuffled
        mine = mine.join(F.broadcast(ids), ["id", "th"], "left_semi")
    mine = mine.dropDuplicates(["id", "th"]).join(units, ["id", "th"])
    dealt = mine.select("id", "text", "units").mapInArrow(_deal(n), "unit long, half int, node long, grams array<long>")
    links = dealt.repartition("unit").sortWithinPartitions("unit").mapInArrow(_join_units(percent), "a long, b long")
    parts = components(links)
    answer = (sketch.select("id", "th", "size", "same").join(reps.select("same", "node"), "same", "left").join(parts, "node", "left")
              .select("id", "th", "size", F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component_id"))
              .groupBy("id", "th").agg(F.first("size").alias("n_shingles"), F.min("component_id").alias("component_id")))
    answer = answer.withColumnsRenamed({"id": "_id", "th": "_th"})
    return (rows.select("doc_id", "id", "th").join(answer, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
            .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")))
