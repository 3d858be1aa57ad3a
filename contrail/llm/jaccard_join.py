"""Operator 8: n-gram Jaccard join by prefix trees.

Method
------
A document's set holds the hashes of its distinct word n-grams. Two sets whose
Jaccard similarity reaches the threshold share many n-grams among the first of
each by hash, and one among the first ``p`` of each in any common order (prefix
filter). Sets that share enough meet in a *unit*; a unit stores its sets in a
prefix tree, the n-grams that most of its sets share first, and each set walks
the tree, sharing partial overlaps and leaving subtrees whose remaining lengths
cannot reach the needed overlap (``PrefixTree``). Overlaps found this way are
exact.

Steps
-----
1. Sketch: each document's set size, the hash of its set, and its first n-grams
   by hash (its zone: ``p`` and a ``SLACK``-th of the set more). Equal sets are
   one node.
2. Of a set's zone at most ``p - 1`` n-grams are missing from a set that it links
   with, so the zones share as many as the rest. Nodes that share fewer with all
   others together link with nothing and are left out. Each other node names a hub,
   the smallest holder of most of the n-grams that it shares.
3. First pass: nodes of a hub meet it, and each other, in units of bounded size.
   This joins copies.
4. Second pass: the whole sets of the nodes left are ordered, n-grams that few of
   them hold first. A node is a member of its own hub, and of each smaller hub with
   a node that holds one of its first ``p``, if sizes and what nobody shares allow a
   link and their components differ. The members of a hub that are not of its largest component are
   stored in trees of bounded size, and all its members walk each of these. Two nodes
   that share one of their first ``p`` and are not connected yet meet under the smaller
   one of their hubs, so no link between different parts is lost.

So no pairs are listed: a node is sent once to each unit of a hub, and a group of
copies costs rows in proportion to its size; units are bounded, and the members of a
large hub are dealt over many.

Cases: null and empty texts, and texts without words, have an empty set and are
their own component; texts with fewer words than ``n`` are one n-gram as a
whole; rows with a null ``doc_id`` take no part in links and have a null
component; rows that share a ``doc_id`` are one document with several sets; extra
columns are ignored; an empty table gives an empty result. N-grams are compared
by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import BROADCAST_BYTES, few, free_name, texts, written
from contrail.llm.components import components

SLACK = 12  # a zone is longer than p by this part of the set
UNIT = 64  # nodes in a unit of the first pass, on average
COMMON = 512  # members of a common hub that a unit of the second pass stores, on average
PIECE = 4  # times as many walk its trees
MEMBERS = 1 << 18  # n-grams of sets that are dealt in one batch
STORED = 1 << 20  # n-grams of sets that a unit of the second pass stores, on average
FACTORS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))  # fixed odd numbers


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of the words, A-Z in lower case; all words as one if they are fewer."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    out = h[:len(h) - n + 1].copy()
    for k in range(1, n):  # an order-sensitive mix of the words' hashes
        out = (out ^ (out >> np.uint64(29))) * FACTORS[k % 3] + h[k:len(h) - n + 1 + k]
    return np.unique((out ^ (out >> np.uint64(32))) * FACTORS[0])


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def prefix_length(size: int, percent: int) -> int:
    """So many first n-grams of a set must hold one of any set that it links with."""
    return size - -(-percent * size // 100) + 1


def _sketch(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, sets, zones = [], [], []
            for t in b.column("text"):
                s = shingles(t.as_py(), n)
                sizes.append(len(s))
                sets.append(xxhash.xxh3_128_digest(s.tobytes()))
                zones.append(s[:prefix_length(len(s), percent) + len(s) // SLACK])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("th"), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), _lists(zones)],
                ["id", "th", "size", "same", "zone"])

    return run


class PrefixTree:
    """A compressed tree of ordered sets. A tree node: its piece of the order, children by first
    element, the smallest size of a set below, the most elements that follow below, sets that end here."""

    __slots__ = ("piece", "kids", "least", "rest", "ends")

    def __init__(self, piece: np.ndarray) -> None:
        self.piece = piece
        self.kids: dict[int, PrefixTree] = {}
        self.least, self.rest = 1 << 62, 0
        self.ends: list[int] = []

    def insert(self, ordered: np.ndarray, size: int, name: int) -> None:
        node = self
        while True:
            node.least, node.rest = min(node.least, size), max(node.rest, len(ordered))
            if not len(ordered):
                node.ends.append(name)
                return
            kid = node.kids.get(int(ordered[0]))
            if kid is None:
                kid = node.kids[int(ordered[0])] = PrefixTree(ordered)
                ordered = ordered[len(ordered):]
            else:
                k = min(len(ordered), len(kid.piece))
                differ = np.flatnonzero(ordered[:k] != kid.piece[:k])
                same = int(differ[0]) if len(differ) else k
                if same < len(kid.piece):  # split the piece
                    upper = PrefixTree(kid.piece[:same])
                    upper.least, upper.rest = kid.least, kid.rest + len(kid.piece) - same
                    kid.piece = kid.piece[same:]
                    upper.kids[int(kid.piece[0])] = kid
                    node.kids[int(ordered[0])] = kid = upper
                ordered = ordered[same:]
            node = kid

    def probe(self, ordered: np.ndarray, size: int, universe: int, percent: int) -> Iterator[int]:
        """Names of the stored sets whose similarity with this one reaches the threshold."""
        holds = np.zeros(universe, bool)
        holds[ordered] = True
        walk = [(self, 0, len(ordered))]  # node, overlap above it, own elements not yet passed
        while walk:
            node, overlap, left = walk.pop()
            if len(node.piece):
                overlap += int(holds[node.piece].sum())
                left = len(ordered) - int(np.searchsorted(ordered, node.piece[-1], "right"))
            if (100 + percent) * (overlap + min(left, node.rest)) < percent * (size + node.least):
                continue
            for name, other in node.ends:
                if (100 + percent) * overlap >= percent * (size + other):
                    yield name
            walk.extend((kid, overlap, left) for kid in node.kids.values())


class Unit:
    """Stored sets, compared with each other and with sets that walk their tree; labels of sets that link are joined.
    Without ``walked``, n-grams of one stored set alone are left out."""

    def __init__(self, labels: list[int], sets: list[np.ndarray], percent: int, walked: bool) -> None:
        self.labels, self.percent = labels, percent
        self.flat, counts = np.unique(np.concatenate(sets), return_counts=True)
        by = np.flatnonzero(counts > (0 if walked else 1))
        by = by[np.argsort(-counts[by], kind="stable")]  # what most sets hold comes first, so that copies share paths
        self.universe = len(by)
        self.rank = np.full(len(self.flat), -1, np.int64)
        self.rank[by] = np.arange(len(by))
        self.root: dict[int, int] = {}
        self.tree = PrefixTree(np.zeros(0, np.int64))
        for i, (label, s) in enumerate(zip(labels, sets)):
            self.tree.insert(self.walk(label, s), len(s), (i, len(s)))

    def top(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    def walk(self, label: int, s: np.ndarray) -> np.ndarray:
        """Joins the label with those of the stored sets that link with the set; the set in the tree's order."""
        at = np.minimum(np.searchsorted(self.flat, s), len(self.flat) - 1)
        r = np.where(self.flat[at] == s, self.rank[at], -1)
        ordered = np.sort(r[r >= 0])
        self.root.setdefault(label, label)
        for j in self.tree.probe(ordered, len(s), self.universe, self.percent):
            a, b = self.top(self.labels[j]), self.top(label)
            if a != b:
                self.root[max(a, b)] = min(a, b)
        return ordered

    def links(self) -> list[tuple[int, int]]:
        """A star for each connected part: (smallest label, other label)."""
        return [(self.top(x), x) for x in self.root if self.top(x) != x]


def _join_units(percent: int):
    """Rows come sorted by unit and half: first (0) the sets that a unit stores, then (1) those that walk its tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, unit, labels, sets = None, None, [], []

        def finish() -> pa.RecordBatch:
            whole = unit if unit or len(sets) < 2 else Unit(labels, sets, percent, walked=False)
            found = whole.links() if whole else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        for b in batches:
            for u, half, label, grams in zip(*(b.column(c).to_pylist() for c in ("unit", "half", "label")), b.column("grams")):
                if u != current:
                    yield finish()
                    current, unit, labels, sets = u, None, [], []
                s = np.asarray(grams.values).view(np.uint64)
                if half == 0:
                    labels.append(label)
                    sets.append(s)
                elif sets:
                    unit = unit or Unit(labels, sets, percent, walked=True)
                    unit.walk(label, s)
        yield finish()

    return run


def _deal(n: int):
    """Each text's set, once for each unit that it goes to, in batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for label, text, units in zip(b.column("label"), b.column("text"), b.column("units")):
                s = shingles(text.as_py(), n)
                step = max(1, MEMBERS // len(s))
                for at in range(0, len(units), step):
                    part = units.values.slice(at, step)
                    yield pa.RecordBatch.from_arrays(
                        [part.field("unit"), part.field("half"), pa.array([label.as_py()] * len(part), pa.int64()), _lists([s] * len(part))],
                        ["unit", "half", "label", "grams"])

    return run


def _spread(n: int):
    """A row for each member of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, text in zip(b.column("node"), b.column("text")):
                s = shingles(text.as_py(), n)
                yield pa.RecordBatch.from_arrays([pa.array([node.as_py()] * len(s), pa.int64()), pa.array(s.view(np.int64))], ["node", "gram"])

    return run


def _links(units: DataFrame, chosen: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (of labels) found in units (unit, half, node, label). The texts that go to units are found by a broadcast
    of their nodes while these are few, else by a shuffle; their sets travel once a unit."""
    wanted = written(units.distinct().groupBy("node", "label").agg(F.collect_list(F.struct("unit", "half")).alias("units")), "wanted")
    size = wanted.agg(F.sum(F.size("units") * 24 + 32)).first()[0] or 0
    texts_ = chosen.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, "node").select("label", "text", "units")
    dealt = texts_.mapInArrow(_deal(n), "unit long, half int, label long, grams array<long>")
    return dealt.repartition("unit").sortWithinPartitions("unit", "half").mapInArrow(_join_units(percent), "a long, b long").distinct()


def _nodes(named: DataFrame) -> DataFrame:
    """(node, id, th, size, same) for each different set: its smallest id names it, and a hash names further sets of that id."""
    reps = (named.groupBy("same").agg(F.min(F.struct("id", "th")).alias("first"), F.first("size").alias("size"))
            .select("first.id", "first.th", "size", "same"))
    least = reps.groupBy("id").agg(F.min("th").alias("least"))
    return written(reps.join(least, "id").withColumn("node", F.when(F.col("th") == F.col("least"), F.col("id")).otherwise(F.xxhash64("id", "th")))
                   .drop("least"), "nodes")


def _near(named: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(node, id, th, size, hub) of the nodes whose zones share enough n-grams with others for a link."""
    ids = nodes.select("id", "th", "node")
    grams = named.join(F.broadcast(ids) if few(ids) else ids, ["id", "th"]).select("node", F.explode("zone").alias("gram"))
    held = written(grams.groupBy("gram").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b").select("gram"),
                   "held")  # a scan, so that Spark can split the join below
    # the smallest set that a node may link with has low members; such zones share all but p - 1 of the n-grams of one
    low = f"(({percent} * size + 99) div 100)"
    need = f"least(({percent} * {low} + 99) div 100, {low} div {SLACK} + 1)"
    near = written(grams.join(held, "gram").groupBy("node").agg(F.collect_set("gram").alias("grams"))
                   .join(nodes.select("node", "id", "th", "size"), "node").filter(F.size("grams") >= F.expr(need)), "near")
    keys = near.select("node", F.explode("grams").alias("gram"))
    hub = written(keys.groupBy("gram").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last").select("gram", "hub"), "hubs")
    named_ = (keys.join(hub, "gram").groupBy("node", "hub").agg(F.count("*").alias("c"))
              .groupBy("node").agg(F.min_by("hub", F.struct((-F.col("c")).alias("c"), "hub")).alias("hub")))
    return written(near.drop("grams").join(named_, "node"), "near-nodes")


def _first_units(near: DataFrame) -> DataFrame:
    """The nodes of a hub in units of bounded size, and the hub in each of these."""
    crowd = near.groupBy("hub").agg(F.count("*").alias("n"))
    stars = (near.join(crowd, "hub").filter("n > 1 OR node <> hub")
             .withColumn("unit", F.expr(f"xxhash64(hub, pmod(xxhash64(node), cast(ceil(n / {UNIT}) as int)))")))
    hubs = stars.select("unit", "hub").distinct().join(near.select(F.col("node").alias("hub"), "id"), "hub")
    return (stars.select("unit", F.lit(0).alias("half"), "node", F.col("id").alias("label"))
            .union(hubs.select("unit", F.lit(0), "hub", "id")))


def _placed(chosen: DataFrame, parts: DataFrame, n: int, percent: int) -> DataFrame:
    """(gram, node, size, hub, component, alone, early): the first p of each node's set, n-grams that few nodes hold
    first; nobody else holds ``alone`` of its members."""
    whole = chosen.mapInArrow(_spread(n), "node long, gram long")
    rarity = written(whole.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1"), "rarity")
    first_p = F.expr(f"size - ({percent} * size + 99) div 100 + 1")
    # of two sets, the smaller one can miss fewer: it shares one of fewer first members
    first_few = F.expr(f"size - ({2 * percent} * size + {99 + percent}) div {100 + percent} + 1")
    of_node = Window.partitionBy("node")
    return written(whole.join(rarity, "gram").withColumn("n", F.count("*").over(of_node))
                   .withColumn("rank", F.row_number().over(of_node.orderBy("df", "gram"))).join(F.broadcast(parts) if few(parts) else parts, "node")
                   .withColumn("alone", F.col("size") - F.col("n")).withColumn("place", F.col("alone") + F.col("rank"))
                   .filter(F.col("place") <= first_p).withColumn("early", F.col("place") <= first_few)
                   .select("gram", "node", "size", "hub", "component", "alone", "early"), "placed")


def _members(placed: DataFrame, percent: int) -> DataFrame:
    """(hub, node, size, component): a node is a member of its hub and of smaller ones with a node of another component
    that it may link with. What is known of a hub's holders of an n-gram are bounds of their sizes and shares."""
    spare = f"({100 - percent} * size - 100 * alone)"
    held = placed.groupBy("gram", F.col("hub").alias("under")).agg(
        F.min("size").alias("smallest"), F.max("size").alias("largest"), F.min(F.when(F.col("early"), F.col("size"))).alias("smallest_early"),
        F.min("alone").alias("least_alone"), F.max(F.expr(spare)).alias("most_spare"),
        F.min("component").alias("c"), F.max("component").alias("d"))
    reached = written(
        placed.join(held, "gram").filter("under <= hub AND (c <> component OR d <> component)")
        .filter(f"{percent} * size <= 100 * largest AND {percent} * smallest <= 100 * size")
        .filter("(early AND largest >= size) OR coalesce(smallest_early <= size, false)")
        # what nobody shares is lost to the overlap
        .filter(f"{spare} >= {percent} * least_alone AND most_spare >= {percent} * alone")
        .select("under", "node", "size", "component", "hub").distinct(), "reached")
    visited = reached.filter("under <> hub").select(F.col("under").alias("hub")).distinct()
    at_home = placed.select("hub", "node", "size", "component").join(visited, "hub", "left_semi")
    return written(reached.select(F.col("under").alias("hub"), "node", "size", "component").union(at_home).distinct(), "members")


def _second_units(members: DataFrame) -> DataFrame:
    """Members of a hub that are not of its largest component are stored in blocks; in pieces, all members walk each block."""
    mixture = members.groupBy("hub", "component").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    sized = (mixture.groupBy("hub").agg(F.max(F.struct("n", "component", "s")).alias("m"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("parts"))
             .filter("parts > 1").select(
                 "hub", F.col("m.component").alias("major"),
                 F.expr(f"cast(ceil(greatest((n - m.n) / {COMMON}, (s - m.s) / {STORED})) as int)").alias("blocks"),
                 F.expr(f"cast(ceil(n / {PIECE * COMMON}) as int)").alias("pieces")))
    dealt = (members.join(sized, "hub").withColumn("minor", F.col("component") != F.col("major"))
             .withColumn("own", F.expr("cast(pmod(xxhash64(node), blocks) as int)")).withColumn("piece", F.expr("cast(pmod(xxhash64(node, 1), pieces) as int)")))
    unit = F.xxhash64("hub", "block", "piece").alias("unit")
    stored = dealt.filter("minor").select("hub", "node", "component", F.col("own").alias("block"), F.explode(F.expr("sequence(0, pieces - 1)")).alias("piece"))
    walking = (dealt.select("hub", "node", "component", "minor", "own", "piece", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
               .filter("NOT minor OR block <> own"))
    return (stored.select(unit, F.lit(0).alias("half"), "node", F.col("component").alias("label"))
            .union(walking.select(unit, F.lit(1), "node", "component")))


def join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents link when 100 * intersection >= percent * union."""
    rows = texts(docs).select("doc_id", F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"), "text")
    sketch = written(rows.select("id", "th", "text").mapInArrow(
        _sketch(n, percent), "id long, th long, size long, same binary, zone array<long>"), "sketch")
    named = sketch.filter("size > 0 AND id IS NOT NULL")
    nodes = _nodes(named)
    near = _near(named, nodes, percent)
    ids = near.select("id", "th", "node")
    chosen = written(rows.select("id", "th", "text").join(F.broadcast(ids) if few(ids) else ids, ["id", "th"])
                     .groupBy("node").agg(F.first("text").alias("text")), "chosen")

    # first pass: near nodes meet their hubs
    known = components(_links(_first_units(near), chosen, n, percent))

    # second pass: links between components, of all pairs that are not connected yet and share one of their first p
    parts = written(near.select("node", "id", "size", "hub").join(known.withColumnRenamed("node", "id"), "id", "left")
                    .select("node", "size", "hub", F.coalesce("component", "id").alias("component")), "parts")
    more = _links(_second_units(_members(_placed(chosen, parts, n, percent), percent)), chosen, n, percent)
    of_part = components(more).withColumnsRenamed({"node": "part", "component": "whole"})
    parts = (known.withColumnRenamed("component", "part").join(of_part, "part", "left").select("node", F.coalesce("whole", "part").alias("component"))
             .union(of_part.select("part", "whole").join(known.select(F.col("node").alias("part")), "part", "left_anti")))

    # back to rows: set -> node -> component
    answer = (sketch.select("id", "th", "size", "same").join(nodes.select("same", F.col("id").alias("node")), "same", "left").join(parts, "node", "left")
              .select("id", "th", "size", F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component_id"))
              .groupBy("id", "th").agg(F.first("size").alias("n_shingles"), F.min("component_id").alias("component_id")))
    return (rows.select("doc_id", "id", "th").join(answer.withColumnsRenamed({"id": "_id", "th": "_th"}),
                                                   F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
            .select("doc_id", "n_shingles", "component_id"))


def keep_one(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """``docs`` with one row of each component, judged by id and text: the smallest ``doc_id``, of its texts the one
    with the smallest hash, and of rows that repeat both the one with the smallest hash over all columns. Rows of
    different components all stay, also if they share an id, and so do rows without id."""
    key = free_name(docs, "row")
    rows = docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.coalesce("text", F.lit("")))))
    named = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), "text")
    classes = written(join(named, n, percent).select(F.col("doc_id").alias("key"), "component_id").distinct(), "classes")
    many = classes.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id")
    linked = written(classes.join(many, "component_id"), "linked")  # rows that another one is linked with
    ids = docs.select("doc_id", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key")).filter("doc_id IS NOT NULL")
    ids = ids.join(F.broadcast(linked) if few(linked, 16) else linked, "key")
    first = ids.groupBy("component_id").agg(F.min(F.struct("doc_id", "key"))["key"].alias("first"))
    gone = written(linked.join(first, "component_id").filter("key <> first").select(F.col("key").alias(key)), "gone")
    kept = rows.join(F.broadcast(gone) if few(gone, 16) else gone, key, "left_anti")
    again = written(kept.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key), "repeated-rows")
    again_ = F.broadcast(again) if few(again, 16) else again
    single = kept.join(again_, key, "left_anti").select(docs.columns)
    comparable = [f.name for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    one = kept.join(again_, key, "left_semi").groupBy(key).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*comparable)).alias("one"))
    return single.unionByName(one.select("one.*"))
