"""Operator 2: secret scans through a trigram inverted index (DataFrame functions only).

Method
------
1. ``trigram_query`` derives from each rule's regular expression the trigrams
   that any match must hold, as a Boolean query: an OR of ANDs of trigrams
   (lower case). A rule without mandatory trigrams has no query.
2. ``trigram_index`` writes the inverted index: one posting (trigram, doc_id)
   for each trigram of the query vocabulary and document that holds it.
3. ``candidates`` intersects postings: a document is a candidate of a rule when
   it holds every trigram of one of the rule's ANDs. Postings are intersected
   per document, so a trigram that every document holds is not one task's work.
4. ``scan`` verifies candidates with the regular expression itself; rules
   without a query scan every text. Spans are positions in code points.

Cases: a null text is scanned as empty; empty texts have no spans; rows with a
null or repeated ``doc_id`` are each scanned by themselves (their candidates
are the union over the id, and verification is exact); extra columns are
ignored; an empty table gives an empty result. Span positions of one text are
summed match by match, so that one text's cost grows with the square of its
number of matches (10,000 matches: well under a second).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as rc
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import texts, written


@dataclass(frozen=True)
class Rule:
    """``pattern``: regex in the syntax that Java and Python share; a match counts
    when group ``group`` of it has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int
    group: int = 0


#: The base kinds, in the order in which spans of the same start are listed.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: Kinds that this operator adds.
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0),
)
RULES = BASE + EXTRA

Query = frozenset  # of frozensets of trigrams: an OR of ANDs
EVERYTHING: Query = frozenset([frozenset()])
MAX_STRINGS = 64  # a part of a regex with more spellings counts as unknown (the query gets weaker, never wrong)


def _spellings(nodes) -> set[str] | None:
    """All strings that the nodes match, or None if too many or not enumerable."""
    out = {""}
    for op, arg in nodes:
        if op is rc.LITERAL:
            here = {chr(arg).lower()}
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
            here = {chr(c).lower() for _, c in arg}
        elif op is rc.SUBPATTERN:
            here = _spellings(arg[3])
        elif op is rc.BRANCH:
            parts = [_spellings(b) for b in arg[1]]
            here = None if None in parts else set().union(*parts)
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[1] != rc.MAXREPEAT and arg[1] <= 8:
            one = _spellings(arg[2])
            here = None if one is None else {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(one, repeat=n)} if len(one) ** arg[1] <= MAX_STRINGS else None
        else:
            here = None
        if here is None or len(out) * len(here) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in here}
    return out


def _either(queries: list[Query]) -> Query:
    """OR: ANDs that hold another AND are dropped."""
    ands = set().union(*queries)
    return frozenset(a for a in ands if not any(b < a for b in ands))


def _both(a: Query, b: Query) -> Query:
    return _either([frozenset(x | y for x in a for y in b)]) if len(a) * len(b) <= MAX_STRINGS else min(a, b, key=len)


def _holds(strings: set[str]) -> Query:
    return _either([frozenset([frozenset(s[i:i + 3] for i in range(len(s) - 2))]) for s in strings])


def _query(nodes) -> Query:
    out, run = EVERYTHING, []
    for node in [*nodes, None]:
        if node is not None and _spellings([*run, node]) is not None:
            run.append(node)
            continue
        if run:
            out = _both(out, _holds(_spellings(run)))
            run = []
        if node is None:
            break
        op, arg = node
        if _spellings([node]) is not None:
            run = [node]
        elif op is rc.SUBPATTERN:
            out = _both(out, _query(arg[3]))
        elif op is rc.BRANCH:
            out = _both(out, _either([_query(b) for b in arg[1]]))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] > 0:
            out = _both(out, _query(arg[2]))
    return out


def trigram_query(pattern: str) -> Query | None:
    """The OR of ANDs of lower-case trigrams that every match of the pattern holds; None if it names no trigram."""
    q = _query(list(_parser.parse(pattern)))
    return None if frozenset() in q else q


def trigram_index(docs: DataFrame, vocabulary: set[str]) -> DataFrame:
    """Postings (trigram, doc_id), written to the shared folder: which of the vocabulary's trigrams each text holds."""
    by_first: dict[str, list[str]] = {}
    for t in sorted(vocabulary):
        by_first.setdefault(t[0], []).append(t[1:])
    alternatives = "|".join(f"{re.escape(c)}(?:{'|'.join(map(re.escape, rest))})" for c, rest in by_first.items())
    held = F.regexp_extract_all(F.lower("text"), F.lit(f"(?=({alternatives}))"), 1)
    return written(texts(docs).select("doc_id", F.explode(F.array_distinct(held)).alias("trigram")), "postings")


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(doc_id, kinds): the rules one of whose ANDs a document satisfies."""
    rows = [(t, kind, n, 1 << i, (1 << len(a)) - 1)
            for kind, q in queries.items() for n, a in enumerate(sorted(map(sorted, q))) for i, t in enumerate(a)]
    wanted = index.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(c) for c, v in zip(("trigram", "kind", "clause", "bit", "mask"), r)]) for r in rows])))
    return (index.join(F.broadcast(wanted), "trigram")  # one row for each trigram of the rules
            .groupBy("doc_id", "kind", "clause", "mask").agg(F.bit_or("bit").alias("got"))
            .filter("got = mask").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds")))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Sorted array of (start, order, kind, end) of the rule's matches."""
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, 0).alias("all"),
                         F.regexp_extract_all(text, pattern, rule.group).alias("part"))
    span = "array<struct<start:int,ord:int,kind:string,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(F.coalesce(x["all"], F.lit("")))
        one = F.array(F.struct(begin.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), end.alias("end"))).cast(span)
        keep = x["all"].isNotNull() & (F.length(x["part"]) >= rule.least)
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.when(keep, one).otherwise(F.array().cast(span))).alias("spans"))

    return F.aggregate(found, start, step, lambda acc: acc["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans): for each row the sorted spans (start, ord, kind, end) of all rules."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    rows = texts(docs)
    if indexed:
        found = candidates(trigram_index(docs, {t for q in indexed.values() for a in q for t in a}), indexed)
        rows = (rows.join(found.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
                .withColumn("kinds", F.coalesce("kinds", F.array().cast("array<string>"))))
    none = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")
    parts = []
    for i, r in enumerate(rules):
        look = F.col("text").rlike(r.pattern)
        if r.kind in indexed:
            look = F.array_contains("kinds", r.kind) & look
        parts.append(F.when(look, _spans(F.col("text"), r, i)).otherwise(none))
    return rows.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as text."""
    def written_out(c: Column) -> Column:
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["ord"] < len(BASE))
    return scanned.select("doc_id", *[number(r.kind) for r in BASE], F.sha2(written_out(base), 256).alias("base_sha256"),
                          written_out(F.col("spans")).alias("spans"))
