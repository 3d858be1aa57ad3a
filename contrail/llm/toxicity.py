"""Operator 4: toxicity by weak supervision.

Method
------
1. ``learn_lexicon``: of the labelled rows that may be learned from, the words and
   word beginnings, present or dense in a text, whose log-odds between toxic and
   other texts stand out.
2. ``hits``: one pass over all texts notes which of these each text holds, and the
   patterns of ``PATTERNS`` that it shows. All later steps read this narrow table.
3. Voters: groups of lexicon entries and the patterns, each of which votes or
   abstains. ``label_model`` fits, over the votes on all texts and without any
   labels, a two-class model with a rate for each voter and class (its accuracy),
   by expectation maximisation; then the correlations of voters within the classes,
   by which voters that repeat each other count less.
4. ``fit``: a linear classifier on lexicon entries and patterns is trained on the
   model's posterior labels of the learned-from rows (at most ``FIT_ROWS``).
5. ``score``: its probability for every text.

Rows are learned from only when crc32(doc_id as text) mod 5 is not 0. Labels,
language, source and doc_id are no inputs of a score: equal texts have equal scores.

Bounds: ``FIT_ROWS`` labelled ids (chosen by a hash of the doc_id) for the lexicon and
the classifier, which learns from one row of each (rows that share an id: the one with
the smallest hash); the lexicon holds every entry whose log-odds stand out: by ``LEAST_Z``
standard errors, and, as very many entries are looked at in many rows, by so many that
chance alone would let ``CHANCE`` of them through. Votes and rates are counted over all texts, as sums that only (voters
squared) numbers of reach the driver.

Cases: a null text is empty and scores by the intercept; null or repeated doc_ids
are scored row by row (null ids are never learned from); labels with null
``toxic`` are ignored; without labels of both kinds every score is 0; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import few, free_name, texts, written

FIT_ROWS = 20_000
LEAST_TEXTS, LEAST_Z, LEAST_SHARE = 4, 3.0, 0.75
CHANCE = 30
#: An entry is dense in a text that it makes up this share of, and that holds it twice.
DENSE = 0.01
#: Lexicon voters of each kind: words, beginnings of 4, 5 and 6 letters; and the same, if dense.
GROUPS = {"w": 6, "4": 2, "5": 2, "6": 2, "W": 4, "D": 4, "E": 4, "F": 4}
BEGINNINGS = ((4, "4", "D"), (5, "5", "E"), (6, "6", "F"))
DENSER = {"w": "W", **{kind: dense for _, kind, dense in BEGINNINGS}}
PATTERNS = {
    "shouting": re.compile(r"\b[A-Z]{3,}\b(?:\W+[A-Z]{3,}\b){2}"),
    "exclaiming": re.compile(r"[!?]{2,}"),
    "addressing": re.compile(r"\b(?:you|your|you're|du|tu|vous)\b", re.I),
    "masking": re.compile(r"\w[*#@$%]{2,}\w"),
    "stretching": re.compile(r"([a-z])\1{3,}", re.I),
    "pointing": re.compile(r"https?://|www\.", re.I),
}
WORDS = re.compile(r"[^\W\d_]+")


def learnable(doc_id: Column) -> Column:
    """May labels be learned from this row?"""
    return (F.crc32(doc_id.cast("string")) % 5) != 0


def entries(text: str) -> list[str]:
    """Words and word beginnings that a text holds, each with its kind, and those that are dense in it."""
    words = Counter(WORDS.findall(text.lower()))
    many = max(2, math.ceil(DENSE * words.total()))
    out = ["w" + w for w in words] + ["W" + w for w, n in words.items() if n >= many]
    for k, kind, dense in BEGINNINGS:
        begun = Counter()
        for w, n in words.items():
            if len(w) > k:
                begun[w[:k]] += n
        out += [kind + w for w in begun] + [dense + w for w, n in begun.items() if n >= many]
    return out


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts: dict[str, list[int]] = {}
        for t, toxic in zip(b.column("text"), b.column("toxic").to_pylist()):
            for e in entries(t.as_py()):
                c = counts.setdefault(e, [0, 0])
                c[toxic] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string())] + [
            pa.array([c[k] for c in counts.values()], pa.int64()) for k in (0, 1)], ["entry", "other", "toxic"])


def fit_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the rows that are learned from, ``FIT_ROWS`` at most (by a hash of the id)."""
    usable = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learnable(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    n = usable.count()
    if n > FIT_ROWS:
        usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * FIT_ROWS / n))
    return written(usable, "fit-rows")


def learn_lexicon(docs: DataFrame, rows: DataFrame) -> list[tuple[str, bool]]:
    """(entry, is a voter's) of the entries that tell toxic texts from others; voters take those that are mostly in toxic ones."""
    labelled = docs.join(F.broadcast(rows), "doc_id")  # FIT_ROWS rows at most
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return []
    counted = written(labelled.select("text", "toxic").mapInArrow(_entries, "entry string, other long, toxic long").groupBy("entry").agg(
        F.sum("toxic").alias("a"), F.sum("other").alias("c")).filter(F.col("a") + F.col("c") >= LEAST_TEXTS), "entries")
    least = max(LEAST_Z, NormalDist().inv_cdf(1 - min(1.0, CHANCE / max(1, counted.count())) / 2))
    odds = F.log((F.col("a") + 0.5) / (n[1] - F.col("a") + 0.5)) - F.log((F.col("c") + 0.5) / (n[0] - F.col("c") + 0.5))
    z = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("c") + 0.5))
    found = (counted.withColumn("z", z).filter(F.abs("z") >= least)
             .select("entry", ((F.col("z") > 0) & (F.col("a") >= LEAST_SHARE * (F.col("a") + F.col("c")))).alias("votes")).collect())
    return sorted((r["entry"], r["votes"]) for r in found)


def hits(docs: DataFrame, lexicon: list[str]) -> DataFrame:
    """``docs`` (doc, doc_id, text) as (doc, doc_id, held): numbers of the lexicon entries held, then of the patterns shown."""
    number = {e: i for i, e in enumerate(lexicon)}
    whole = {e[1:] for e in lexicon if e[0] in "wW"}
    shortest = {e[1:5] for e in lexicon if e[0] not in "wW"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = []
            for t in b.column("text"):
                text = t.as_py()
                words = Counter(WORDS.findall(text.lower()))
                many = max(2, math.ceil(DENSE * words.total()))
                seen = Counter()
                for w in words.keys() & whole:
                    seen["w" + w] += words[w]
                for w, n in words.items():
                    if w[:4] in shortest:
                        for k, kind, _ in BEGINNINGS:
                            if len(w) > k:
                                seen[kind + w[:k]] += n
                found = {number[e] for e in seen if e in number}
                found.update(number[e] for e in (DENSER[e[0]] + e[1:] for e, n in seen.items() if n >= many) if e in number)
                found.update(len(number) + i for i, p in enumerate(PATTERNS.values()) if p.search(text))
                held.append(sorted(found))
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("doc_id"), pa.array(held, pa.list_(pa.int32()))], ["doc", "doc_id", "held"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc", "doc_id", "text").mapInArrow(run, f"doc long, doc_id {kind}, held array<int>")


@dataclass
class LabelModel:
    prior: float
    rates: np.ndarray  # voters x (other, toxic): how often a voter votes
    weights: np.ndarray  # what a voter counts, less if it repeats others

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.log(self.rates[:, 1] / self.rates[:, 0]), np.log((1 - self.rates[:, 1]) / (1 - self.rates[:, 0]))
        logit = math.log(self.prior / (1 - self.prior)) + votes @ (self.weights * odds[0]) + (1 - votes) @ (self.weights * odds[1])
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def voters(lexicon: list[tuple[str, bool]]) -> np.ndarray:
    """The voter of each entry and pattern; -1 for entries that no voter takes."""
    start, at = {}, 0
    for kind, n in GROUPS.items():
        start[kind] = at
        at += n
    seen: dict[str, int] = dict.fromkeys(GROUPS, 0)
    out = []
    for e, votes in lexicon:
        out.append(start[e[0]] + seen[e[0]] % GROUPS[e[0]] if votes else -1)
        seen[e[0]] += votes
    return np.array(out + list(range(at, at + len(PATTERNS))), np.int64)


def _votes(held: pd.Series, voter: np.ndarray) -> np.ndarray:
    out = np.zeros((len(held), int(voter.max()) + 1))
    for i, h in enumerate(held):
        v = voter[np.asarray(h, np.int64)]
        out[i, v[v >= 0]] = 1
    return out


def label_model(found: DataFrame, voter: np.ndarray, rounds: int = 12) -> LabelModel:
    """Rates and correlations of the voters over all texts, without labels."""
    m = int(voter.max()) + 1

    def patterns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = _votes(b["held"], voter).astype(np.int64) @ (1 << np.arange(m))
            mask, n = np.unique(v, return_counts=True)
            yield pd.DataFrame({"mask": mask, "n": n})

    seen = written(found.select("held").mapInPandas(patterns, "mask long, n long").groupBy("mask").agg(F.sum("n").alias("n")).coalesce(8), "votes")
    lexical = sum(GROUPS.values())
    model = LabelModel(0.1, np.where(np.arange(m)[:, None] < lexical, [[0.01, 0.3]], [[0.1, 0.15]]), np.ones(m))

    def moments(model: LabelModel, pairs: bool) -> tuple[np.ndarray, np.ndarray]:
        """Of both classes: expected texts, votes by voter and, with ``pairs``, joint votes."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                v = (b["mask"].to_numpy()[:, None] >> np.arange(m) & 1).astype(float)
                p = model.posterior(v)
                for k, w in enumerate((b["n"] * (1 - p), b["n"] * p)):
                    w = w.to_numpy()
                    sums = np.concatenate([[w.sum()], w @ v, ((v * w[:, None]).T @ v).ravel() if pairs else []])
                    yield pd.DataFrame({"i": np.arange(len(sums)) * 2 + k, "x": sums})

        got = seen.mapInPandas(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
        out = np.zeros(2 * (1 + m + (m * m if pairs else 0)))
        for r in got:
            out[r["i"]] = r["x"]
        return out[0::2], out[1::2]

    for _ in range(rounds):
        by = moments(model, False)
        n = [max(x[0], 1e-9) for x in by]
        model.rates = np.clip(np.stack([(x[1:1 + m] + 0.5 * k) / (t + k) for x, t, k in zip(by, n, (0.02, 0.02))], axis=1), 1e-4, 1 - 1e-4)
        model.prior = min(max(n[1] / (n[0] + n[1]), 1e-4), 0.5)
    by = moments(model, True)
    share = np.zeros((m, m))
    total = sum(x[0] for x in by) or 1.0
    within = np.zeros((m, m))
    for x in by:  # covariance within the classes, weighted by their size
        t = max(x[0], 1e-9)
        mean = x[1:1 + m] / t
        within += t / total * (x[1 + m:].reshape(m, m) / t - np.outer(mean, mean))
    scale = np.sqrt(np.clip(np.diag(within), 1e-12, None))
    share = np.clip(within / np.outer(scale, scale), 0, 1)
    np.fill_diagonal(share, 1)
    model.weights = 1 / share.sum(axis=1)
    return model


def fit(held: list[list[int]], p: np.ndarray, size: int, rounds: int = 400, decay: float = 1e-4) -> np.ndarray:
    """Weights of the entries and an intercept: logistic regression on soft labels by accelerated gradient steps."""
    w, momentum = np.zeros(size + 1), np.zeros(size + 1)
    row = np.repeat(np.arange(len(held)), [len(h) for h in held])
    column = np.concatenate([np.asarray(h, np.int64) for h in held]) if len(row) else np.zeros(0, np.int64)
    scale = 1 / np.sqrt(np.bincount(column, minlength=size) / len(held) + 0.01)  # rare entries move as fast as common ones
    w[-1] = math.log((p.mean() + 1e-6) / (1 - p.mean() + 1e-6))
    for _ in range(rounds):
        ahead = w + 0.9 * momentum
        logit = np.bincount(row, (ahead[:-1] * scale)[column], minlength=len(held)) + ahead[-1]
        miss = 1 / (1 + np.exp(-np.clip(logit, -50, 50))) - p
        step = np.append(np.bincount(column, miss[row], minlength=size) * scale / len(held) + decay * ahead[:-1], miss.mean())
        momentum = 0.9 * momentum - 0.5 * step
        w = w + momentum
    return np.append(w[:-1] * scale, w[-1])


def score_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc, doc_id, held_out, score, predicted) of every row of ``docs``; ``doc`` is a hash of the row's id and text."""
    rows = texts(docs).withColumn("doc", F.xxhash64("doc_id", "text"))
    chosen = fit_rows(rows, labels)
    lexicon = learn_lexicon(rows, chosen)
    held_out = F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out")
    if not lexicon:
        return rows.select("doc", "doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    found = written(hits(rows, [e for e, _ in lexicon]), "hits")
    voter = voters(lexicon)
    model = label_model(found, voter)
    sample = (found.join(F.broadcast(chosen.select("doc_id")), "doc_id")  # FIT_ROWS ids at most, a row each
              .groupBy("doc_id").agg(F.min(F.struct("doc", "held"))["held"].alias("held")).orderBy("doc_id").select("held").toPandas()["held"])
    weights = fit([list(h) for h in sample], model.posterior(_votes(sample, voter)), len(voter))

    @F.pandas_udf("double")
    def probability(held: pd.Series) -> pd.Series:
        logit = np.array([weights[np.asarray(h, np.int64)].sum() for h in held]) + weights[-1]
        return pd.Series(1 / (1 + np.exp(-np.clip(logit, -50, 50))))

    return (found.select("doc", "doc_id", held_out, probability("held").alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    return score_rows(docs, labels).drop("doc")


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted toxic."""
    key = free_name(docs, "doc")
    toxic = written(score_rows(docs, labels).filter("predicted = 1").select(F.col("doc").alias(key)).distinct(), "toxic")
    rows = docs.withColumn(key, F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    return rows.join(F.broadcast(toxic) if few(toxic, 16) else toxic, key, "left_anti").drop(key)
