"""Operators whose results SQL can't express, against plain Python; clashing names; the pipeline as a whole."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from contrail.llm import bpe, decontaminate, fingerprints, html_text, jaccard_join, line_dedup, token_counts, toxicity
from tests.llm.conftest import ODD, WORDS

BPE = bpe.tokenizer_path("word_bpe_49k.json")
#: Names that the operators use inside, as columns of the input.
CLASHING = ["_doc", "doc", "_gone", "gone", "_kept", "kept", "n_dropped", "row", "key", "th", "id", "one", "first", "line", "component_id", "predicted", "size"]


@pytest.fixture()
def clashing(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[f"{c}{k}" for c in CLASHING]) for k, (i, t) in enumerate(rows)],
                                     "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)).repartition(3)
    return make


# 1 -------------------------------------------------------------------------------------------

def test_rollup_equals_a_recount_after_random_batches(spark, tmp_out):
    path = bpe.tokenizer_path("byte_bpe_50k.tiktoken")
    n = lambda t: len(token_counts._encoding(path).encode_ordinary(t or ""))
    r, state, no_id = random.Random(4), {}, Counter()
    roll = token_counts.Rollup(spark, f"{tmp_out}/rollup")
    for b in range(4):
        rows, version = [], f"v{b % 2}"
        for seq in range(40):
            op, i = r.choice(["insert", "insert", "delete", "revise"]), r.choice([None, *range(25)])
            rows.append((op, seq, i, r.choice(["a", "b", None]), r.choice(["en", None]), " ".join(r.choice(WORDS) for _ in range(r.randint(0, 6)))))
        rows += [("insert", 99, None, "a", "en", "same row")] * 3
        roll.commit(f"b{b}", spark.createDataFrame(rows, "op string, seq int, doc_id long, source string, lang string, text string"), version, path)
        for op, _, i, source, lang, text in rows:
            if i is None:
                if op != "delete":
                    no_id[source, lang, version, "docs"] += 1
                    no_id[source, lang, version, "tokens"] += n(text)
            elif op == "delete":
                state.pop(i, None)
            else:
                state[i] = (source, lang, version, n(text))
        want = Counter()
        for source, lang, v, tokens in state.values():
            want[source, lang, v, "docs"] += 1
            want[source, lang, v, "tokens"] += tokens
        want.update(no_id)
        got = {(*k, x): v for *k, docs, tokens in map(tuple, roll.totals().collect()) for x, v in (("docs", docs), ("tokens", tokens))}
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    roll.compact("all")
    assert {(*k, "docs"): docs for *k, docs, _ in map(tuple, roll.totals().collect()) if docs} == {k: v for k, v in want.items() if k[3] == "docs" and v}


# 4 -------------------------------------------------------------------------------------------

def test_label_model_finds_the_rates_of_simulated_voters(spark):
    r = np.random.default_rng(2)
    m = sum(toxicity.GROUPS.values()) + len(toxicity.PATTERNS)
    lexical = sum(toxicity.GROUPS.values())
    toxic = r.random(20_000) < 0.15
    rates = np.stack([np.r_[r.uniform(0.005, 0.02, lexical), np.full(m - lexical, 0.1)], np.r_[r.uniform(0.2, 0.6, lexical), np.full(m - lexical, 0.2)]], axis=1)
    votes = r.random((len(toxic), m)) < rates[:, toxic.astype(int)].T
    found = spark.createDataFrame([(np.flatnonzero(v).tolist(),) for v in votes], "held array<int>").repartition(4)
    model = toxicity.label_model(found, np.arange(m))
    assert abs(model.prior - 0.15) < 0.02
    assert np.abs(model.rates - rates).max() < 0.05
    assert ((model.posterior(votes.astype(float)) >= 0.5) == toxic).mean() > 0.99


# 5 -------------------------------------------------------------------------------------------

def test_pages_with_extra_columns(spark):
    html = "<html><body><nav>menu</nav><article><p>First, with commas, enough text to be kept here.</p><p>Second &amp; last.</p></article></body></html>"
    pages = spark.createDataFrame([(1, "u", html, "x", "y"), (None, None, None, "x", "y")], "page_id long, url string, html string, text string, n_chars string")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    text = "First, with commas, enough text to be kept here.\nSecond & last."
    assert got == [(1, "u", text, len(text)), (None, None, "", 0)]


# 6 -------------------------------------------------------------------------------------------

def likeness(a, b):
    """Of two spelled fingerprints."""
    if a == b:
        return 1.0
    cut = lambda s: [set(re.findall(r"(.)(.{4})", level)) for level in s.split("|")[1:]]
    levels = []
    for x, y in zip(cut(a), cut(b)):
        levels.append((len({k for k, _ in x} | {k for k, _ in y}), len(x & y)))
    held, same = next((v for v in levels if v[0] <= fingerprints.CROWDED), levels[-1])
    return same / held if held else 0.0


def test_fingerprints_follow_the_terms_in_the_band(frame, prose):
    rows = [(k, prose(k % 30, 25)) for k in range(60)] + [(k, " ".join(sorted(prose(k - 100, 25).upper().split(" ")))) for k in range(100, 110)] + [(200, None), (201, "!!")]
    got = {r.doc_id: r for r in fingerprints.digest(fingerprints.compare(frame(rows))).collect()}
    term = re.compile(r"[^\W_]+")
    sets = {i: frozenset(term.findall((t or "").lower())) for i, t in rows}
    df = Counter(w for s in sets.values() for w in s)
    least, most = max(2, fingerprints.RARE * len(rows)), max(2, fingerprints.FREQUENT * len(rows))
    band = {i: frozenset(w for w in s if least <= df[w] <= most) for i, s in sets.items()}
    for i in sets:
        for j in sets:  # equal band terms, and only those, give an equal hash of the whole
            if band[i] and band[j]:
                assert (got[i].fingerprint.split("|")[0] == got[j].fingerprint.split("|")[0]) == (band[i] == band[j])
    down = sorted(sets, reverse=True)
    for a, b in zip(down, [*down[1:], down[0]]):
        assert got[a].near_next == pytest.approx(likeness(got[a].fingerprint, got[b].fingerprint))
        assert got[a].near_edited == pytest.approx(likeness(got[a].fingerprint, got[a].edited_fingerprint))


# 7 and clashing names ------------------------------------------------------------------------

def test_columns_with_inner_names_pass_through(spark, clashing, prose):
    rows = ODD + [(100 + k, prose(k, 20) + "\nthis footer stands in all pages of the site\n" + prose(500 + k, 20)) for k in range(14)]
    docs = clashing(rows)
    before = {tuple(r)[5:]: r for r in docs.collect()}
    out = line_dedup.dedup(docs)
    assert out.columns == [*docs.columns, "n_dropped_1"]
    for r in out.collect():
        was = before[tuple(r)[5:-1]]
        kept = "\n".join(x for x in (was.text or "").split("\n") if "footer" not in x)
        assert (r.text, r.n_dropped_1) == (kept, (was.text or "").count("footer"))
    labels = spark.createDataFrame([(100 + k, 0, k % 2) for k in range(14)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, " ".join(prose(0, 20).split()[:15]))], "item_id long, text string")
    for got in (toxicity.clean(docs, labels), decontaminate.clean(docs, bench), jaccard_join.keep_one(docs, 5, 80)):
        assert got.columns == docs.columns
        for r in got.collect():
            assert tuple(r) == tuple(before[tuple(r)[5:]])
    assert 100 not in {r.doc_id for r in decontaminate.clean(docs, bench).collect()}


# 8 -------------------------------------------------------------------------------------------

def test_one_row_of_each_group_and_no_other_row_goes(clashing, prose):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    near = " ".join([*a.split(" ")[:-1], "other"])
    rows = [(5, a), (5, b), (3, near), (9, c), (9, c), (9, c), (None, a), (None, a), (7, None), (7, ""), (8, None), (4, b + " x")]
    got = Counter((r.doc_id, r.text) for r in jaccard_join.keep_one(clashing(rows), 5, 80).collect())
    assert sum(v for (i, t), v in got.items() if t == c) == 1  # rows that repeat
    assert got[3, near] == 1 and (5, a) not in got  # the smallest id of the near copies
    assert got[4, b + " x"] == 1 and (5, b) not in got  # another text of id 5 belongs to another group
    assert got[None, a] == 2 and got[8, None] == 1 and got[7, None] + got[7, ""] == 1


# 9 -------------------------------------------------------------------------------------------

def smith_waterman(a, b):
    row, best = [0] * (len(a) + 1), 0
    for w in b:
        new = [0]
        for j, v in enumerate(a):
            new.append(max(0, row[j] + (2 if v == w else -1), row[j + 1] - 1, new[j] - 1))
        row = new
        best = max(best, max(row))
    return best / (2 * len(b)) if b else 0.0


@pytest.mark.parametrize("rare", [0.001, 0.0])
def test_leaks_equal_alignment_of_all_pairs(spark, frame, prose, rare):
    """Also where an item is so often copied that none of its n-grams is rare."""
    r = random.Random(6)
    items = [(k, prose(900 + k, r.choice([8, 14, 25]))) for k in range(12)]
    edit = lambda t, n: " ".join(r.choice(WORDS) if k in set(r.sample(range(len(t.split())), n)) else w for k, w in enumerate(t.split()))
    docs = []
    for k in range(80):
        item = items[0 if k % 2 else r.randrange(12)][1]  # item 0 is hot
        docs.append((1000 + k, f"{prose(k, r.randint(0, 60))} {edit(item, r.choice([0, 1, 2, 4, len(item.split()) // 2]))} {prose(300 + k, r.randint(0, 60))}"))
    docs += ODD
    words = decontaminate.words_of
    got = {(x.doc_id, x.item_id): x.score for x in decontaminate.matches(frame(docs), spark.createDataFrame(items, "item_id long, text string"), rare=rare).collect() if x.doc_id is not None}
    grams = lambda w, n: {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    for i, text in docs:
        if i is None or len(text or "") > 10_000:
            continue
        w = words(text or "")
        for item, t in items:
            v, score = words(t), smith_waterman(w, words(t))
            shared = len(grams(w, 3) & grams(v, 3))
            if (i, item) in got:
                assert got[i, item] <= score + 1e-9 and got[i, item] >= 0.5
            elif score >= 0.5:
                assert shared < 2, (i, item, score, shared)


# pipeline ------------------------------------------------------------------------------------

def test_pipeline_equals_its_stages_in_plain_python(spark, tmp_out):
    """Toxic texts, a footer, near copies and leaks among clean documents, and every odd row."""
    from tokenizers import Tokenizer

    r = random.Random(8)
    text = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    bad = ["zgrubbel", "vlorpish", "krethnar"]
    rows = list(ODD)
    clean_ids = []
    for k in range(110):
        clean_ids.append(1000 + k)
        rows.append((1000 + k, text(60) + ("\nthis footer line stands on all pages of the site" if k < 15 else "") + "\n" + text(30)))
    toxic_ids = list(range(2000, 2040))
    rows += [(i, " ".join(w if r.random() < 0.8 else r.choice(bad) for w in text(50).split(" ")) + " " + " ".join(bad)) for i in toxic_ids]
    base = text(80)
    rows += [(3000 + k, " ".join([*base.split(" ")[:-1], f"end{k}"])) for k in range(6)] + [(3100, base), (3101, base)]
    items = [(k, text(18)) for k in range(4)]
    leaks = list(range(4000, 4008))
    rows += [(i, f"{text(40)} {items[i % 4][1]} {text(40)}") for i in leaks]
    spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_out}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic_ids)) for i in [*clean_ids, *toxic_ids]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_out}/benchmark.parquet")
    assert {zlib.crc32(str(i).encode()) % 5 == 0 for i in toxic_ids} == {True, False}  # some are held out

    got = sorted(((x.doc_id, x.n_tokens, x.ids_sha256) for x in corpus_pipeline.run(spark, tmp_out).collect()), key=str)
    left, seen = [], set()
    for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0])):
        if i in toxic_ids or i in leaks:
            continue
        t = "\n".join(x for x in (t or "").split("\n") if "footer" not in x)
        if i is not None and (i >= 3000 or (i, t) in seen):  # near copies: the first; rows that repeat: one
            if i != 3000:
                continue
        seen.add((i, t))
        left.append((i, t))
    library = Tokenizer.from_file(BPE)
    want = []
    for i, t in left:
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), __import__("hashlib").sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    assert [x[0] for x in got] == [x[0] for x in sorted(want, key=str)]
    assert got == sorted(want, key=str)


def test_pipeline_on_empty_tables(spark, tmp_out):
    for name, shape in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], shape).write.parquet(f"{tmp_out}/{name}.parquet")
    assert corpus_pipeline.run(spark, tmp_out).count() == 0


def test_stages_keep_the_columns_of_documents(spark, frame, tmp_out):
    docs = frame(ODD).drop("th")
    for name, shape in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], shape).write.parquet(f"{tmp_out}/{name}.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tmp_out)
        assert out.columns == docs.columns, name
        assert out.where(F.col("doc_id").isNull()).count() == 1, name
