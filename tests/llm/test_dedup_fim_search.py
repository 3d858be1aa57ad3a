"""Operators 11 to 13 on small fixtures, against brute force; every odd case without a crash."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import fill_middle, hyper_minhash, lexical_search
from tests.llm.conftest import ODD, WORDS

W = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


# 11 ------------------------------------------------------------------------------------------

def classes(rows, n, percent):
    """(id, set size, smallest id reachable) by all pairs; rows of one id are one document with several sets."""
    sets = []
    for i, t in rows:
        w = W.findall(lower(t or ""))
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset())
    root = {i: i for i, _ in rows if i is not None}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i, j = rows[a][0], rows[b][0]
            if i is not None and j is not None and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return sorted((str(i), len(s), str(top(i)) if i is not None else "None", i is None or top(i) == i) for (i, _), s in zip(rows, sets))


def edited(r, text, share):
    return " ".join(r.choice(WORDS) if r.random() < share else w for w in text.split(" "))


@pytest.mark.parametrize("n, percent", [(5, 85), (5, 80), (1, 100)])
def test_classes_equal_brute_force(frame, prose, n, percent):
    r = random.Random(3)
    rows = list(ODD)
    for k in range(25):  # groups of near copies of texts of all lengths, with chains
        text = prose(k, r.choice([1, 3, 5, 6, 9, 20, 60, 300]))
        for c in range(r.randint(1, 6)):
            rows.append((100 + len(rows), text))
            text = edited(r, text, r.choice([0, 0.005, 0.02, 0.05]))
    rows += [(90, prose(0, 4).upper()), (7, "a b c d e f g"), (7, "quite other words stand here now")]
    got = hyper_minhash.dedup(frame(rows), n, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id), x.kept) for x in got.collect()) == classes(rows, n, percent)
    assert hyper_minhash.dedup(frame([]).limit(0)).count() == 0


def test_crowded_keys_and_large_units(frame, prose, monkeypatch):
    """A group of near copies beyond the bounds of keys and blocks, among documents that share a passage: the same classes."""
    monkeypatch.setattr(hyper_minhash, "CROWD", 8)
    monkeypatch.setattr(hyper_minhash, "BLOCK", 10)
    r = random.Random(5)
    base, passage = prose(1, 120), prose(2, 60)
    rows = [(1000 - k, edited(r, base, 0.008)) for k in range(60)] + [(2000 + k, passage + " " + prose(500 + k, 40)) for k in range(60)]
    got = hyper_minhash.dedup(frame(rows))
    assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id), x.kept) for x in got.collect()) == classes(rows, 5, 85)


def test_registers_hold_zeros_and_mantissa_of_the_least_hash():
    r = np.random.default_rng(0)
    members = r.integers(0, 2**63, 400).astype(np.uint64)
    got = hyper_minhash.registers(members)
    for p in range(hyper_minhash.PERMUTATIONS):
        least = {}
        for m in members.tolist():
            h = ((m ^ int(hyper_minhash.SEEDS[p])) * int(hyper_minhash.MIX)) % 2**64
            h ^= h >> 32
            h = h * int(hyper_minhash.MIX) % 2**64
            h ^= h >> 29
            least[h % hyper_minhash.BUCKETS] = min(least.get(h % hyper_minhash.BUCKETS, 1 << 56), h >> 8)
        for b in range(hyper_minhash.BUCKETS):
            bits = format(least[b], "056b") if b in least else None
            want = 0 if bits is None else (bits.index("1") + 1) << 10 | int((bits[bits.index("1") + 1:] + "0" * 10)[:10], 2)
            assert got[p * hyper_minhash.BUCKETS + b] == want
    assert not hyper_minhash.registers(np.zeros(0, np.uint64)).any()
    assert (hyper_minhash.registers(members[::-1]) == got).all()


def test_estimates_are_close_and_corrected():
    r = np.random.default_rng(1)
    for share in (0.0, 0.5, 0.85):
        errors = []
        for _ in range(40):
            u = r.integers(0, 2**63, 600).astype(np.uint64)
            k = int(600 * share)
            a, b = u[:k + (600 - k) // 2], np.concatenate([u[:k], u[k + (600 - k) // 2:]])
            e, used = hyper_minhash.estimates(hyper_minhash.registers(a), len(a), hyper_minhash.registers(b)[None], np.array([len(b)]))
            errors.append(e[0] - share)
            assert used[0] == hyper_minhash.REGISTERS
        assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


# 12 ------------------------------------------------------------------------------------------

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def transformed(doc_id, text, percent=50, spm=80):
    text = text or ""
    units = UNITS.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= percent:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return doc_id, n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


FIM = ODD + [(30, "x <P> y"), (31, "<<P"), (32, "a<S"), (33, "é 日本   x y 🎉"), (34, " lead"), (35, "trail \n"), (36, "P>a <"), (37, "<M b >S")] + [
    (k, f"<{k} word> é{'z' * k}\t end <S") for k in range(40, 120)]


@pytest.mark.parametrize("percent", [50, 100])
def test_fill_in_middle_equals_brute_force_and_restores(frame, percent):
    out = fill_middle.transform(frame(FIM), percent=percent)
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect()), key=str)
    assert got == sorted((transformed(i, t, percent) for i, t in FIM), key=str)
    assert {g[2] for g in got} == {"plain", "spm", "psm"}
    back = fill_middle.restore(out)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(((i, t or "") for i, t in FIM), key=str)
    assert sorted((r.restored_sha256 for r in fill_middle.digest(back).collect())) == sorted(sha(t or "") for _, t in FIM)
    assert fill_middle.restore(fill_middle.transform(frame([]).limit(0))).count() == 0
    with pytest.raises(ValueError, match="text"):
        fill_middle.restore(back)
    with pytest.raises(ValueError, match="form"):
        fill_middle.rebuild(b"x", "other")


@pytest.mark.parametrize("cut", [0, 1, 3, 70_000, 199_999, 200_000])
def test_rotation_in_place(cut):
    whole = bytes(random.Random(cut).randbytes(200_010))
    buffer = bytearray(whole)
    fill_middle.rotate(buffer, 5, 5 + cut, 200_005)
    assert bytes(buffer) == whole[:5] + whole[5 + cut:200_005] + whole[5:5 + cut] + whole[200_005:]
    fill_middle.rotate(buffer, 5, 200_005 - cut, 200_005)
    assert bytes(buffer) == whole


# 13 ------------------------------------------------------------------------------------------

def ranked(docs, items, k=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    counts = [(i, Counter(term.findall(lower(t or "")))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 10 + 90 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in set(term.findall(lower(text or ""))) if c[w])
            if s > 0:
                scored.append((-s, math.inf if i is None else i, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:k])]
    return sorted(out, key=str)


@pytest.fixture()
def items(spark):
    return lambda rows: spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, rank string")


def test_search_equals_brute_force(frame, items, prose):
    docs = ODD + [(100 + k, prose(k, 5 + 7 * k)) for k in range(60)] + [(300, "same words tie"), (301, "Same, WORDS; tie"), (302, "tie words same"), (7, "same tie"), (7, "tie tie"), (None, "same words tie"),
                                                                         (8, "ÉTÉ été x_y 日本語 日本"), (9, "É́")]
    wanted = [(k, prose(1000 + k, 12) + " W3 w3") for k in range(70)] + [(200, None), (201, ""), (202, "!!"), (203, "unknownword"), (204, "same words tie"), (204, "tie"), (None, "SAME"), (205, "été 日本 x y")]
    got = lexical_search.search(frame(docs), items(wanted))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == ranked(docs, wanted)
    assert sorted(map(tuple, lexical_search.search(frame(docs), items(wanted), k=2).collect()), key=str) == ranked(docs, wanted, 2)


def test_search_by_small_blocks_and_tiles(frame, items, prose, monkeypatch):
    """Many blocks of items, tiles of few terms and documents: the same results."""
    for name, value in (("BLOCK_BYTES", 400), ("ITEM_TILE", 3), ("TERM_TILE", 4), ("DOC_TILE", 5), ("FAN_IN", 2), ("TILE_CELLS", 60)):
        monkeypatch.setattr(lexical_search, name, value)
    docs = [(k, prose(k % 20, 30)) for k in range(45)]  # texts that repeat tie
    wanted = [(k, prose(k % 20, 10)) for k in range(25)]
    assert sorted(map(tuple, lexical_search.search(frame(docs), items(wanted)).collect()), key=str) == ranked(docs, wanted)


def test_partial_sums_are_exact():
    """Weights and impacts as large as they get: products of a tile stay below 2^53 and add up as whole numbers."""
    weights = np.full(5000, 40_000, np.int64) - np.arange(5000)
    tile = lexical_search.ItemTile(0, [list(range(5000))], weights)
    assert tile.width * int(tile.weights.max()) * lexical_search.IMPACT < lexical_search.EXACT
    impacts = np.full(5000, 999_999, np.int64)
    got = tile.scores(np.zeros(5000, np.int64), np.arange(5000), impacts, 1)
    assert got[0, 0] == sum(int(w) * 999_999 for w in weights)


def test_search_in_empty_tables(frame, items):
    assert lexical_search.search(frame([]).limit(0), items([(1, "a")])).count() == 0
    assert lexical_search.search(frame([(1, "a")]), items([]).limit(0)).count() == 0
    assert lexical_search.search(frame([(1, None), (2, "")]), items([(1, "a")])).filter(F.col("score") > 0).count() == 0
