"""Operator 3: BPE encoding and decoding by a traversal of a trie of distinct words.

Method
------
Spark deals out the documents; in a task, the distinct words of a batch of
texts that have not been met yet are put into a trie, held as its depth-first
order (``_encode_words``). The walk gives each node the *last token* of its
prefix's encoding once, whatever number of words share it: the encoding of a prefix is the
encoding of a shorter prefix followed by one token that is a suffix of it and
*compatible* with the last token there. Two tokens are compatible when BPE
leaves them as they are next to each other, which the merges along the edges
of their two merge trees decide (``Vocabulary.compatible``). Exactly one suffix
fits, so a word is read off the back pointers of its path.

The vocabulary is a ``tokenizers`` JSON file with byte-level symbols and an
end-of-word suffix; its path is a parameter and the file must be readable on
every executor (it is part of an installed package). Nothing is trained.

Cases: a null text is encoded as empty (no ids); special tokens written out in
a text become their ids; words of any length are walked without recursion;
texts with characters outside Latin blocks go through the library's own
normaliser and pre-tokeniser, others through equal, faster expressions. Each
row is encoded by itself, so repeated rows and null ids do no harm.

Memory: a worker keeps what it has found (encoded words, trie steps, pairs of tokens)
while it works on a partition, and drops it when the characters kept pass ``KEPT_CHARS``
or the partition ends, as workers outlive a stage (only the vocabulary, about 75 MB, stays
for the next partition). Batches are cut to ``BATCH_CHARS``, so at most one batch's words are
held beyond the bound.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from contrail.llm.common import texts

KEPT_CHARS = 12_000_000  # of words, ids and tokens that a worker keeps; about ten bytes of memory each
BATCH_CHARS = 1_000_000
STEPS, PAIRS = 150_000, 250_000  # trie steps and pairs of tokens kept
#: Code points for which Python and the library agree on case, classes and composition.
PLAIN = regex.compile(r"[\t-\r -~¡-ſ]*")


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else the next code point from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


def tokenizer_path(name: str) -> str:
    """Where the installed package keeps a tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Vocabulary:
    """Tokens, merges and text preparation of one tokenizer file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.halves = {a + b: (a, b) for a, b in reversed(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.library = Tokenizer.from_file(path)
        symbols = _byte_symbols()
        self.symbols = {b: s for b, s in enumerate(symbols)}
        self.beginnings = {t.removesuffix(self.end)[:n] for t in self.ids for n in range(len(t) + 1)}
        self.steps: dict[str, tuple] = {}
        self.edges: dict[tuple[str, int], list[tuple[str, int, float]]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.tokens = {str(i): t for t, i in (self.ids | self.special).items()}  # by decimal id, for decoding

    def _edge(self, token: str, side: int) -> list[tuple[str, int, float]]:
        """The nodes at one side (0 left, 1 right) of a token's merge tree: (piece, rank that forms it, rank that uses it up)."""
        if (found := self.edges.get((token, side))) is None:
            found, piece, used = [], token, float("inf")
            while True:
                halves = self.halves.get(piece)
                formed = self.rank[halves] if halves else -1
                found.append((piece, formed, used))
                if not halves:
                    break
                piece, used = halves[side], formed
            self.edges[token, side] = found
        return found

    def compatible(self, left: str, right: str) -> bool:
        """Does BPE keep these two tokens apart? A merge across them happens if both of its
        pieces stand at the border when its turn comes; of equal merges the leftmost goes first."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        rank = self.rank
        self.pairs[left, right] = fits = not any(
            (m := rank.get((a, b))) is not None and a_formed < m < a_used and b_formed < m <= b_used
            for a, a_formed, a_used in self._edge(left, 1) for b, b_formed, b_used in self._edge(right, 0))
        return fits

    def cut(self, chunk: str) -> list[str]:
        """The words of a chunk of text without white space; "\\0" marks one that the library cut and spelled, "\\1" a special token."""
        if chunk.isalpha():
            return [chunk]
        if chunk[0] <= "\1":
            return [chunk] if chunk[0] == "\0" else []
        if chunk[-1] in ",." and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.words.findall(chunk)

    def spelled(self, word: str) -> str:
        """A word in byte symbols."""
        if word[0] == "\0":
            return word[1:]
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.symbols)

    def step(self, grown: str) -> tuple[str, list[tuple[str, int]], list[tuple[str, int]]]:
        """What a trie node needs of its path, given its parent's state and its symbol: the longest suffix that
        begins a token, and the tokens (with their lengths, longest first) that end there, within a word and at its end."""
        if len(self.steps) > STEPS:
            self.steps.clear()
        s = grown
        while s not in self.beginnings:
            s = s[1:]
        tails = [s[i:] for i in range(len(s))]
        self.steps[grown] = found = (
            s, [(t, len(t)) for t in tails if t in self.ids], [(t + self.end, len(t)) for t in tails if t + self.end in self.ids])
        return found


def _encode_words(v: Vocabulary, words: set[str]) -> dict[str, list[str]]:
    """Tokens of each word. Sorted words are a trie in depth-first order: what a word shares with the one
    before is the path to the node where they part. The walk keeps the path's states and last tokens,
    so those of a shared prefix are found once."""
    out: dict[str, list[str]] = {}
    known, step, compatible, pairs = v.steps, v.step, v.compatible, v.pairs
    states: list[str] = [""]  # by depth: the longest suffix of the prefix that begins a token
    last: list[tuple[str, int]] = [("", 0)]  # by depth: last token of the prefix's encoding, its length
    before = ""
    for spelled, word in sorted([(v.spelled(w), w) for w in words]):
        depth = min(len(before), len(spelled) - 1)  # the last symbol differs at a word's end
        while not spelled.startswith(before[:depth]):
            depth -= 1
        del states[depth + 1:], last[depth + 1:]
        state = states[depth]
        for symbol in spelled[depth:]:
            depth += 1
            state, inside, ending = known.get(state + symbol) or step(state + symbol)
            ends = depth == len(spelled)
            for found in ending if ends else inside:
                n = found[1]
                if n == depth:
                    break
                pair = (last[depth - n][0], found[0])
                fits = pairs.get(pair)
                if compatible(*pair) if fits is None else fits:
                    break
            else:
                raise ValueError(f"no token fits the end of {spelled[:depth]!r}")
            if not ends:
                states.append(state)
                last.append(found)
        token, n = found
        tokens, at = [token], depth - n
        while at:
            token, n = last[at]
            tokens.append(token)
            at -= n
        tokens.reverse()
        out[word] = tokens
        before = spelled[:-1]
    return out


class Known:
    """What a worker knows of encoded chunks: their ids and tokens, bounded by characters."""

    def __init__(self, most: int) -> None:
        self.ids: dict[str, str] = {}
        self.most, self.chars = most, 0

    def put(self, chunk: str, ids: str) -> None:
        self.ids[chunk] = ids
        self.chars += len(chunk) + len(ids) + 12  # an entry's own share

    def room(self) -> None:
        if self.chars > self.most:
            self.ids.clear()
            self.chars = 0


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_texts(path: str, batch: list[str], known: Known) -> Iterator[tuple[str, int]]:
    """(ids joined by blanks, number) of each text.

    A text is cut at its special tokens, then at white space into chunks, which no word crosses."""
    v, ids_of = _vocabulary(path), known.ids
    known.room()
    cut = []
    for t in batch:
        chunks: list[str] = []
        for s in v.specials.split(t) if "<|" in t else (t,):
            if s in v.special:
                chunks.append("\1" + s)  # apart from the same letters in an ordinary text
            elif PLAIN.fullmatch(s):
                chunks.extend(s.lower().split())
            else:  # the library's own normaliser and pre-tokeniser; "\0" marks words in byte symbols
                chunks.extend("\0" + w for w, _ in v.library.pre_tokenizer.pre_tokenize_str(v.library.normalizer.normalize_str(s)))
        cut.append(chunks)
    new = set()
    for chunks in cut:
        new.update(chunks)
    new -= ids_of.keys()
    words = {c: v.cut(c) for c in new}
    for w, tokens in _encode_words(v, {w for ws in words.values() for w in ws} - ids_of.keys()).items():
        known.put(w, " ".join([str(v.ids[t]) for t in tokens]))
    for c, ws in words.items():
        if c[0] == "\1":
            known.put(c, str(v.special[c[1:]]))
        elif len(ws) != 1 or ws[0] != c:
            known.put(c, " ".join([ids_of[w] for w in ws]))
    for chunks in cut:
        ids = " ".join(map(ids_of.__getitem__, chunks))
        yield ids, ids.count(" ") + 1 if ids else 0


def encode(docs: DataFrame, path: str, keep_texts: bool = True, kept_chars: int = KEPT_CHARS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), with ``keep_texts`` also the ids and
    the decoded text themselves. ``kept_chars``: characters of encoded words that a worker keeps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from encoded(batches)
        finally:  # workers are used again by later stages
            v = _vocabulary(path)
            v.steps.clear()
            v.pairs.clear()
            v.edges.clear()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sha(s: str) -> str:
            return hashlib.sha256(s.encode()).hexdigest()

        known, token_of = Known(kept_chars), _vocabulary(path).tokens
        for b in batches:
            begin = 0
            column, sizes = b.column("text"), [len(t.as_py()) for t in b.column("text")]
            while begin < b.num_rows:  # bounded by characters, as texts can be very long
                end, chars = begin, 0
                while end < b.num_rows and (end == begin or chars + sizes[end] <= BATCH_CHARS):
                    chars += sizes[end]
                    end += 1
                rows = list(encode_texts(path, column.slice(begin, end - begin).to_pylist(), known))
                decoded = [" ".join(map(token_of.__getitem__, r[0].split())) for r in rows]
                out = [b.column("doc_id").slice(begin, end - begin), pa.array([r[1] for r in rows], pa.int64()),
                       pa.array([sha(r[0]) for r in rows]), pa.array([sha(d) for d in decoded])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_texts:
                    out += [pa.array([r[0] for r in rows], pa.string()), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names)
                begin = end

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string, decoded string" * keep_texts
    return texts(docs).mapInArrow(run, schema)


def decode(v: Vocabulary, ids: list[int]) -> str:
    """The text of ids: their tokens joined by blanks, special tokens included, as the file names no decoder. Unknown ids are left out."""
    return " ".join(v.tokens[str(i)] for i in ids if str(i) in v.tokens)
