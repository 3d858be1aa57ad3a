"""Operator 12: fill-in-middle transformation by in-place block rotation.

Method
------
One scan of a text finds its units (white space with the word that follows, or
white space alone) and two cuts between units, drawn from a hash of the
document's id. The text becomes one bytearray with the three sentinels inserted
at the cuts, ``<P>prefix<M>middle<S>suffix``, and two neighbouring blocks are then
exchanged in place by three reversals: the last two for ``psm``
(``<P>prefix<S>suffix<M>middle``), the first two and the last for ``spm``
(``<S>suffix<P>prefix<M>middle``). ``restore`` finds the sentinels, rotates back and
takes the sentinels out, which gives the exact text again. A reversal swaps
through a buffer of fixed size, so a text needs its bytes once.

A text that holds a sentinel stays plain, so sentinels are found without doubt:
no sentinel can begin or end inside another or across a border of one.

Scale: one pass without a shuffle; texts are handled as UTF-8 bytes one by one
and given on in batches of bounded size.

Cases: a null text is empty and plain; a text without words is one unit; a null
``doc_id`` is drawn as an empty id; rows that repeat give equal rows; extra columns
are ignored; an empty table gives an empty result. Lengths count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.common import texts

P, S, M = b"<P>", b"<S>", b"<M>"
UNITS = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SWAP = 1 << 16  # bytes exchanged at a time
OUT_BYTES = 8 << 20  # of a batch that is given on


def _reverse(a: np.ndarray) -> None:
    """Reverses an array of bytes where it stands."""
    low, high = 0, len(a)
    while high - low > 1:
        k = min(SWAP, (high - low) // 2)
        held = a[low:low + k].copy()
        a[low:low + k] = a[high - k:high][::-1]
        a[high - k:high] = held[::-1]
        low, high = low + k, high - k


def rotate(buffer: bytearray, begin: int, cut: int, end: int) -> None:
    """Exchanges the blocks begin:cut and cut:end in place by three reversals."""
    a = np.frombuffer(buffer, np.uint8)
    _reverse(a[begin:cut])
    _reverse(a[cut:end])
    _reverse(a[begin:end])


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The first four 32-bit numbers of the hash of seed and id."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[8 * k:8 * k + 8], 16) for k in range(4)]


def arrange(text: bytes, doc_id: int | None, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> tuple[int, str, tuple[int, int] | None, bytes]:
    """(number of units, form, byte offsets of the cuts or None, output) of a text."""
    stops = [0, *(m.end() for m in UNITS.finditer(text))]
    h1, h2, h3, h4 = draws(doc_id, seed)
    n = len(stops) - 1
    if not text or any(s in text for s in (P, S, M)) or h3 % 100 >= percent:
        return n, "plain", None, text
    i, j = sorted((stops[h1 % (n + 1)], stops[h2 % (n + 1)]))
    buffer = bytearray(text)
    buffer[j:j] = S
    buffer[i:i] = M
    buffer[0:0] = P
    middle, suffix = i + len(P), j + len(P) + len(M)  # where <M> and <S> stand
    if h4 % 100 < spm_percent:
        rotate(buffer, 0, suffix, len(buffer))
        return n, "spm", (i, j), bytes(buffer)
    rotate(buffer, middle, suffix, len(buffer))
    return n, "psm", (i, j), bytes(buffer)


def rebuild(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` was given, from its output and form."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "spm":
        rotate(buffer, 0, buffer.find(P), len(buffer))
    elif form == "psm":
        rotate(buffer, buffer.find(S), buffer.find(M), len(buffer))
    else:
        raise ValueError(f"unknown form {form!r}")
    at = buffer.find(S)
    del buffer[at:at + len(S)]
    at = buffer.find(M)
    del buffer[at:at + len(M)]
    del buffer[:len(P)]
    return bytes(buffer)


def _points(text: bytes) -> int:
    """Code points of UTF-8 bytes: all bytes but continuations."""
    return int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80))


def _bytes(s: pa.Scalar) -> bytes:
    return s.as_buffer().to_pybytes() if s.is_valid else b""


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows that end in a long field, in batches of bounded bytes."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size >= OUT_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def transform(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): ``percent`` of the texts are cut, ``spm_percent`` of these suffix first."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            def rows(b=b) -> Iterator[tuple]:
                for id_, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                    text = _bytes(t)
                    n, form, cuts, output = arrange(text, id_, seed, percent, spm_percent)
                    lengths = (None, None) if cuts is None else (_points(text[:cuts[0]]), _points(text[cuts[0]:cuts[1]]))
                    yield id_, n, form, *lengths, output

            yield from _batches(rows(), schema)

    arranged = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return arranged.withColumn("output", F.col("output").cast("string"))


def restore(arranged: DataFrame) -> DataFrame:
    """``arranged`` (with columns form and output) and ``text``, the exact text that each output was made of."""
    out = pa.schema([("text", pa.binary())])
    names = arranged.columns
    if "text" in names:
        raise ValueError("the rows already have a column text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            begin = 0
            for part in _batches(((rebuild(_bytes(o), f),) for f, o in zip(b.column("form").to_pylist(), b.column("output"))), out):
                rest = b.slice(begin, part.num_rows)
                begin += part.num_rows
                yield pa.RecordBatch.from_arrays([*rest.columns, part.column("text")], [*names, "text"])

    shape = T.StructType([*arranged.schema.fields, T.StructField("text", T.BinaryType())])
    return arranged.mapInArrow(run, shape).withColumn("text", F.col("text").cast("string"))


def digest(restored: DataFrame) -> DataFrame:
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                           F.sha2("text", 256).alias("restored_sha256"))
