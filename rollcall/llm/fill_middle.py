"""Fill-in-the-middle: a text is cut in two places between lines, and its parts change places.

A text's bytes lie in blocks of ``BLOCK``. Two Fenwick trees over the blocks (Fenwick 1994) hold
how many lines end in them and how many code points begin in them. A cut after k lines is
found by binary lifting: the descent from the largest power of two leaves the block in which
the k-th line ends, and only that block is looked through. Code points before a cut
are a sum along the tree and a count within one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.words import slices, text_bytes, text_column

#: Bytes of one block.
BLOCK = 512
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 7


class Fenwick:
    """Sums of counts per block."""

    def __init__(self, counts: np.ndarray):
        before = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        nodes = np.arange(len(before))
        # A node holds the counts of as many blocks as its lowest bit says.
        self.tree = before - before[nodes & (nodes - 1)]
        self.size = len(counts)

    def before(self, block: int) -> int:
        """The sum of the first ``block`` counts."""
        total = 0
        while block:
            total += int(self.tree[block])
            block &= block - 1
        return total

    def find(self, k: int) -> tuple[int, int]:
        """The block that holds the k-th unit (from 1 on), and the units before that block."""
        block, total = 0, 0
        step = 1 << self.size.bit_length()
        while step:
            reached = block + step
            if reached <= self.size and total + self.tree[reached] < k:
                block, total = reached, total + int(self.tree[reached])
            step >>= 1
        return block, total


class Lines:
    """Cuts between the lines of a text of UTF-8 bytes."""

    def __init__(self, data: np.ndarray, block: int = BLOCK):
        self.data, self.block = data, block
        starts = np.arange(0, len(data), block)
        self.ends = data == 0x0A
        self.points = (data & 0xC0) != 0x80
        per_block = lambda flags: np.add.reduceat(flags, starts, dtype=np.int64) if len(starts) else np.empty(0, np.int64)
        self.of_lines, self.of_points = Fenwick(per_block(self.ends)), Fenwick(per_block(self.points))
        whole = self.of_lines.before(len(starts))
        self.n = whole + bool(len(data) and not self.ends[-1])

    def place(self, k: int) -> int:
        """The byte after the first k lines."""
        if k == 0 or k == self.n:
            return len(self.data) if k else 0
        block, before = self.of_lines.find(k)
        start = block * self.block
        return start + int(np.flatnonzero(self.ends[start : start + self.block])[k - before - 1]) + 1

    def code_points(self, place: int) -> int:
        """Code points before a byte."""
        block = place // self.block
        return self.of_points.before(block) + int(np.count_nonzero(self.points[block * self.block : place]))


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits that a document's id decides on."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def transformed(data: bytes, doc_id: int | None, rate: int = 100, spm: int = 50, seed: int = SEED) -> tuple:
    """n, form, prefix_chars, middle_chars and the output of one text."""
    lines = Lines(np.frombuffer(data, np.uint8))
    h = draws(doc_id, seed)
    if not data or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= rate:
        return lines.n, "plain", None, None, data
    first, second = sorted(lines.place(x % (lines.n + 1)) for x in h[:2])
    prefix, middle, suffix = data[:first], data[first:second], data[second:]
    before = lines.code_points(first)
    sizes = before, lines.code_points(second) - before
    if h[3] % 100 < spm:
        return lines.n, "spm", *sizes, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return lines.n, "psm", *sizes, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restored(output: bytes, form: str) -> bytes:
    """The text that an output of this form was made from."""
    if form == "plain":
        return output
    marks = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    places = [output.index(mark) for mark in marks]
    ends = [*places[1:], len(output)]
    part = {mark: output[at + len(mark) : end] for mark, at, end in zip(marks, places, ends, strict=True)}
    return part[PREFIX] + part[MIDDLE] + part[SUFFIX]


_FILLED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()), ("output", pa.large_string()), ("restored", pa.large_string()),
    ]
)


def _filled(rate: int, spm: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices([batch], 1):
                places, data = text_bytes(text_column(some.column(1)))
                rows = []
                for doc_id, start, end in zip(some.column(0).to_pylist(), places[:-1], places[1:], strict=True):
                    found = transformed(bytes(data[start:end]), doc_id, rate, spm, seed)
                    rows.append((doc_id, *found, restored(found[-1], found[1])))
                arrays = [_texts(x) if pa.types.is_large_string(f.type) else pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _FILLED, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_FILLED)

    return run


def _texts(values: tuple[bytes, ...]) -> pa.Array:
    return pa.array(values, pa.large_binary()).cast(pa.large_string())


def filled_middle(documents: DataFrame, rate: int = 100, spm: int = 50, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, restored per row of ``documents`` (doc_id, text).

    A text is cut into n lines, each with the line feed that ends it, and in two places between
    them that the doc_id draws. ``form`` is psm (``<P>`` prefix ``<S>`` suffix ``<M>`` middle), spm (``<S>``
    suffix ``<P>`` prefix ``<M>`` middle) for ``spm`` percent of the drawn, or plain: the text as it is,
    for all but ``rate`` percent, for empty texts and those that hold a mark themselves. Then
    the code points of prefix and middle are null. ``restored`` is rebuilt from ``output`` and
    ``form`` alone.

    A null text is empty. Rows without a doc_id draw with an empty one. Rows of one doc_id draw
    the same numbers. An empty table gives no rows. Other columns aren't read. Nothing is
    shuffled; a task holds a slice of its texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    kinds = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string"
    return rows.mapInArrow(_filled(rate, spm, seed), kinds)
