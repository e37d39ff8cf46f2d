"""Words and hashed word shingles of Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: ASCII white space; everything else belongs to words.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: All ASCII but digits and letters.
NOT_ALPHANUMERIC = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

#: Bytes of text that are worked on at once.
SLICE = 2 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def slices(batches: Iterable[pa.RecordBatch], text: int, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with about ``size`` bytes of text, a row at least.

    Words and hashes take several times the room of the text; a slice bounds them.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, end - start)
            start = end


def text_column(column: pa.Array) -> pa.Array:
    """Null becomes the empty text; offsets are 64 bits wide."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Where each text of a :func:`text_column` begins and ends in its bytes, and these."""
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(len(column) + 1, np.int64), memoryview(b"")
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return ends - ends[0], memoryview(data)[ends[0] : ends[-1]]


def _replaced(column: pa.Array, separators: bytes) -> pa.Array:
    """A-Z in lower case and separators as spaces. Bytes of other characters stay."""
    to = bytearray(range(256))
    to[0x41:0x5B] = range(0x61, 0x7B)
    for byte in separators:
        to[byte] = 0x20
    ends, data = text_bytes(column)
    new = pa.py_buffer(bytes(data).translate(bytes(to)))
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(np.ascontiguousarray(ends)), new)


def words(column: pa.Array, separators: bytes = BLANKS) -> tuple[pa.Array, np.ndarray]:
    """All words of the column in order, and the n + 1 places where rows begin and end."""
    parts = pc.ascii_split_whitespace(_replaced(text_column(column), separators))
    values = parts.flatten()
    real = pc.not_equal(values, "")
    places = np.concatenate(([0], np.cumsum(np.asarray(real), dtype=np.int64)))
    rows = np.asarray(parts.offsets, dtype=np.int64)
    return values.filter(real), places[rows - rows[0]]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(values: pa.Array) -> np.ndarray:
    """One 64-bit hash per word; each distinct word is hashed once."""
    coded = values.dictionary_encode()
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return each[np.asarray(coded.indices)] if len(each) else np.empty(0, np.uint64)


def shingle_sets(
    column: pa.Array, size: int, separators: bytes = BLANKS, short: bool = True, also: tuple[int, ...] = ()
) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of ``size`` consecutive words.

    With ``short``, a row of fewer words has its whole sequence as its one shingle;
    without, it has none. A row without words has none. ``also`` adds runs of fewer words, hashed
    as a row would be that has no other words.
    """
    values, rows = words(column, separators)
    word = hashed(values)
    ends = max(len(word) - size + 1, 0)
    rolled = np.zeros(ends, np.uint64)
    for k in range(size):
        rolled = rolled * _STEP + word[k : k + ends]
    rolled = mixed(rolled)
    fewer = {n: _sequences(word, n) for n in also}
    for start, end in zip(rows[:-1], rows[1:], strict=True):
        if also:
            runs = [rolled[start : max(start, end - size + 1)]]
            yield np.unique(np.concatenate(runs + [fewer[n][start : max(start, end - n + 1)] for n in also]))
        elif end - start >= size:
            yield np.unique(rolled[start : end - size + 1])
        elif short and end > start:
            yield _sequences(word[start:end], int(end - start))
        else:
            yield np.empty(0, np.uint64)


def _sequences(word: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words that depends on how many they are."""
    places = max(len(word) - size + 1, 0)
    total = np.full(places, size, np.uint64)
    for k in range(size):
        total = total * _STEP + word[k : k + places]
    return mixed(total)


def list_column(arrays: list[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit hashes as one column of ``array<bigint>``."""
    lengths = np.fromiter(map(len, arrays), np.int64, len(arrays))
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64)))
