"""Token ids as directly addressable codes (Brisaboa, Ladra and Navarro 2013).

An id is split into chunks of ``WIDTH`` bits, lowest first. Level 0 holds the first chunk of
every id; a level's bitmap says which of its ids go on, and level k + 1 holds the next
chunks of those, in order. The place of an id's next chunk is the number of ones
before it, which a rank directory gives per 64 ids, so that any id is read by a few
addresses and no block is decoded.

A shard is one binary value::

    magic "DAC1", u8 width, u8 levels, u16 0, u64 documents, u64 ids
    i64 doc_id per document, u8 1 where doc_id is null, u64 place of its first id, and the end
    per level: u64 entries, entries as bytes, bitmap as u64, ranks as u64

all little-endian. Shards are rows of a Parquet table that Spark's committer writes.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.tables import Workspace
from rollcall.llm.words import slices, text_column

MAGIC = b"DAC1"
WIDTH = 8
#: Ids after which a shard is closed; a longer document has a shard of its own.
SHARD_IDS = 1 << 20
#: Pieces of words whose ids are remembered.
KNOWN = 1 << 18
#: Pieces of letters that are encoded as one text.
JOINED = 64
#: Bytes of text whose distinct words are looked up at once.
LOOKED_UP = 4 << 20
#: Punctuation at the end of a word that is a piece of its own. An apostrophe may begin a suffix.
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def encode(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level the chunks, the bitmap of ids that go on, and the ones before each 64."""
    left, levels = ids.astype(np.uint32), []
    while True:
        chunks = (left & np.uint32((1 << WIDTH) - 1)).astype(np.uint8)
        left = left >> np.uint32(WIDTH)
        more = left > 0
        padded = np.zeros(-(-len(more) // 64) * 64, bool)
        padded[: len(more)] = more
        bitmap = np.packbits(padded, bitorder="little").view("<u8")
        ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(bitmap), dtype=np.uint64)))[: len(bitmap)]
        levels.append((chunks, bitmap, ranks.astype("<u8")))
        left = left[more]
        if not len(left):
            return levels


def pack(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    levels = encode(ids)
    null = np.array([x is None for x in doc_ids], np.uint8)
    names = np.array([x or 0 for x in doc_ids], "<i8")
    places = np.concatenate(([0], np.cumsum(counts))).astype("<u8")
    head = struct.pack("<4sBBHQQ", MAGIC, WIDTH, len(levels), 0, len(doc_ids), len(ids))
    parts = [head, names.tobytes(), null.tobytes(), places.tobytes()]
    for chunks, bitmap, ranks in levels:
        parts += [struct.pack("<Q", len(chunks)), chunks.tobytes(), bitmap.tobytes(), ranks.tobytes()]
    return b"".join(parts)


class Shard:
    """Reads a packed shard without copying it."""

    def __init__(self, data: bytes):
        magic, self.width, n_levels, _, n_docs, self.n_ids = struct.unpack_from("<4sBBHQQ", data)
        if magic != MAGIC:
            raise ValueError("not a shard of token codes")
        at = struct.calcsize("<4sBBHQQ")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        names = take("<i8", n_docs)
        null = take("u1", n_docs)
        self.doc_ids = [None if gone else int(x) for x, gone in zip(names, null, strict=True)]
        self.places = take("<u8", n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            n = int(take("<u8", 1)[0])
            self.levels.append((take("u1", n), take("<u8", -(-n // 64)), take("<u8", -(-n // 64))))

    def token(self, place: int) -> int:
        """The id at a place, by one address per level."""
        if not 0 <= place < self.n_ids:
            raise IndexError(place)
        value = 0
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunks[place]) << (self.width * level)
            word, bit = divmod(place, 64)
            ones = int(bitmap[word])
            if not ones >> bit & 1:
                break
            place = int(ranks[word]) + (ones & ((1 << bit) - 1)).bit_count()
        return value

    def tokens(self) -> np.ndarray:
        """All ids."""
        value = np.empty(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            more = np.unpackbits(bitmap.view("u1"), bitorder="little")[: len(chunks)].view(bool)
            own = chunks.astype(np.uint32)
            if len(value):
                own[more] |= value << np.uint32(self.width)
            value = own
        return value

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        ids = self.tokens()
        for name, start, end in zip(self.doc_ids, self.places[:-1], self.places[1:], strict=True):
            yield name, ids[start:end]


class WordTokenizer:
    """A tokenizer whose words never reach over ASCII white space, each piece of a word encoded once.

    A piece is a word, or what comes before and after the boundary between a letter or digit and
    the ASCII punctuation that ends a word, where the tokenizer cuts as well. The ids of
    the first ``KNOWN`` distinct pieces are remembered, which are mostly the frequent ones; others
    are encoded anew in each slice that has them.
    """

    def __init__(self, path: str):
        # Spark runs as many tasks as there are cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.word_end = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        suffix = self.tokenizer.model.end_of_word_suffix
        if suffix:
            self.word_end[[k for word, k in self.tokenizer.get_vocab().items() if word.endswith(suffix)]] = True
        self.pieces: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and where they begin and end."""
        encoded = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        ends = np.concatenate(([0], np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))))
        return np.fromiter(chain.from_iterable(encoded), np.uint32, int(ends[-1])), ends

    def _encoded_letters(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """:func:`_encoded` for pieces of letters: many in one text, told apart by the ids that end a word."""
        texts = [" ".join(pieces[k : k + JOINED]) for k in range(0, len(pieces), JOINED)]
        ids, _ = self._encoded(texts)
        ends = np.flatnonzero(self.word_end[ids]) + 1
        if len(ends) != len(pieces) or (len(ids) and ends[-1] != len(ids)):
            # Some letters become others that the tokenizer cuts at.
            return self._encoded(pieces)
        return ids, np.concatenate(([0], ends))

    def _split(self, word: str) -> tuple[str, str]:
        """A word and the punctuation at its end, if the tokenizer cuts there."""
        body = word.rstrip(TAIL)
        if len(body) in (0, len(word)) or not body[-1].isalpha() or "<|" in word:
            return word, ""
        return body, word[len(body) :]

    def _known(self, pieces: list[str]) -> np.ndarray:
        """The numbers of pieces that are remembered, -1 for others."""
        return np.fromiter(map(self.pieces.get, pieces, repeat(-1)), np.int64, len(pieces))

    def _numbered(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and second piece of each word (-1: none), and ids and ends of all pieces."""
        first, second = self._known(words), np.full(len(words), -1)
        strange = np.flatnonzero(first < 0)
        both = [part for k in strange.tolist() for part in self._split(words[k])]
        distinct = list(dict.fromkeys(both))
        number = self._known(distinct)
        new = [distinct[k] for k in np.flatnonzero(number < 0).tolist()]
        letters, others = [x for x in new if x.isalpha()], [x for x in new if not x.isalpha()]
        fresh, known, ids, ends = letters + others, len(self.pieces), self.ids, self.ends
        for more, places in (self._encoded_letters(letters), self._encoded(others)):
            ids, ends = np.concatenate((ids, more)), np.concatenate((ends, places[1:] + ends[-1]))
        numbers = dict(zip(distinct, number.tolist(), strict=True)) | dict(zip(fresh, range(known, known + len(fresh)), strict=True))
        parts = np.fromiter(map(numbers.get, both), np.int64, len(both)).reshape(-1, 2)
        first[strange], second[strange] = parts[:, 0], parts[:, 1]
        if known < KNOWN and fresh:
            self.pieces.update(zip(fresh[: KNOWN - known], range(known, KNOWN), strict=False))
            self.ends = ends[: len(self.pieces) + 1]
            self.ids = ids[: self.ends[-1]]
        return first, second, ids, ends

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        parts = pc.ascii_split_whitespace(text_column(texts))
        coded = parts.flatten().dictionary_encode()
        first, second, ids, ends = self._numbered(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        # Ids of the distinct words one after another.
        pieces = np.stack((first, second), axis=1).ravel()
        pieces = pieces[pieces >= 0]
        ids = ids[_runs(ends[pieces], ends[pieces + 1] - ends[pieces])]
        n = np.diff(ends)
        n = n[first] + np.where(second >= 0, n[second], 0) if len(n) else np.zeros(len(first), np.int64)
        starts = np.cumsum(n) - n

        word = np.asarray(coded.indices)
        n = n[word]
        found = ids[_runs(starts[word], n)]
        places = np.concatenate(([0], np.cumsum(n)))
        of_text = np.asarray(parts.offsets, np.int64)
        return found, np.diff(places[of_text - of_text[0]])


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length says, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


@lru_cache(maxsize=1)
def tokenizer_of(path: str) -> WordTokenizer:
    """One tokenizer per Python worker, which serves many tasks."""
    return WordTokenizer(path)


def _packed(path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer, part = tokenizer_of(path), TaskContext.get().partitionId()
        names, counts, ids, held, number = [], [], [], 0, 0

        def closed() -> pa.RecordBatch:
            data = pack(names, counts, np.concatenate(ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([held], pa.int64()), pa.array([data], pa.binary())],
                ["part", "number", "n_ids", "codes"],
            )

        for batch in batches:
            for some in slices([batch], 1, LOOKED_UP):
                found, lengths = tokenizer(some.column(1))
                for name, own in zip(some.column(0).to_pylist(), np.split(found, np.cumsum(lengths)[:-1]), strict=True):
                    if held and held + len(own) + 1 > shard_ids:
                        yield closed()
                        names, counts, ids, held, number = [], [], [], 0, number + 1
                    names.append(name)
                    counts.append(len(own) + 1)
                    ids += [own, np.array([end_id], np.uint32)]
                    held += len(own) + 1
        if names:
            yield closed()

    return run


def write_codes(
    documents: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    shard_ids: int = SHARD_IDS,
    partitions: int | None = None,
) -> None:
    """Encode every text, in ascending doc_id order, into shards of codes at ``path``.

    Range partitioning puts parts in order; each is sorted and cut into shards of about
    ``shard_ids`` ids. ``tokenizer`` is a file of the tokenizers library whose words
    never reach over ASCII white space. Null and empty texts give the end id alone.
    A null doc_id comes first. Rows of one doc_id lie in the order of a hash of their texts,
    which also splits them over partitions.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    rows = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    rows.sortWithinPartitions(*order, "text").mapInArrow(
        _packed(tokenizer, end_id, shard_ids), "part int, number long, n_ids long, codes binary"
    ).write.mode("overwrite").parquet(path)


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for codes, start in zip(batch["codes"], batch["start"], strict=True):
            shard = Shard(codes)
            rows = []
            for (name, ids), place in zip(shard.documents(), shard.places, strict=False):
                rows.append((name, start + int(place), len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
            frame = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})


def shard_starts(shards: DataFrame, work: Workspace) -> DataFrame:
    """Column ``start``: ids of all shards before. Parts are added up first, so that the
    window over everything has a row per part. The starts are written, so that Spark knows
    their size and moves no codes while they are few."""
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "number", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("start"))
    places = places.join(parts, "part").select("part", "number", (F.col("start") + F.col("before")).alias("start"))
    return shards.join(work.write(places, "starts"), ["part", "number"])


def read_digests(shards: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from its shard."""
    return shard_starts(shards, work).select("codes", "start").mapInPandas(
        _digests, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for codes in batch["codes"]:
            for name, ids in Shard(codes).documents():
                yield pd.DataFrame({"doc_id": pd.array([name], "Int64"), "ids": [ids.astype(np.int32)]})


def read_ids(shards: DataFrame) -> DataFrame:
    """doc_id and ids of every document."""
    return shards.select("codes").mapInPandas(_ids, "doc_id long, ids array<int>")
