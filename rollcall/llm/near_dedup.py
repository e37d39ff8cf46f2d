"""Near-duplicate documents by b-bit MinHash.

1. Every text becomes the set of its hashed word shingles. Texts with equal sets form
   one class, represented by its smallest id; copies are never compared.
2. A class has ``HASHES`` minima. Rows of minima make band keys; of each minimum the
   lowest ``BITS`` bits are kept, packed into a few 64-bit numbers.
3. Classes that share a band key are candidates. Per key everyone is compared with the
   smallest class there, which makes as many pairs as members.
4. A pair's similarity is estimated from the packed bits, corrected for values that
   agree by chance. What comes near the threshold is confirmed on the full sets.
5. In keys whose members still lie in different components, all outside the largest one
   are compared with everyone, in blocks, so that no link between components is
   missed. A block returns a link per component that it joins, never its pairs.
6. Components of the confirmed links give the smallest reachable id.

Both sides of the joins of whole tables grow with the corpus; they are merge joins at every
size, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.components import components
from rollcall.llm.tables import Workspace
from rollcall.llm.words import BLANKS, list_column, mixed, shingle_sets, slices

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BITS = 2
PER_LONG = 64 // BITS
PACKED = HASHES // PER_LONG
#: Values agree by chance this often.
CHANCE = 2.0**-BITS
#: Standard deviations below the threshold at which a pair is still confirmed in full.
MARGIN = 5.0
#: Members of a key that one block holds.
BLOCK = 512

_SEEDS = np.random.default_rng(20240607)
_FACTOR = _SEEDS.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)
_SHIFT = _SEEDS.integers(0, 2**64, HASHES, dtype=np.uint64)
_LANES = 0x5555555555555555


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each hash function."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 256):
        part = shingles[start : start + 256, None] * _FACTOR
        part += _SHIFT
        np.minimum(least, part.min(axis=0), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of all minima, ``PER_LONG`` of them to a number."""
    low = mixed(least) & np.uint64(2**BITS - 1)
    places = (np.arange(PER_LONG) * BITS).astype(np.uint64)
    return np.bitwise_or.reduce(low.reshape(PACKED, PER_LONG) << places, axis=1)


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS)
    return np.fromiter(
        (xxhash.xxh3_64_intdigest(row.tobytes(), seed=band) for band, row in enumerate(rows)), np.uint64, BANDS
    )


def _sketches(size: int, separators: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            counts, prints, packs, keys = [], [], [], []
            for shingles in shingle_sets(batch.column(1), size, separators):
                counts.append(len(shingles))
                both = xxhash.xxh3_128_intdigest(shingles.tobytes())
                prints.append((both >> 64, both & (2**64 - 1)))
                least = minima(shingles) if len(shingles) else np.empty(0, np.uint64)
                packs.append(packed(least) if len(shingles) else least)
                keys.append(band_keys(least) if len(shingles) else least)
            prints = np.array(prints, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(prints[:, 0]),
                    pa.array(prints[:, 1]),
                    list_column(packs),
                    list_column(keys),
                ],
                ["doc_id", "n_shingles", "print_1", "print_2", "bits", "bands"],
            )

    return run


def _sets(size: int, separators: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            arrays = list(shingle_sets(batch.column(1), size, separators))
            yield pa.RecordBatch.from_arrays([batch.column(0), list_column(arrays)], ["doc_id", "shingles"])

    return run


def agreement(one: str, other: str) -> Column:
    """How many of the packed values of two columns are equal."""
    equal = F.lit(HASHES)
    for k in range(PACKED):
        x = F.col(one)[k].bitwiseXOR(F.col(other)[k])
        equal = equal - F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_LANES)))
    return equal


def least_agreement(threshold: float) -> float:
    """Equal values that a pair at the threshold has, less ``MARGIN`` deviations."""
    share = CHANCE + (1 - CHANCE) * threshold
    return HASHES * share - MARGIN * (HASHES * share * (1 - share)) ** 0.5


def estimated(equal: Column) -> Column:
    """Similarity from the share of equal values, less what agrees by chance."""
    return F.greatest(F.lit(0.0), (equal / F.lit(HASHES) - F.lit(CHANCE)) / F.lit(1 - CHANCE))


def _similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * shared >= percent * (len(one) + len(other) - shared)


def _equal(bits: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """How many packed values of row i and each of the others are equal."""
    x = bits[others] ^ bits[i]
    return HASHES - np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_LANES)).sum(axis=1, dtype=np.int64)


def _bits_of(frame: pd.DataFrame) -> np.ndarray:
    return np.array(frame["bits"].tolist(), np.int64).reshape(-1, PACKED).view(np.uint64)


def _apart(frame: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """For each asking row of a block, the others of other components."""
    asks, component = frame["asks"].to_numpy(), frame["component"].to_numpy()
    others = np.flatnonzero(~asks)
    for i in np.flatnonzero(asks):
        yield i, others[component[others] != component[i]]


def _plausible(least: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        bits, found = _bits_of(frame), np.zeros(len(frame), bool)
        for i, others in _apart(frame):
            near = others[_equal(bits, i, others) >= least]
            found[near] = True
            found[i] = len(near) > 0
        return frame.loc[found, ["key", "asking", "held", "asks", "rep", "component", "bits"]]

    return run


def _links(least: float, percent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        bits, sets = _bits_of(frame), [np.asarray(x, np.int64) for x in frame["shingles"]]
        component = frame["component"].to_numpy()
        joined: dict[int, int] = {}  # components that links have joined, by one of them

        def top(x: int) -> int:
            while x in joined:
                x = joined[x]
            return x

        links = []
        for i, others in _apart(frame):
            equal = _equal(bits, i, others)
            order = np.argsort(-equal, kind="stable")
            for j in others[order[equal[order] >= least]]:
                if top(component[i]) != top(component[j]) and _similar(sets[i], sets[j], percent):
                    links.append((component[i], component[j]))
                    joined[top(component[i])] = top(component[j])
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def near_duplicates(
    documents: DataFrame,
    work: Workspace,
    size: int = 5,
    percent: int = 80,
    separators: bytes = BLANKS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id per row of ``documents`` (doc_id, text).

    Texts are linked when 100 x shared >= ``percent`` x all of their distinct shingles
    of ``size`` words. component_id is the smallest doc_id reachable over links, the own
    one included; kept says that the row's id is that one. class_id is the smallest
    doc_id with the same shingle set.

    Null or empty texts, or texts without words, have 0 shingles and link with nothing.
    Texts of fewer than ``size`` words are one shingle. Rows without a doc_id link with
    nothing, have a null component and stay kept. Rows that repeat a doc_id each go by
    their own text. Any text length works; a task holds one Arrow batch of texts. No
    rows give no rows. Other columns of ``documents`` aren't read.

    A pair at the threshold shares a band key with probability 1 - (1 - 0.8^4)^32,
    which falls short of one by 5e-8, and passes the estimate but for 3e-7.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = work.write(
        documents.mapInArrow(
            _sketches(size, separators),
            "doc_id long, n_shingles long, print_1 long, print_2 long, bits array<long>, bands array<long>",
        ),
        "sketches",
    )
    linked = sketches.where("doc_id is not null and n_shingles > 0")
    prints = ["print_1", "print_2"]
    first = F.struct("bits", "bands")
    classes = linked.groupBy(*prints).agg(F.min("doc_id").alias("rep"), F.min_by(first, "doc_id").alias("first"))
    classes = work.write(classes.select(*prints, "rep", "first.*"), "classes")
    members = classes.select("rep", F.explode("bands").alias("key"))
    hubs = members.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1")
    shared = work.write(members.join(hubs, "key"), "shared")

    pairs = shared.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    bits = classes.select("rep", "bits")
    near = (
        pairs.join(bits.toDF("b", "bits_b").hint("merge"), "b")
        .join(bits.toDF("a", "bits_a").hint("merge"), "a")
        .withColumn("equal", agreement("bits_a", "bits_b"))
        .where(F.col("equal") >= least_agreement(percent / 100))
        .select("a", "b", "equal")
    )
    near = work.write(near, "near")
    ids = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
    sets = work.write(
        documents.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(
            _sets(size, separators), "doc_id long, shingles array<long>"
        ),
        "sets",
    )
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    star = (
        near.join(sets.toDF("b", "shingles_b").hint("merge"), "b")
        .join(sets.toDF("a", "shingles_a").hint("merge"), "a")
        .select("a", "b", common.alias("common"), (F.size("shingles_a") + F.size("shingles_b")).alias("sizes"))
        .where(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("sizes") - F.col("common")))
        .select("a", "b")
        .distinct()
    )
    star = work.write(star, "star")
    work.remove("sets")
    joined = components(star, work, "first")
    links = _remaining_links(documents, classes, shared, joined, work, size, percent, separators)
    if links is not None:
        # Links between components, as links between their smallest members.
        further = components(links, work, "further").toDF("component", "smaller")
        joined = (
            joined.unionByName(further.select(F.col("component").alias("id"), "component"))
            .join(further, "component", "left")
            .select("id", F.coalesce("smaller", "component").alias("component"))
        )

    of_class = classes.join(joined.toDF("rep", "component"), "rep", "left").select(
        *prints, "rep", F.coalesce("component", "rep").alias("component")
    )
    own = (
        sketches.join(of_class, prints, "left")
        .withColumn("component", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component")))
    )
    component = F.coalesce("component", "doc_id")
    return own.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        F.when(F.col("n_shingles") > 0, F.coalesce(F.col("rep"), F.col("doc_id"))).otherwise(F.col("doc_id")).alias("class_id"),
    )


def _remaining_links(
    documents: DataFrame,
    classes: DataFrame,
    shared: DataFrame,
    joined: DataFrame,
    work: Workspace,
    size: int,
    percent: int,
    separators: bytes,
) -> DataFrame | None:
    """Links (a, b) between components that the comparison with the smallest member can't show; None
    if no key has members of several components that haven't been compared."""
    least = least_agreement(percent / 100)
    # Two members of a key have been compared already.
    members = shared.where("n > 2").join(joined.toDF("rep", "component"), "rep", "left")
    members = members.withColumn("component", F.coalesce("component", "rep"))
    # The smallest member has been compared with all others of its key.
    others = members.where("rep <> hub").select("key", "rep", "component")
    sizes = others.groupBy("key", "component").agg(F.count("*").alias("n"))
    split = (
        sizes.groupBy("key")
        .agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.max("n").alias("most"), F.sum("n").alias("n"))
        .where("most < n")
    )
    blocks = lambda n: F.ceil(n / BLOCK)
    split = split.select("key", "largest", blocks(F.col("n")).alias("held_blocks"), blocks(F.col("n") - F.col("most")).alias("asking_blocks"))
    split = work.write(split, "split")
    if split.isEmpty():
        return None
    # Everyone outside a key's largest component asks all members of the key.
    members = others.join(split, "key")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    of_rep = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    columns = ["key", "asking", "held", "asks", "rep", "component"]
    asking = members.where("component <> largest").withColumns(
        {"asking": of_rep("asking_blocks"), "held": every("held_blocks"), "asks": F.lit(True)}
    )
    held = members.withColumns({"asking": every("asking_blocks"), "held": of_rep("held_blocks"), "asks": F.lit(False)})
    placed = asking.select(columns).unionByName(held.select(columns))
    schema = "key long, asking long, held long, asks boolean, rep long, component long, bits array<long>"
    plausible = (
        placed.join(classes.select("rep", "bits").hint("merge"), "rep")
        .groupBy("key", "asking", "held")
        .applyInPandas(_plausible(least), schema)
    )
    plausible = work.write(plausible, "plausible")
    ids = plausible.select(F.col("rep").alias("doc_id")).distinct()
    sets = documents.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(
        _sets(size, separators), "doc_id long, shingles array<long>"
    )
    return (
        plausible.join(sets.toDF("rep", "shingles").hint("merge"), "rep")
        .groupBy("key", "asking", "held")
        .applyInPandas(_links(least, percent), "a long, b long")
        .distinct()
    )


def without_near_duplicates(documents: DataFrame, work: Workspace, **options) -> DataFrame:
    """The rows of ``documents``, all columns as they are, one of each group of near duplicates.

    Rows that repeat both doc_id and text leave one; rows without a doc_id all stay.
    """
    found = work.write(near_duplicates(documents, work, **options).select("doc_id", "kept"), "kept")
    gone = found.where("not kept").select("doc_id").distinct().join(found.where("kept").select("doc_id"), "doc_id", "left_anti")
    gone = gone.withColumnRenamed("doc_id", "gone_id")
    left = documents.join(gone.hint("merge"), documents["doc_id"].cast("long") == gone["gone_id"], "left_anti")
    # Only rows that share an id can repeat; the others pass by the window.
    copies = found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1")
    copies = copies.select(F.col("doc_id").alias("copied_id"))
    own = left["doc_id"].cast("long") == copies["copied_id"]
    once = left.join(copies, own, "left_anti")
    number = "number"
    while number in documents.columns:
        number += "_"
    repeated = left.join(copies, own, "left_semi")
    of_text = Window.partitionBy("doc_id", F.xxhash64("text"), "text").orderBy(F.lit(0))
    repeated = repeated.withColumn(number, F.row_number().over(of_text)).where(F.col(number) == 1).drop(number)
    return once.unionByName(repeated)
