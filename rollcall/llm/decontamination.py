"""Benchmark decontamination by size-partitioned MinHash containment search.

An item and a document that holds it differ in size by orders of magnitude, so their
Jaccard similarity says nothing; containment of the item does. Items are partitioned by
the power of two that their shingle count lies under. Within a partition of up to u
shingles an item is sketched by its smallest min-wise hash values, as many as an item
of u shingles may miss, and one more: u - ceil(0.8 u) + 1. A document that
holds 80 % of the item misses at most that many less one, so it holds at least one value
of the sketch, whatever its length. Documents with fewer shingles than the least that
the partition asks for aren't candidates. Candidates are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.tables import Workspace
from rollcall.llm.words import NOT_ALPHANUMERIC, list_column, shingle_sets, slices

WORDS = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PERCENT = 80


def _with_shingles(size: int, short: bool, also: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            sets = list(shingle_sets(batch.column(2), size, NOT_ALPHANUMERIC, short, also))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), list_column(sets)], ["id", "text_key", "shingles"]
            )

    return run


def shingled(
    texts: DataFrame, id_column: str, size: int = WORDS, short: bool = False, also: tuple[int, ...] = ()
) -> DataFrame:
    """id, text_key, shingles: hashes of ``size`` consecutive words, distinct and sorted, and those
    that :func:`~rollcall.llm.words.shingle_sets` adds."""
    text = F.col("text").cast("string")
    return texts.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    ).mapInArrow(_with_shingles(size, short, also), "id long, text_key long, shingles array<long>")


def contaminated(
    documents: DataFrame, benchmark: DataFrame, work: Workspace, size: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Pairs of a document and an item of which it holds ``percent`` or more.

    Returns doc_id, text_key (a hash of the document's text), item_id, n_shared, n_item
    and containment = n_shared / n_item, one row per distinct pair. Both sides count
    distinct shingles of ``size`` words; words are runs of ASCII letters, ASCII digits
    and all non-ASCII characters, A-Z lower-cased.

    An item under ``size`` words is one shingle, its whole sequence of words, and looked up among
    the documents' runs of as many words. Documents are cut into runs of those lengths alone that
    items have. Null and empty texts and those without words hold nothing and are never found. A null doc_id or item_id is reported as
    null. Repeated rows give the pair once; an item that occurs twice under two ids
    is reported under both. No documents or no items give no rows.
    """
    n_words = F.size(F.regexp_extract_all(F.col("text").cast("string"), F.lit(WORD), F.lit(0))).alias("n")
    lengths = benchmark.select(n_words).where((F.col("n") > 0) & (F.col("n") < size)).distinct().collect()
    also = tuple(sorted(row.n for row in lengths))
    items = shingled(benchmark, "item_id", size, short=True).where(F.size("shingles") > 0)
    items = items.withColumn("n_item", F.size("shingles"))
    # The partition's upper end: the next power of two.
    items = items.withColumn("upper", F.pow(F.lit(2), F.ceil(F.log2("n_item"))).cast("int"))
    items = work.write(items, "items")
    asked = F.ceil(F.col("upper") * F.lit(percent) / F.lit(100)).cast("int")
    # min-wise order: the shingles' own order comes from a hash of their words
    sketch = F.slice(F.array_sort(F.transform("shingles", lambda x: F.xxhash64(x))), F.lit(1), F.col("upper") - asked + 1)
    of_lower = F.ceil((F.floor(F.col("upper") / 2) + 1) * F.lit(percent) / F.lit(100)).cast("int")
    sketches = items.select(
        "id", "text_key", F.explode(sketch).alias("value"), F.least(of_lower, F.col("n_item")).alias("at_least")
    ).toDF("item_id", "item_key", "value", "at_least")

    held = shingled(documents, "doc_id", size, also=also)
    looked_up = held.select(
        "id", "text_key", F.size("shingles").alias("n_doc"), F.explode("shingles").alias("shingle")
    ).withColumn("value", F.xxhash64("shingle"))
    candidates = (
        looked_up.join(sketches, "value")
        .where("n_doc >= at_least")
        .select(F.col("id").alias("doc_id"), F.col("text_key").alias("key"), "item_id", "item_key")
        .distinct()
    )
    candidates = work.write(candidates, "candidates")

    keys = candidates.select("key").distinct()
    texts = documents.withColumns({"text": F.col("text").cast("string"), "doc_id": F.col("doc_id").cast("long")}).select(
        "doc_id", "text"
    )
    some = texts.join(keys, F.xxhash64("text") == F.col("key"), "left_semi")
    full = shingled(some, "doc_id", size, also=also).toDF("doc_id", "key", "shingles")
    item_sets = items.select("id", "text_key", "n_item", F.col("shingles").alias("item_shingles"))
    pairs = candidates.join(
        full.withColumnsRenamed({"doc_id": "id_", "key": "key_"}),
        (F.col("key") == F.col("key_")) & F.col("doc_id").eqNullSafe(F.col("id_")),
    ).join(item_sets, (F.col("item_key") == F.col("text_key")) & F.col("item_id").eqNullSafe(F.col("id")))
    shared = F.size(F.array_intersect("shingles", "item_shingles"))
    return (
        pairs.select("doc_id", F.col("key").alias("text_key"), "item_id", shared.alias("n_shared"), "n_item")
        .where(F.lit(100) * F.col("n_shared") >= F.lit(percent) * F.col("n_item"))
        .distinct()
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, work: Workspace, **options) -> DataFrame:
    """The rows of ``documents``, all columns as they are, that hold no item."""
    found = contaminated(documents, benchmark, work, **options).select("doc_id", "text_key").distinct()
    found = work.write(found, "found").toDF("found_id", "found_key")
    same = F.xxhash64(documents["text"].cast("string")) == found["found_key"]
    return documents.join(found, same & documents["doc_id"].cast("long").eqNullSafe(found["found_id"]), "left_anti")
