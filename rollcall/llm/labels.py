"""Labelled rows for training, and the split that keeps some for testing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


#: Hashes that the sample's share is taken of: enough for a bound of one row in 10^15.
HASHES = 1 << 52


def in_share(value: Column, bound: int, rows: int, hashes: int = HASHES) -> Column:
    """Whether a row belongs to a sample of about ``bound`` of so many ``rows``, by a hash."""
    return F.pmod(F.xxhash64(value), F.lit(hashes)) < max(1, int(min(1.0, bound / max(1, rows)) * hashes))


def training_labels(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, label) of at most about ``bound`` labelled ids outside the test split.

    A doc_id's label is the one that most of its rows have; null labels and ids, labels
    other than 0 and 1 and even splits give none. A hash of the id picks the sample.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.avg("label").alias("mean")).where("mean <> 0.5")
    rows = rows.select("doc_id", (F.col("mean") > 0.5).cast("int").alias("label"))
    return rows.where(in_share(F.col("doc_id"), bound, rows.count()))


def sampled(rows: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` of the rows, by a hash of doc_id, in a fixed order."""
    rest = [c for c, kind in rows.dtypes if c != "doc_id" and not kind.startswith(("array", "struct"))]
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", *rest).limit(bound)
