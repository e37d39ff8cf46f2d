"""Keys that sort fast and helper columns that clash with none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores, such that ``df`` has no such column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hash_led(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with a hash of ``keys`` and the key list it now leads.

    Aggregates over text and large joins sort by their keys, and Spark's sort
    first compares the leading eight bytes. Phone numbers, names and ids mostly
    share those, which leaves a full comparison for every step; a leading hash
    settles nearly all of them. The keys themselves stay part of the list, so two
    keys with one hash are still told apart.
    """
    name = unused(df, "_hash")
    return df.withColumn(name, F.xxhash64(*keys)), [name, *keys]


#: Columns of :func:`id_key`; none of them is ever NULL.
ID_KEY = ("_id_hash", "_id_text", "_id_missing")


def id_key(value: str) -> list[Column]:
    """An id as columns that are equal for equal ids, a missing id included."""
    text = F.coalesce(value, F.lit(""))
    parts = (F.xxhash64(text), text, F.col(value).isNull())
    return [part.alias(name) for part, name in zip(parts, ID_KEY, strict=True)]
