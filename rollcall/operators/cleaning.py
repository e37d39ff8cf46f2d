"""From raw feed rows to clean, unique, traceable rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import email, parse_date, phone
from rollcall.operators.keys import unused
from rollcall.rules import Settings
from rollcall.schemas import CRM_RAW, TRANSACTION_RAW


def tidy_crm(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Trim, normalise and type the customer feed, row by row."""
    dates = ("registration_date", "last_updated")
    return _normalised(raw, "email", dates, settings).select(
        F.trim("customer_id").alias("customer_id"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        "email",
        "phone",
        F.trim("address").alias("address"),
        F.trim("city").alias("city"),
        "country",
        *dates,
        "normalized_email",
        "normalized_phone",
    )


def tidy_transactions(raw: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Trim, normalise and type the purchase feed, row by row."""
    dates = ("purchase_date",)
    return _normalised(raw, "customer_email", dates, settings).select(
        F.trim("transaction_id").alias("transaction_id"),
        "customer_email",
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        "phone",
        F.trim("shipping_address").alias("shipping_address"),
        F.trim("city").alias("city"),
        "country",
        *dates,
        "normalized_email",
        "normalized_phone",
    )


def _normalised(raw: DataFrame, address: str, dates: Sequence[str], settings: Settings) -> DataFrame:
    """With the country trimmed, dates parsed, email and phone normalised."""
    raw = raw.withColumn("country", F.trim("country"))
    return raw.withColumns(
        {
            **{name: parse_date(F.col(name), settings.date_formats) for name in dates},
            "normalized_email": email(F.col(address)),
            "normalized_phone": phone(F.col("phone"), F.col("country"), settings.phone_regions),
        }
    )


def latest_per_key(
    df: DataFrame, key: str, newest: str, ties: Sequence[str] | None = None
) -> DataFrame:
    """One row per ``key``: the one with the greatest ``newest``, NULLs last.

    Equal rows are told apart by ``ties`` ascending (all other columns by
    default), so the choice never depends on how the data is partitioned. Rows
    without a key form one group. Spark limits every group to one row per input
    task before it shuffles, so a key that holds a large share of all rows costs
    no more than any other. A hash leads the key, as in :func:`hash_led`.
    """
    if ties is None:
        ties = [name for name in df.columns if name not in (key, newest)]
    order = Window.partitionBy(F.xxhash64(key), key).orderBy(
        F.col(newest).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]
    )
    rank = unused(df, "_rank")
    return (
        df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(rank)
    )


def ingestion_time(at: dt.datetime | Column | None = None) -> Column:
    """The given time, or the time the query starts."""
    if at is None:
        return F.current_timestamp()
    return at if isinstance(at, Column) else F.lit(at).cast("timestamp")


def with_lineage(
    df: DataFrame, source: str, at: dt.datetime | Column | None = None
) -> DataFrame:
    """Add the source name and the ingestion time."""
    return df.withColumns(
        {"source": F.lit(source), "ingestion_timestamp": ingestion_time(at)}
    )


def clean_crm(
    raw: DataFrame,
    settings: Settings = Settings(),
    at: dt.datetime | Column | None = None,
) -> DataFrame:
    """The customer feed: tidied, one row per customer, with lineage."""
    ties = [c for c in CRM_RAW.names if c not in ("customer_id", "last_updated")]
    latest = latest_per_key(tidy_crm(raw, settings), "customer_id", "last_updated", ties)
    return with_lineage(latest, "CRM", at)


def clean_transactions(
    raw: DataFrame,
    settings: Settings = Settings(),
    at: dt.datetime | Column | None = None,
) -> DataFrame:
    """The purchase feed: tidied, one row per transaction, with lineage."""
    # Normalised columns follow from the others, so they decide nothing.
    ties = [c for c in TRANSACTION_RAW.names if c not in ("transaction_id", "purchase_date")]
    latest = latest_per_key(
        tidy_transactions(raw, settings), "transaction_id", "purchase_date", ties
    )
    return with_lineage(latest, "TRX", at)
