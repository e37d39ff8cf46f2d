"""Purchase facts per email address."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import blank_to_null
from rollcall.operators.keys import hash_led, unused

# Output name -> transaction column, for the details of the latest purchase.
LATEST_DETAILS = {
    "txn_normalized_phone": "normalized_phone",
    "txn_phone_raw": "phone",
    "txn_email": "customer_email",
    "latest_transaction_id": "transaction_id",
    "txn_first_name": "first_name",
    "txn_last_name": "last_name",
    "txn_address": "shipping_address",
    "txn_city": "city",
    "txn_country": "country",
}

# Sample ids of input tasks meet in this many lanes per group.
SAMPLE_LANES = 256


def _latest() -> Column:
    """Details of the newest purchase; the greatest id breaks ties."""
    details = F.struct(*[F.col(c).alias(name) for name, c in LATEST_DETAILS.items()])
    return F.max_by(details, F.struct("purchase_date", "transaction_id"))


def latest_transaction(trx: DataFrame) -> DataFrame:
    """Details of the latest transaction per email; NULL emails form one group."""
    keyed, keys = hash_led(trx, ["normalized_email"])
    latest = keyed.groupBy(*keys).agg(_latest().alias("_latest"))
    return latest.select("normalized_email", "_latest.*")


def sample_ids(trx: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """The ``size`` lowest transaction ids per group, as a sorted array.

    A plain ``collect_list`` would gather a whole group, however large, in one
    task before cutting it. Here the ids of a group meet first per input task, then
    per lane (a share of the input tasks), then per group, and are cut to ``size``
    each time. No task ever holds more than the ids of one input task, or ``size``
    ids per input task of a lane, or per lane. All ids are compared: the result is
    exact, and the plan is the same for every size.
    """
    task, lane = unused(trx, "_task"), unused(trx, "_lane")

    def lowest(ids: Column) -> Column:
        return F.slice(F.sort_array(ids), 1, size).alias("sample_transaction_ids")

    merged = F.flatten(F.collect_list("sample_transaction_ids"))
    return (
        trx.select(*keys, "transaction_id", F.spark_partition_id().alias(task))
        # NULL ids are skipped by collect_list.
        .groupBy(*keys, task)
        .agg(lowest(F.collect_list("transaction_id")))
        .groupBy(*keys, (F.col(task) % SAMPLE_LANES).alias(lane))
        .agg(lowest(merged))
        .groupBy(*keys)
        .agg(lowest(merged))
    )


def keyed_facts(trx: DataFrame, keys: Sequence[str], sample_size: int) -> DataFrame:
    """First and last purchase, count, sample ids and latest details per group.

    Both halves are partitioned by ``keys``, which must not be NULL, so joining
    them moves nothing.
    """
    facts = trx.groupBy(*keys).agg(
        F.min("purchase_date").alias("first_purchase_date"),
        F.max("purchase_date").alias("last_purchase_date"),
        F.count(F.lit(1)).alias("total_transactions"),
        _latest().alias("_latest"),
    )
    none = F.array().cast("array<string>")
    return facts.join(sample_ids(trx, keys, sample_size), list(keys), "left").select(
        *keys,
        "first_purchase_date",
        "last_purchase_date",
        "total_transactions",
        F.coalesce("sample_transaction_ids", none).alias("sample_transaction_ids"),
        "_latest.*",
    )


def email_facts(
    trx: DataFrame, sample_size: int = 100, match_blank: bool = False
) -> DataFrame:
    """Purchase facts per email, without the group that has none.

    Blank emails have none either, unless ``match_blank`` is set.
    """
    email = F.col("normalized_email")
    known = trx.filter((email if match_blank else blank_to_null(email)).isNotNull())
    keyed, keys = hash_led(known, ["normalized_email"])
    return keyed_facts(keyed, keys, sample_size).drop(keys[0])


def merged_facts(parts: DataFrame, sample_size: int = 100, keys: Sequence[str] = ()) -> DataFrame:
    """One row per email from several rows of :func:`email_facts`, over transactions that
    have none in common. A row of an email is a part of its purchases. Parts that lie by
    ``keys`` already, a hash and the email, merge where they are."""
    details = F.struct(*LATEST_DETAILS)
    # The latest purchase is the one with the last date and the greatest id among those.
    latest = F.max_by(details, F.struct("last_purchase_date", "latest_transaction_id"))
    samples = F.flatten(F.collect_list("sample_transaction_ids"))
    keyed, keys = (parts, keys) if keys else hash_led(parts, ["normalized_email"])
    return (
        keyed.groupBy(*keys)
        .agg(
            F.min("first_purchase_date").alias("first_purchase_date"),
            F.max("last_purchase_date").alias("last_purchase_date"),
            F.sum("total_transactions").alias("total_transactions"),
            F.slice(F.sort_array(samples), 1, sample_size).alias("sample_transaction_ids"),
            latest.alias("_latest"),
        )
        .select("normalized_email", "first_purchase_date", "last_purchase_date", "total_transactions",
                "sample_transaction_ids", "_latest.*")
    )


def aggregate_transactions(trx: DataFrame, sample_size: int = 100) -> DataFrame:
    """Purchase facts per email; transactions without one form a group, too."""
    # Two columns that are never NULL stand in for the email.
    text, missing = unused(trx, "_email"), unused(trx, "_missing")
    marked = trx.withColumns(
        {
            text: F.coalesce("normalized_email", F.lit("")),
            missing: F.col("normalized_email").isNull(),
        }
    )
    keyed, keys = hash_led(marked, [text, missing])
    email = F.when(~F.col(missing), F.col(text)).alias("normalized_email")
    return keyed_facts(keyed, keys, sample_size).select(email, "*").drop(*keys)
