"""One mastered row per customer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import (
    blank_to_null,
    data_quality_score,
    is_active,
    match_quality,
    tenure_days,
    tenure_months,
)
from rollcall.functions.derived import AsOf
from rollcall.operators.cleaning import with_lineage
from rollcall.operators.keys import ID_KEY, hash_led, id_key
from rollcall.operators.purchases import email_facts
from rollcall.rules import FieldRule, Settings
from rollcall.schemas import (
    ANALYTICS_COLUMNS,
    MAPPING_COLUMNS,
    MASTER_COLUMNS,
    SAMPLE_COLUMNS,
)


def attach_facts(customers: DataFrame, facts: DataFrame, match_blank: bool = False) -> DataFrame:
    """Left join purchase facts (as ``trx``) to ``crm``-aliased customers by email.

    Customers without an email match nothing, but a plain outer join would send
    all of them to one task. They get a join key of their own instead, which
    spreads them; the last part of the condition keeps that key from matching.
    Blank emails count as missing, as they do in the email rule, unless
    ``match_blank`` is set.

    An email may be shared by very many customers. Spark splits such a partition
    when both sides were shuffled for this join alone, so the facts are hashed anew
    instead of being joined on the partitioning of their aggregation.
    """
    email = F.col("crm.normalized_email")
    email = email if match_blank else blank_to_null(email)
    key = F.coalesce(email, F.concat(F.lit("no email "), F.coalesce("crm.customer_id", F.lit(""))))
    facts, keys = hash_led(facts, ["normalized_email"])
    condition = (
        (F.xxhash64(key) == F.col(f"trx.{keys[0]}"))
        & (key == F.col("trx.normalized_email"))
        & email.isNotNull()
    )
    return customers.join(facts.alias("trx"), condition, "left")


def survive(rules: Sequence[FieldRule]) -> dict[str, Column]:
    """Per field, the first source that has a value."""
    return {rule.field: F.coalesce(*rule.sources) for rule in rules}


def survivorship(
    crm: DataFrame,
    trx: DataFrame,
    mapping: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """The merged record before derived fields.

    A customer without an id keeps its fields, too. A mapping that ``reconcile``
    has ``keyed`` is joined where its rows are.
    """
    facts = email_facts(trx, settings.sample_size, matches_blank_emails(settings))
    return merge_facts(crm, facts, mapping, settings)


def matches_blank_emails(settings: Settings) -> bool:
    by_email = [rule for rule in settings.match_rules if rule.keys == ("normalized_email",)]
    return any(rule.match_blank for rule in by_email)


def merge_facts(
    crm: DataFrame, facts: DataFrame, mapping: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """:func:`survivorship` with the purchase facts per email (``email_facts``)."""
    if not set(ID_KEY) <= set(mapping.columns):
        mapping = mapping.select(*MAPPING_COLUMNS, *id_key("crm_customer_id"))
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"map.{name}") == own for name, own in zip(ID_KEY, id_key("crm.customer_id"), strict=True)],
    )
    customers = mapping.alias("map").join(crm.alias("crm"), same, "left")
    fields = {
        "gold_customer_id": F.col("map.gold_customer_id"),
        **survive(settings.field_rules),
        "total_transactions": F.coalesce("trx.total_transactions", F.lit(0)),
        "match_type": F.col("map.match_type"),
        "confidence": F.col("map.confidence_score"),
        "match_quality": match_quality(F.col("map.confidence_score")),
        "crm_id": F.col("map.crm_customer_id"),
        "txn_id": F.col("map.transaction_id"),
    }
    wanted = [c for c in MASTER_COLUMNS if c in fields]
    wanted += [c for c in fields if c not in MASTER_COLUMNS]
    merged = attach_facts(customers, facts, matches_blank_emails(settings))
    return merged.select(*[fields[name].alias(name) for name in wanted])


def derive(
    merged: DataFrame, settings: Settings = Settings(), as_of: AsOf = None
) -> DataFrame:
    """Add tenure, activity and the data quality score."""
    return merged.withColumns(
        {
            "customer_tenure_days": tenure_days(F.col("registration_date"), as_of),
            "customer_tenure_months": tenure_months(F.col("registration_date"), as_of),
            "is_active": is_active(
                F.col("last_purchase_date"), as_of, settings.active_days
            ),
            "data_quality_score": data_quality_score(settings.score_rules),
        }
    )


def build_master(
    crm: DataFrame,
    trx: DataFrame,
    mapping: DataFrame,
    settings: Settings = Settings(),
    as_of: AsOf = None,
    at: dt.datetime | Column | None = None,
) -> DataFrame:
    """The full mastered record: merged, derived fields added, with lineage."""
    merged = survivorship(crm, trx, mapping, settings)
    return with_lineage(derive(merged, settings, as_of), "GOLDEN_RECORD", at)


def analytics_view(master: DataFrame) -> DataFrame:
    """The analyst-facing subset of the mastered record."""
    return master.select(*ANALYTICS_COLUMNS)


def master_sample(master: DataFrame, size: int = 10) -> DataFrame:
    """A first look: the lowest ids and their main columns."""
    return master.select(*SAMPLE_COLUMNS).orderBy("gold_customer_id").limit(size)
