"""Column layouts of the two feeds and of the tables built from them."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in names])


# Columns of the customer feed. Feeds arrive untyped; CSV columns bind
# by position, so the order matters.
CRM_RAW = _strings(
    "customer_id",
    "first_name",
    "last_name",
    "email",
    "phone",
    "address",
    "city",
    "country",
    "registration_date",
    "last_updated",
)

# Columns of the purchase feed, in order.
TRANSACTION_RAW = _strings(
    "transaction_id",
    "customer_email",
    "first_name",
    "last_name",
    "phone",
    "shipping_address",
    "city",
    "country",
    "purchase_date",
)

# Columns of a match pair.
PAIR_COLUMNS = (
    "crm_customer_id",
    "transaction_id",
    "match_key",
    "match_type",
    "confidence_score",
)

# Columns of the mapping.
MAPPING_COLUMNS = (
    "crm_customer_id",
    "transaction_id",
    "match_type",
    "confidence_score",
    "gold_customer_id",
)

# Columns of the mastered record, in order.
MASTER_COLUMNS = (
    "gold_customer_id",
    "first_name",
    "last_name",
    "email",
    "phone",
    "raw_crm_phone",
    "txn_phone_raw",
    "address",
    "city",
    "country",
    "registration_date",
    "last_updated",
    "first_purchase_date",
    "last_purchase_date",
    "total_transactions",
    "sample_transaction_ids",
    "match_type",
    "confidence",
    "match_quality",
    "crm_id",
    "txn_id",
    "latest_transaction_id",
    "customer_tenure_days",
    "customer_tenure_months",
    "is_active",
    "data_quality_score",
    "source",
    "ingestion_timestamp",
)

# Columns of the analyst layer, in order.
ANALYTICS_COLUMNS = (
    "gold_customer_id",
    "first_name",
    "last_name",
    "email",
    "phone",
    "address",
    "city",
    "country",
    "registration_date",
    "first_purchase_date",
    "last_purchase_date",
    "total_transactions",
    "customer_tenure_days",
    "customer_tenure_months",
    "is_active",
    "data_quality_score",
)

# Columns of the sample.
SAMPLE_COLUMNS = (
    "gold_customer_id",
    "first_name",
    "last_name",
    "email",
    "match_type",
    "confidence",
    "total_transactions",
)
