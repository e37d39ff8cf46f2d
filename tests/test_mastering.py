from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall import operators as op
from rollcall.schemas import ANALYTICS_COLUMNS, MASTER_COLUMNS, SAMPLE_COLUMNS

AS_OF = dt.date(2024, 6, 30)


@pytest.fixture
def master(crm_raw, trx_raw):
    crm, trx = op.clean_crm(crm_raw), op.clean_transactions(trx_raw)
    at = dt.datetime(2024, 7, 1)
    return op.build_master(crm, trx, op.reconcile(crm, trx), as_of=AS_OF, at=at)


@pytest.fixture
def rows(master):
    return {r.crm_id: r for r in master.collect()}


def test_layout(master):
    assert master.columns == list(MASTER_COLUMNS)
    types = dict(master.dtypes)
    assert types["total_transactions"] == "bigint"
    assert types["sample_transaction_ids"] == "array<string>"
    assert types["data_quality_score"] == types["customer_tenure_days"] == "int"
    assert types["customer_tenure_months"] == types["confidence"] == "double"
    assert types["is_active"] == "boolean"


def test_one_row_per_customer(rows):
    assert sorted(rows) == ["C1", "C2", "C3", "C4", "C5"]
    assert rows["C1"].gold_customer_id == "GOLD_C1"
    assert rows["C1"].source == "GOLDEN_RECORD"
    assert rows["C1"].ingestion_timestamp == dt.datetime(2024, 7, 1)


def test_sources_have_priorities(rows):
    ann = rows["C1"]
    # identity from the registry, address from the latest purchase, field by field
    assert (ann.first_name, ann.email) == ("Ann", "ann.lee@mail.com")
    assert (ann.address, ann.city, ann.country) == ("1 High St", "Leeds", "UK")
    assert (ann.phone, ann.raw_crm_phone, ann.txn_phone_raw) == (
        "+447911000001", "+447911000001", None,
    )
    assert (ann.txn_id, ann.latest_transaction_id) == ("T1", "T2")
    assert (ann.total_transactions, ann.sample_transaction_ids) == (2, ["T1", "T2"])


def test_facts_follow_the_email_not_the_match(rows):
    by_phone, by_name = rows["C3"], rows["C4"]
    assert (by_phone.match_type, by_phone.txn_id, by_phone.match_quality) == ("phone", "T3", "high")
    assert (by_name.match_type, by_name.txn_id, by_name.match_quality) == ("name_address", "T4", "medium")
    for row in (by_phone, by_name):
        assert row.total_transactions == 0
        assert row.latest_transaction_id is None
        assert not row.is_active
    assert by_phone.city == "Leeds"


def test_unmatched(rows):
    eve = rows["C5"]
    assert (eve.match_type, eve.confidence, eve.match_quality) == (None, 0.0, "low")
    assert (eve.customer_tenure_days, eve.customer_tenure_months) == (None, None)
    assert eve.data_quality_score == 25 + 10


def test_derived(rows):
    ann, dee = rows["C1"], rows["C4"]
    assert ann.customer_tenure_days == (AS_OF - dt.date(2020, 1, 31)).days
    assert ann.customer_tenure_months == 53.0
    assert ann.is_active
    assert ann.data_quality_score == 100
    assert dee.customer_tenure_days < 0


def test_shared_email(crm_raw, trx_raw):
    crm = op.clean_crm(crm_raw).withColumn("normalized_email", F.lit("ann.lee@mail.com"))
    trx = op.clean_transactions(trx_raw)
    rows = op.build_master(crm, trx, op.reconcile(crm, trx), as_of=AS_OF).collect()
    assert [r.total_transactions for r in rows] == [2] * 5


def test_customers_without_email_never_get_facts(crm_raw, trx_raw):
    crm = op.clean_crm(crm_raw).withColumn("normalized_email", F.lit(None).cast("string"))
    # An address that looks just like the key those customers are spread by.
    trx = op.clean_transactions(trx_raw).withColumn("normalized_email", F.lit("no email C1"))
    rows = op.build_master(crm, trx, op.reconcile(crm, trx), as_of=AS_OF).collect()
    assert [r.total_transactions for r in rows] == [0] * 5


def test_facts_without_a_match(crm_raw, trx_raw):
    crm, trx = op.clean_crm(crm_raw), op.clean_transactions(trx_raw)
    mapping = op.reconcile(crm, trx, threshold=1.5)
    rows = {r.crm_id: r for r in op.build_master(crm, trx, mapping, as_of=AS_OF).collect()}
    assert (rows["C1"].match_type, rows["C1"].total_transactions) == (None, 2)


def test_views(master):
    assert op.analytics_view(master).columns == list(ANALYTICS_COLUMNS)
    sample = op.master_sample(master, 2)
    assert sample.columns == list(SAMPLE_COLUMNS)
    assert [r.gold_customer_id for r in sample.collect()] == ["GOLD_C1", "GOLD_C2"]
