from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall import operators as op
from rollcall.operators import purchases


@pytest.fixture
def trx(trx_raw):
    return op.clean_transactions(trx_raw)


def test_facts_per_email(trx):
    rows = {r.normalized_email: r for r in op.aggregate_transactions(trx).collect()}
    assert set(rows) == {"ann.lee@mail.com", "other@mail.com", "guest@mail.com", None}
    ann = rows["ann.lee@mail.com"]
    assert (ann.first_purchase_date, ann.last_purchase_date) == (
        dt.date(2024, 1, 10), dt.date(2024, 5, 20),
    )
    assert (ann.total_transactions, ann.sample_transaction_ids) == (2, ["T1", "T2"])
    assert (ann.latest_transaction_id, ann.txn_first_name, ann.txn_address) == ("T2", "Anna", None)
    assert ann.txn_email == "ANN.LEE@mail.com "
    assert rows["guest@mail.com"].last_purchase_date is None
    assert rows[None].sample_transaction_ids == ["T4", "T6"]
    assert rows[None].latest_transaction_id == "T4"


def test_columns(trx):
    assert op.aggregate_transactions(trx).columns == [
        "normalized_email", "first_purchase_date", "last_purchase_date",
        "total_transactions", "sample_transaction_ids", *purchases.LATEST_DETAILS,
    ]


def test_nothing(trx):
    assert op.aggregate_transactions(trx.filter("false")).count() == 0


def test_empty_email_is_not_a_missing_one(trx):
    blank = trx.withColumn("normalized_email", F.when(F.col("transaction_id") == "T4", ""))
    rows = {r.normalized_email: r.total_transactions for r in op.aggregate_transactions(blank).collect()}
    assert rows == {"": 1, None: 5}


def test_latest_ties(trx):
    same_day = trx.withColumns(
        {"normalized_email": F.lit("e"), "purchase_date": F.lit(dt.date(2024, 1, 1))}
    )
    assert op.latest_transaction(same_day).first().latest_transaction_id == "T6"
    undated = same_day.withColumn("purchase_date", F.lit(None).cast("date"))
    assert op.latest_transaction(undated).first().latest_transaction_id == "T6"


def many(spark, parts):
    """A third of all rows under one email, a third without any."""
    n = F.col("id")
    return spark.range(0, 9000, 1, parts).select(
        F.concat(F.lit("T"), F.lpad(((n * 7919) % 9000).cast("string"), 5, "0")).alias("transaction_id"),
        F.when(n % 3 == 0, "hot@mail.com")
        .when(n % 3 == 1, F.concat(F.lit("e"), (n % 100).cast("string")))
        .alias("normalized_email"),
    )


@pytest.mark.parametrize("parts", [1, 8, 40])
@pytest.mark.parametrize("size", [1, 100, 2000, 5000])
def test_sample_is_exact_whatever_the_partitioning(spark, parts, size, monkeypatch):
    monkeypatch.setattr(purchases, "SAMPLE_LANES", 5)
    df = many(spark, parts).withColumn("g", F.coalesce("normalized_email", F.lit("")))
    got = {r.g: r.sample_transaction_ids for r in purchases.sample_ids(df, ["g"], size).collect()}
    want = {}
    for r in df.collect():
        want.setdefault(r.g, []).append(r.transaction_id)
    assert got == {g: sorted(ids)[:size] for g, ids in want.items()}


def test_ids_that_are_missing_are_not_sampled(spark):
    df = spark.createDataFrame([("a", None), ("a", "T1"), ("b", None)], "g string, transaction_id string")
    got = {r.g: r.sample_transaction_ids for r in purchases.sample_ids(df, ["g"], 2).collect()}
    assert got == {"a": ["T1"], "b": []}


def test_helper_columns_clash_with_none(trx):
    names = ["_hash", "_task", "_lane", "_rank", "_email", "_missing", "_dialled", "_latest"]
    extra = trx.withColumns({name: F.lit("x") for name in names})
    plain = sorted(map(repr, op.aggregate_transactions(trx).collect()))
    assert sorted(map(repr, op.aggregate_transactions(extra).collect())) == plain
    assert sorted(map(repr, op.latest_transaction(extra).collect())) == sorted(map(repr, op.latest_transaction(trx).collect()))
