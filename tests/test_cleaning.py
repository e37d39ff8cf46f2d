from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollcall.operators import (
    clean_crm,
    clean_transactions,
    latest_per_key,
    tidy_crm,
    tidy_transactions,
    with_lineage,
)
from rollcall.schemas import CRM_RAW


def test_crm_is_tidied(crm_raw):
    rows = {(r.customer_id, r.last_updated): r for r in tidy_crm(crm_raw).collect()}
    ann = rows["C1", dt.date(2024, 3, 1)]
    assert (ann.normalized_email, ann.email) == ("ann.lee@mail.com", " Ann.Lee@Mail.com")
    bea = rows["C2", dt.date(2024, 1, 2)]
    assert bea.registration_date == dt.date(2021, 6, 15)
    assert bea.normalized_phone == "+33612000002"
    assert rows["C3", dt.date(2024, 1, 1)].registration_date is None


def test_transactions_are_tidied(trx_raw):
    rows = {r.transaction_id: r for r in tidy_transactions(trx_raw).collect()}
    assert rows["T1"].normalized_phone == "+447911000001"
    assert rows["T2"].normalized_email == "ann.lee@mail.com"
    assert rows["T2"].purchase_date == dt.date(2024, 5, 20)
    assert rows["T5"].purchase_date is None
    assert rows["T6"].normalized_email is None


def test_text_is_trimmed_of_spaces_only(spark):
    row = (" C1 ", " A ", "\tB", "e", "1", "  ", " C ", " UK ", None, None)
    got = tidy_crm(spark.createDataFrame([row], CRM_RAW)).first()
    assert (got.customer_id, got.first_name, got.last_name) == ("C1", "A", "\tB")
    assert (got.address, got.city, got.country) == ("", "C", "UK")
    assert got.normalized_phone == "+441"


def test_newest_row_wins(crm_raw):
    rows = clean_crm(crm_raw).collect()
    assert sorted(r.customer_id for r in rows) == ["C1", "C2", "C3", "C4", "C5"]
    assert next(r for r in rows if r.customer_id == "C1").address == "1 High St"


def test_ties_and_nulls_do_not_depend_on_partitioning(spark):
    rows = [
        ("a", dt.date(2024, 1, 1), "x"),
        ("a", dt.date(2024, 1, 1), "b"),
        ("a", None, "a"),
        ("n", None, "z"),
        ("n", None, None),
        (None, dt.date(2020, 1, 1), "old"),
        (None, dt.date(2021, 1, 1), "new"),
    ]
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "k string, d date, v string").repartition(parts)
        got = {r.k: r.v for r in latest_per_key(df, "k", "d").collect()}
        assert got == {"a": "b", "n": "z", None: "new"}


def test_one_row_per_key(spark):
    df = spark.range(5000).select(
        (F.col("id") % 37).cast("string").alias("k"),
        F.col("id").alias("d"),
        F.lit("v").alias("v"),
    )
    got = latest_per_key(df, "k", "d").collect()
    assert len(got) == 37
    assert all(r.d == max(i for i in range(5000) if str(i % 37) == r.k) for r in got)


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("d"),
    )
    latest = latest_per_key(df, "k", "d")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.filter("k = 'hot'").first().d == 2997


def test_lineage(spark, crm_raw, trx_raw):
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    got = with_lineage(spark.range(1), "CRM", at).first()
    assert (got.source, got.ingestion_timestamp) == ("CRM", at)
    crm, trx = clean_crm(crm_raw), clean_transactions(trx_raw)
    assert {r.source for r in crm.collect()} == {"CRM"}
    assert {r.source for r in trx.collect()} == {"TRX"}
    assert (len(crm.columns), len(trx.columns)) == (14, 13)
    assert crm.filter(F.col("ingestion_timestamp").isNull()).count() == 0


def test_columns_named_like_helpers_stay(spark):
    rows = [("a", 1, "x", "p"), ("a", 2, "y", "q"), (None, 3, "z", "r")]
    df = spark.createDataFrame(rows, "k string, d int, _rank string, _hash string")
    latest = latest_per_key(df, "k", "d")
    assert latest.columns == df.columns
    assert sorted(map(tuple, latest.collect()), key=str) == sorted([rows[1], rows[2]], key=str)
