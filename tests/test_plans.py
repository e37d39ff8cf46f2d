"""The physical plans are the ones that hold at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import queries
from conftest import SMALL
from rollcall import operators as op
from rollcall.operators.purchases import sample_ids
from rollcall.sources import Scratch

WRITING = {n for n in queries.QUERIES if "sink" in n or "roundtrip" in n or "staged" in n}


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Session settings for one test."""
    changed = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - WRITING))
def test_no_python_and_no_cross_joins(spark, name):
    df = queries.registered()[name](spark, SMALL)
    plan = planned(df)
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoop", "Arrow"):
        assert bad not in plan
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def test_scans_read_only_what_they_need(spark):
    plan = planned(queries.registered()["master_record"](spark, SMALL))
    schemas = {line.split("ReadSchema:")[1].strip() for line in plan.splitlines() if "ReadSchema" in line}
    assert schemas == {
        "struct<c_custkey:bigint>",
        "struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>",
    }


def test_staged_frames_are_pruned(spark):
    crm = Scratch(spark).stage(op.clean_crm(queries.Feeds(spark, SMALL).crm_raw), "crm")
    plan = planned(op.completeness(crm, ["city"]))
    assert "ReadSchema: struct<city:string>" in plan


def test_groups_are_cut_before_they_are_shuffled(spark):
    feeds = queries.Feeds(spark, SMALL)
    assert planned(feeds.crm).count("WindowGroupLimit") == 2
    assert "partial_max_by" in planned(op.latest_transaction(feeds.trx))
    facts = planned(feeds.facts)
    assert "partial_collect_list(transaction_id" in facts
    assert "partial_min(transaction_id" in planned(feeds.mapping)
    assert "partial_count" in planned(op.uniqueness(feeds.crm_raw, ["city", "country"]))


def test_facts_join_without_moving_rows(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    plan = planned(queries.Feeds(spark, SMALL).facts)
    assert "SortMergeJoin" in plan
    # Deduplication (in both halves), facts, samples by task, lane and key; none for the join.
    assert plan.count("Exchange hashpartitioning") == 6


def test_samples_of_any_size_have_one_plan(spark):
    trx = queries.Feeds(spark, SMALL).trx

    def nodes(size):
        plan = planned(sample_ids(trx, ["normalized_email"], size))
        return [line.strip(" :+-").split("(")[0].split(" ")[0] for line in plan.splitlines()]

    assert nodes(100) == nodes(1000) == nodes(5000)
    plan = planned(sample_ids(trx, ["normalized_email"], 5000))
    # ids meet per input task, per lane, per key
    assert plan.count("partial_collect_list") == 3


def staged(spark):
    feeds, scratch = queries.Feeds(spark, SMALL), Scratch(spark)
    return scratch.stage(feeds.crm, "crm"), scratch.stage(feeds.trx, "trx")


def exchanges(df) -> int:
    return planned(df).count("Exchange hashpartitioning")


def test_all_pairs_take_one_join(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    crm, trx = staged(spark)
    for df in (op.all_matches(crm, trx), op.all_matches(crm, trx, threshold=0.7)):
        plan = planned(df)
        assert plan.count("FileScan") == 2
        assert plan.count("Exchange hashpartitioning") == 2
        assert plan.count("SortMergeJoin") == 1


def test_a_keyed_mapping_is_joined_where_it_is(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    crm, trx = staged(spark)
    keyed = op.build_master(crm, trx, op.reconcile(crm, trx, keyed=True))
    plain = op.build_master(crm, trx, op.reconcile(crm, trx))
    assert exchanges(keyed) == exchanges(plain) - 1


def test_weak_rules_are_left_out_of_the_plan(spark):
    feeds = queries.Feeds(spark, SMALL)
    assert "normalized_phone" not in planned(
        op.best_match(feeds.crm, feeds.trx, threshold=0.9).select("crm_customer_id")
    ).split("Window ")[0]


@pytest.mark.parametrize("what", ["reconcile", "master", "pairs"])
def test_partitions_of_shared_keys_are_split(spark, settings, what):
    """A third of all customers shares one email and one phone number."""
    settings(
        autoBroadcastJoinThreshold="-1",
        shuffle__partitions="16",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="4k",
    )
    n = F.col("id")
    shared = n % 3 == 0
    crm = spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("C"), n).alias("customer_id"),
        F.when(shared, "info@mail.com").otherwise(F.concat(F.lit("e"), n)).alias("normalized_email"),
        F.when(shared, "+hot").otherwise(F.concat(F.lit("+44"), n)).alias("normalized_phone"),
        *[F.lit(None).cast("string").alias(c) for c in ("first_name", "last_name", "phone",
                                                        "address", "city", "country")],
        F.lit(None).cast("date").alias("registration_date"),
        F.lit(None).cast("date").alias("last_updated"),
    )
    trx = crm.select(
        F.concat(F.lit("T"), F.substring("customer_id", 2, 9)).alias("transaction_id"),
        F.col("normalized_email").alias("customer_email"),
        F.col("address").alias("shipping_address"),
        F.col("last_updated").alias("purchase_date"),
        "normalized_email", "normalized_phone", "first_name", "last_name", "phone",
        "city", "country",
    )
    one_each = trx.filter("transaction_id in ('T0', 'T1')")
    df, rows = {
        "reconcile": lambda: (op.reconcile(crm, trx), 60000),
        "master": lambda: (op.build_master(crm, trx, op.reconcile(crm, trx)), 60000),
        "pairs": lambda: (op.match_pairs(crm, one_each, queries.PHONE_RULE), 20001),
    }[what]()
    kept = df.persist()
    try:
        assert kept.count() == rows
        assert "skew=true" in planned(kept)
        if what == "reconcile":
            hot = kept.filter("transaction_id = 'T0'")
            assert hot.count() == 20000
        if what == "master":
            assert kept.filter("total_transactions = 20000").count() == 20000
    finally:
        kept.unpersist()
