"""Every query against its SQL counterpart, and against known counts."""

from __future__ import annotations

import pytest

from checks import compare, oracle, queries
from conftest import SMALL

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def con():
    with compare.connect(SMALL) as connection:
        yield connection


def test_every_query_has_its_sql():
    assert set(queries.QUERIES) == set(oracle.statements())
    assert set(queries.QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(oracle.statements()))
def test_spark_and_sql_agree(spark, con, name):
    assert compare.differences(spark, con, SMALL, name) is None


def test_entry(spark):
    rows = {r["match_type"]: r["count"] for r in contract.entry(spark).collect()}
    assert rows == {"email": 86, "phone": 28, "name_address": 15, None: 21}


def test_known_counts(spark):
    run = contract.queries()
    counts = {r.source: r.total_records for r in run["row_counts"](spark, SMALL).collect()}
    assert (counts["crm_raw"], counts["crm"], counts["trx"]) == (168, 150, 1500)
    validity = {r.field: r for r in run["quality_validity"](spark, SMALL).collect()}
    assert (validity["email"].non_null_count, validity["email"].valid_count) == (139, 127)
    assert (validity["phone"].non_null_count, validity["phone"].valid_count) == (133, 133)
    pairs = {n: run[n](spark, SMALL).count() for n in ("match_email", "match_phone", "match_name_address")}
    assert pairs == {"match_email": 755, "match_phone": 848, "match_name_address": 1282}
    master = run["master_record"](spark, SMALL)
    assert master.filter("total_transactions > 0").count() == 86


def test_key_counts_add_up_to_the_pairs(spark):
    run = contract.queries()
    counts = run["match_key_counts"](spark, SMALL).groupBy("match_type").sum("pairs").collect()
    assert {r[0]: r[1] for r in counts} == {
        kind: run[f"match_{kind}"](spark, SMALL).count() for kind in ("email", "phone", "name_address")
    }


def test_blank_emails_bring_no_purchases(spark):
    master = contract.queries()["master_record"](spark, SMALL)
    blank = master.filter("trim(email) = ''")
    assert blank.count() > 0
    assert blank.filter("total_transactions > 0 or latest_transaction_id is not null").count() == 0


def test_customers_without_an_id_are_mastered(spark):
    (row,) = contract.queries()["master_record"](spark, SMALL).filter("crm_id is null").collect()
    assert (row.email, row.match_type) == ("cust77@example.com", "email")
    assert row.total_transactions > 0
