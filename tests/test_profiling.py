from __future__ import annotations

import datetime as dt

from rollcall import operators as op
from rollcall.rules import MASTER_PROFILE, ProfileSpec

SPEC = ProfileSpec()


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_completeness(spark):
    df = spark.createDataFrame(
        [("a", "x", ""), ("b", None, None)], "f string, l string, e string"
    )
    got = by(op.completeness(df, ["f", "l", "e", "nope"]), "column_name")
    assert got["f"]["completeness_percentage"] == 100.0
    assert (got["l"]["complete_count"], got["l"]["null_count"]) == (1, 1)
    assert got["e"]["completeness_percentage"] == 50.0  # empty text is complete
    assert got["nope"]["total_records"] == 2
    assert got["nope"]["complete_count"] is None
    assert got["nope"]["completeness_percentage"] is None


def test_completeness_of_nothing(spark):
    empty = spark.createDataFrame([], "f string")
    assert by(op.completeness(empty, ["f"]), "column_name")["f"] == {
        "column_name": "f", "complete_count": 0, "total_records": 0, "null_count": 0,
        "completeness_percentage": 0.0,
    }
    assert op.completeness(empty, []).count() == 0
    assert op.completeness(empty, []).columns[0] == "column_name"


def test_validity(spark):
    df = spark.createDataFrame(
        [("ok@mail.com", "+447911123456"), ("also.ok@sub.mail.co.uk", "+33612345678"),
         ("not-an-email", "0791"), (None, None), ("", "+0123456789012")],
        "normalized_email string, normalized_phone string",
    )
    got = by(op.validity(df, SPEC.formats), "field")
    email, phone = got["email"], got["phone"]
    assert (email["valid_count"], email["non_null_count"], email["invalid_count"]) == (2, 4, 2)
    assert phone["validity_percentage"] == 50.0
    assert op.validity(df.drop("normalized_email", "normalized_phone"), SPEC.formats).count() == 0


def test_uniqueness(spark):
    df = spark.createDataFrame(
        [("A", "x"), ("B", None), ("A", None), (None, None)], "id string, v string"
    )
    got = by(op.uniqueness(df, ["id", "v", "nope"]), "column_name")
    assert set(got) == {"id", "v"}
    assert got["id"] == {
        "column_name": "id", "total_records": 4, "distinct_records": 3,
        "duplicate_count": 1, "duplicate_groups_count": 1, "uniqueness_percentage": 75.0,
    }
    assert got["v"]["distinct_records"] == 2
    assert by(op.uniqueness(df, ["id"]), "column_name")["id"] == got["id"]
    assert op.uniqueness(df, ["nope"]).count() == 0


def test_uniqueness_of_nothing(spark):
    empty = spark.createDataFrame([], "id string, v string")
    for columns in (["id"], ["id", "v"]):
        got = by(op.uniqueness(empty, columns), "column_name")
        assert got["id"]["total_records"] == 0
        assert got["id"]["uniqueness_percentage"] == 0.0


def test_freshness(spark):
    df = spark.createDataFrame(
        [(dt.date(2023, 6, 15),), (dt.date(2023, 1, 1),), (None,)], "d date"
    )
    assert op.freshness(df, "d").first().asDict() == {
        "column_name": "d", "min_date": dt.date(2023, 1, 1), "max_date": dt.date(2023, 6, 15),
    }
    assert op.freshness(df, "nope").first().min_date is None


def test_profile_of_a_feed(crm_raw):
    crm = op.clean_crm(crm_raw)
    report = op.profile(crm, "CRM", at=dt.datetime(2024, 1, 1)).first()
    assert (report.source, report.total_records, report.column_count) == ("CRM", 5, 14)
    assert report.completeness.normalized_email.complete_count == 3
    assert report.format_validity.phone.valid_count == 3
    assert report.uniqueness.customer_id.distinct_records == 5
    assert report.freshness.max_date == dt.date(2024, 3, 1)


def test_profile_skips_what_the_input_lacks(spark):
    report = op.profile(spark.createDataFrame([("a",)], "city string"), "X")
    row = report.first()
    assert row.total_records == 1
    assert len(row.format_validity) == len(row.uniqueness) == 0
    assert row.freshness.column is None
    assert row.completeness.asDict().keys() == {"city"}
    lines = op.profile_lines(report).collect()
    assert {r.section for r in lines} == {"summary", "completeness", "freshness"}


def test_profile_of_nothing(crm_raw):
    report = op.profile(op.clean_crm(crm_raw.filter("false")), "CRM").first()
    assert report.total_records == 0
    assert report.uniqueness.customer_id.total_records == 0
    assert report.completeness.city.completeness_percentage == 0.0
    assert report.freshness.min_date is None


def test_profile_agrees_with_single_checks(crm_raw):
    raw = op.tidy_crm(crm_raw)
    lines = {
        (r.section, r.column_name, r.metric): r.metric_value
        for r in op.profile_lines(op.profile(raw, "CRM")).collect()
    }
    for row in op.completeness(raw, SPEC.columns).collect():
        assert lines["completeness", row.column_name, "null_count"] == row.null_count
    unique = op.uniqueness(raw, ["customer_id"]).first()
    assert lines["uniqueness", "customer_id", "duplicate_count"] == unique.duplicate_count == 1
    valid = by(op.validity(raw, SPEC.formats), "field")
    share = lines["format_validity", "email", "validity_percentage"]
    assert share == valid["email"]["validity_percentage"]


def test_master_has_its_own_spec(spark):
    df = spark.createDataFrame(
        [("GOLD_1", "a", "b", "e@mail.com", "+447911123456", "c", "k", dt.date(2024, 1, 1))],
        "gold_customer_id string, first_name string, last_name string, email string, "
        "phone string, city string, country string, last_updated date",
    )
    default, full = op.profile(df, "M").first(), op.profile(df, "M", MASTER_PROFILE).first()
    assert set(default.completeness.asDict()) == {"first_name", "last_name", "city", "country"}
    assert len(default.format_validity) == 0
    assert set(full.format_validity.asDict()) == {"email", "phone"}
    assert full.uniqueness.gold_customer_id.distinct_records == 1


def test_labels_need_no_escaping(spark):
    df = spark.createDataFrame([("a",)], "`it's \\` string")
    before = spark.conf.get("spark.sql.parser.escapedStringLiterals")
    spark.conf.set("spark.sql.parser.escapedStringLiterals", "true")
    try:
        label = "it's \\"
        assert op.completeness(df, [label]).first().column_name == label
        assert op.validity(df, [(label, label, "a")]).first().field == label
    finally:
        spark.conf.set("spark.sql.parser.escapedStringLiterals", before)
