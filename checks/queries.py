"""One query per operator, on the feeds of :mod:`checks.fixture`."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture
from rollcall import functions as fn
from rollcall import operators as op
from rollcall.operators.fuzzy import full_name
from rollcall.plans import Mastery, apply_all
from rollcall.rules import MASTER_PROFILE, MATCH_RULES, MatchRule, ProfileSpec
from rollcall.schemas import CRM_RAW
from rollcall.sources import (
    Scratch,
    Sifted,
    read_crm,
    read_sifted,
    read_transactions,
    write_analytics,
    write_feed,
    write_master,
    write_report,
)
from rollcall.streaming import stream_feed, stream_into

EMAIL_RULE, PHONE_RULE, NAME_RULE = MATCH_RULES
SPEC = ProfileSpec()


def output_folder(spark: SparkSession) -> Scratch:
    """A new folder for what a query writes; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="checks-")
    return Scratch(spark, folder)


@dataclass(frozen=True)
class Feeds:
    """The frames queries start from, each planned at most once."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def crm_raw(self) -> DataFrame:
        return fixture.crm_raw(self.spark, self.sf_dir)

    @cached_property
    def trx_raw(self) -> DataFrame:
        return fixture.trx_raw(self.spark, self.sf_dir)

    @cached_property
    def crm(self) -> DataFrame:
        return op.clean_crm(self.crm_raw)

    @cached_property
    def trx(self) -> DataFrame:
        return op.clean_transactions(self.trx_raw)

    @cached_property
    def mapping(self) -> DataFrame:
        return op.reconcile(self.crm, self.trx)

    @cached_property
    def master(self) -> DataFrame:
        mapping = op.reconcile(self.crm, self.trx, keyed=True)
        return op.build_master(self.crm, self.trx, mapping, as_of=fixture.AS_OF)

    @cached_property
    def facts(self) -> DataFrame:
        return op.aggregate_transactions(self.trx)


Query = Callable[[Feeds], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _without_time(df: DataFrame) -> DataFrame:
    return df.drop("ingestion_timestamp")


def _comparable(master: DataFrame) -> DataFrame:
    """Mastered rows without the run time, sample ids as text."""
    ids = F.concat_ws(",", "sample_transaction_ids")
    return _without_time(master).withColumn("sample_transaction_ids", ids)


# --- feeds and cleaning -------------------------------------------------------


@query
def crm_csv_roundtrip(feeds: Feeds) -> DataFrame:
    path = f"{output_folder(feeds.spark).folder}/crm_csv"
    write_feed(feeds.crm_raw, path)
    return read_crm(feeds.spark, path)


@query
def trx_csv_roundtrip(feeds: Feeds) -> DataFrame:
    path = f"{output_folder(feeds.spark).folder}/trx_csv"
    write_feed(feeds.trx_raw, path)
    return read_transactions(feeds.spark, path)


def _sifted_feed(feeds: Feeds) -> Sifted:
    # Spark's chr() ends at 255.
    sql = fixture.FEED_LINES_SQL.replace("chr(65533)", "'\ufffd'").replace("({crm_raw})", "{crm_raw}")
    lines = feeds.spark.sql(sql, crm_raw=feeds.crm_raw).select("line")
    path = f"{output_folder(feeds.spark).folder}/lines"
    lines.write.text(path)
    return read_sifted(feeds.spark, path, CRM_RAW, header=False)


@query
def feed_accepted(feeds: Feeds) -> DataFrame:
    return _sifted_feed(feeds).rows


@query
def feed_rejects(feeds: Feeds) -> DataFrame:
    return _sifted_feed(feeds).rejects.select("reason", "line")


@query
def crm_clean(feeds: Feeds) -> DataFrame:
    return op.tidy_crm(feeds.crm_raw)


@query
def trx_clean(feeds: Feeds) -> DataFrame:
    return op.tidy_transactions(feeds.trx_raw)


@query
def normalize_email(feeds: Feeds) -> DataFrame:
    cases = fixture.email_cases(feeds.spark, feeds.sf_dir)
    return cases.select("id", "email", fn.email(F.col("email")).alias("normalized_email"))


@query
def normalize_phone(feeds: Feeds) -> DataFrame:
    cases = fixture.phone_cases(feeds.spark, feeds.sf_dir)
    normal = fn.phone(F.col("phone"), F.col("country"))
    return cases.select("id", "country", "phone", normal.alias("normalized_phone"))


@query
def normalize_date(feeds: Feeds) -> DataFrame:
    cases = fixture.date_cases(feeds.spark, feeds.sf_dir)
    text = F.col("text")
    optional = fn.parse_date(text, ("yyyy-MM-dd['T'HH:mm:ss]", "yyyyMMdd"))
    return cases.select(
        "id", "text", fn.parse_date(text).alias("parsed"), optional.alias("parsed_optional")
    )


@query
def dedup_crm(feeds: Feeds) -> DataFrame:
    return op.latest_per_key(feeds.crm_raw, "customer_id", "last_updated")


@query
def dedup_trx(feeds: Feeds) -> DataFrame:
    return op.latest_per_key(feeds.trx_raw, "transaction_id", "purchase_date")


@query
def lineage_columns(feeds: Feeds) -> DataFrame:
    at = F.lit(str(fixture.AS_OF_TIME)).cast("timestamp")
    traced = op.with_lineage(feeds.crm_raw, "CRM", at)
    return traced.select(
        "customer_id",
        "last_updated",
        "source",
        F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("ingested"),
    )


@query
def crm_clean_dedup(feeds: Feeds) -> DataFrame:
    return _without_time(feeds.crm)


@query
def trx_clean_dedup(feeds: Feeds) -> DataFrame:
    return _without_time(feeds.trx)


# --- quality ------------------------------------------------------------------


@query
def row_counts(feeds: Feeds) -> DataFrame:
    named = {
        "crm_raw": feeds.crm_raw,
        "trx_raw": feeds.trx_raw,
        "crm": feeds.crm,
        "trx": feeds.trx,
    }
    counts = [op.row_count(df, name) for name, df in named.items()]
    first, *others = counts
    for other in others:
        first = first.unionByName(other)
    return first


@query
def quality_completeness(feeds: Feeds) -> DataFrame:
    return op.completeness(feeds.crm, SPEC.columns)


@query
def quality_missing_column(feeds: Feeds) -> DataFrame:
    return op.completeness(feeds.trx, ["first_name", "loyalty_tier", "normalized_email"])


@query
def quality_validity(feeds: Feeds) -> DataFrame:
    return op.validity(feeds.crm, SPEC.formats)


@query
def quality_uniqueness(feeds: Feeds) -> DataFrame:
    return op.uniqueness(
        op.tidy_crm(feeds.crm_raw), ["customer_id", "normalized_email", "city"]
    )


@query
def quality_freshness(feeds: Feeds) -> DataFrame:
    return op.freshness(feeds.trx, "purchase_date").unionByName(
        op.freshness(feeds.trx, "last_updated")
    )


@query
def quality_report_crm(feeds: Feeds) -> DataFrame:
    return op.profile_lines(op.profile(feeds.crm, "CRM"))


@query
def quality_report_trx(feeds: Feeds) -> DataFrame:
    return op.profile_lines(op.profile(feeds.trx, "TRX"))


@query
def quality_report_master(feeds: Feeds) -> DataFrame:
    return op.profile_lines(op.profile(feeds.master, "GOLDEN"))


@query
def quality_report_master_full(feeds: Feeds) -> DataFrame:
    return op.profile_lines(op.profile(feeds.master, "GOLDEN", MASTER_PROFILE))


# --- matching -----------------------------------------------------------------


@query
def match_email(feeds: Feeds) -> DataFrame:
    return op.match_pairs(feeds.crm, feeds.trx, EMAIL_RULE)


@query
def match_phone(feeds: Feeds) -> DataFrame:
    return op.match_pairs(feeds.crm, feeds.trx, PHONE_RULE)


@query
def match_name_address(feeds: Feeds) -> DataFrame:
    return op.match_pairs(feeds.crm, feeds.trx, NAME_RULE)


@query
def all_matches(feeds: Feeds) -> DataFrame:
    return op.all_matches(feeds.crm, feeds.trx)


@query
def match_threshold(feeds: Feeds) -> DataFrame:
    return op.all_matches(feeds.crm, feeds.trx, threshold=0.7)


@query
def match_key_counts(feeds: Feeds) -> DataFrame:
    return op.match_key_counts(feeds.crm, feeds.trx)


@query
def near_names(feeds: Feeds) -> DataFrame:
    sides = [df.withColumn("name", full_name()) for df in (feeds.crm, feeds.trx)]
    return op.near_names(*sides)


@query
def fuzzy_match(feeds: Feeds) -> DataFrame:
    return op.fuzzy_match(feeds.crm, feeds.trx)


@query
def households(feeds: Feeds) -> DataFrame:
    rules = [MatchRule(f"key{n}", keys, 1.0, n) for n, keys in enumerate(fixture.HOUSEHOLD_KEYS)]
    crm = feeds.crm.withColumn("registration_date", F.col("registration_date").cast("string"))
    scratch = output_folder(feeds.spark)
    return op.households(scratch.stage(crm, "crm"), scratch, rules)


@query
def best_match(feeds: Feeds) -> DataFrame:
    return op.best_match(feeds.crm, feeds.trx)


@query
def unmatched_customers(feeds: Feeds) -> DataFrame:
    return op.unmatched_customers(feeds.crm, op.best_match(feeds.crm, feeds.trx))


@query
def reconcile(feeds: Feeds) -> DataFrame:
    return feeds.mapping


@query
def staged_reuse(feeds: Feeds) -> DataFrame:
    scratch = output_folder(feeds.spark)
    return op.reconcile(scratch.stage(feeds.crm, "crm"), scratch.stage(feeds.trx, "trx"))


@query
def match_stats(feeds: Feeds) -> DataFrame:
    return op.match_stats(feeds.mapping)


@query
def match_stats_empty(feeds: Feeds) -> DataFrame:
    nobody = feeds.crm.filter(F.col("country") == "Atlantis")
    return op.match_stats(op.reconcile(nobody, feeds.trx))


@query
def match_rate(feeds: Feeds) -> DataFrame:
    return op.match_rate(feeds.mapping)


# --- purchase facts and the mastered record -----------------------------------


@query
def txn_aggregate(feeds: Feeds) -> DataFrame:
    return _comparable(feeds.facts)


@query
def latest_transaction(feeds: Feeds) -> DataFrame:
    return op.latest_transaction(feeds.trx)


@query
def survivorship(feeds: Feeds) -> DataFrame:
    return _comparable(op.survivorship(feeds.crm, feeds.trx, feeds.mapping))


@query
def match_quality(feeds: Feeds) -> DataFrame:
    return feeds.mapping.select(
        "crm_customer_id",
        "confidence_score",
        fn.match_quality(F.col("confidence_score")).alias("match_quality"),
    )


@query
def tenure(feeds: Feeds) -> DataFrame:
    registered = F.col("registration_date")
    return feeds.crm.select(
        "customer_id",
        "registration_date",
        fn.tenure_days(registered, fixture.AS_OF).alias("customer_tenure_days"),
        fn.tenure_months(registered, fixture.AS_OF).alias("customer_tenure_months"),
    )


@query
def is_active(feeds: Feeds) -> DataFrame:
    bought = F.col("purchase_date")
    return feeds.trx.select(
        "transaction_id",
        "purchase_date",
        fn.is_active(bought, fixture.AS_OF).alias("is_active"),
    )


@query
def data_quality_score(feeds: Feeds) -> DataFrame:
    contact = feeds.crm.select(
        "customer_id",
        F.col("normalized_email").alias("email"),
        "phone",
        "address",
        "city",
        "country",
    )
    return contact.select(
        "customer_id", fn.data_quality_score().alias("data_quality_score")
    )


@query
def master_record(feeds: Feeds) -> DataFrame:
    return _comparable(feeds.master)


@query
def analytics_subset(feeds: Feeds) -> DataFrame:
    return op.analytics_view(feeds.master)


@query
def master_sample(feeds: Feeds) -> DataFrame:
    return op.master_sample(feeds.master)


# --- batch by batch -------------------------------------------------------------


def _mastery(feeds: Feeds) -> Mastery:
    """The state after all batches of both feeds."""
    crm = fixture.batches(feeds.crm_raw, fixture.CRM_LOT)
    trx = fixture.batches(feeds.trx_raw, fixture.TRX_LOT)
    state = Mastery(feeds.spark, f"{output_folder(feeds.spark).folder}/mastery")
    return apply_all(state, list(zip(crm, trx, strict=True)))


@query
def incremental_master(feeds: Feeds) -> DataFrame:
    return _comparable(_mastery(feeds).master(as_of=fixture.AS_OF))


@query
def incremental_touched(feeds: Feeds) -> DataFrame:
    state = _mastery(feeds)
    last = state.touched_by(state.version())
    return last.select("crm_id", "match_type", "txn_id", "total_transactions")


@query
def stream_trx_clean_dedup(feeds: Feeds) -> DataFrame:
    folder = output_folder(feeds.spark).folder
    for number, part in enumerate(fixture.batches(feeds.trx_raw, fixture.TRX_LOT)):
        write_feed(part, f"{folder}/feed/{number}")
    state = Mastery(feeds.spark, f"{folder}/mastery")
    rows = stream_feed(feeds.spark, f"{folder}/feed/*", "transactions", files=4)
    stream_into(state, rows, "transactions", f"{folder}/progress").awaitTermination()
    return _without_time(state.cleaned("transactions"))


@query
def master_history(feeds: Feeds) -> DataFrame:
    scratch, history = output_folder(feeds.spark), None
    for number, day in enumerate(fixture.SNAPSHOT_DAYS):
        trx = feeds.trx.filter(F.col("purchase_date") <= day)
        mapping = op.reconcile(feeds.crm, trx, keyed=True)
        snapshot = scratch.stage(op.survivorship(feeds.crm, trx, mapping), f"snapshot_{number}")
        if history is None:
            history = op.first_history(snapshot, day)
        else:
            history = op.next_history(history, snapshot, day, "crm_id")
        history = scratch.stage(history, f"history_{number}")
    return _comparable(history)


# --- sinks --------------------------------------------------------------------


@query
def sink_master_parquet(feeds: Feeds) -> DataFrame:
    return _comparable(write_master(feeds.master, output_folder(feeds.spark).folder))


@query
def sink_analytics_parquet(feeds: Feeds) -> DataFrame:
    folder = output_folder(feeds.spark).folder
    return write_analytics(write_master(feeds.master, folder), folder)


@query
def sink_quality_json(feeds: Feeds) -> DataFrame:
    report = op.profile(feeds.crm, "CRM", at=fixture.AS_OF_TIME)
    folder = output_folder(feeds.spark).folder
    path = write_report(report, folder, "CRM", fixture.AS_OF_TIME)
    written = feeds.spark.read.schema(report.schema).json(path, multiLine=True)
    return op.profile_lines(written)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Feeds(spark, sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()}
