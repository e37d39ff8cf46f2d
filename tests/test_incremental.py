"""Batches against one run over all rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rollcall import operators as op
from rollcall.plans import Mastery, apply_all, master_feeds
from rollcall.rules import MatchRule, Settings
from rollcall.schemas import CRM_RAW, TRANSACTION_RAW
from rollcall.sources import write_feed
from rollcall.streaming import stream_feed, stream_into

AS_OF = dt.date(2024, 6, 30)


def rows(df):
    df = df.drop("ingestion_timestamp")
    return sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


def feeds(seed, customers=25, purchases=60):
    """Rows with few ids, emails and phones, so that batches renew, move and share them."""
    chance = random.Random(seed)
    some = lambda kind, n, none=0.15: None if chance.random() < none else f"{kind}{chance.randint(0, n)}"
    day = lambda: f"2024-0{chance.randint(1, 5)}-1{chance.randint(0, 3)}"
    mail = lambda: chance.choice([None, "", " ", *(f"m{k}@x.org" for k in range(9))])
    phone = lambda: chance.choice([None, *(f"0791100000{k}" for k in range(7))])
    crm = [
        (some("C", 14, 0.1), some("F", 2), some("L", 2), mail(), phone(), some("A", 9), some("T", 2), "UK", day(), day())
        for _ in range(customers)
    ]
    trx = [
        (some("T", 30, 0.05), mail(), some("F", 2), some("L", 2), phone(), some("S", 9), some("T", 2), "UK", chance.choice([day(), None]))
        for _ in range(purchases)
    ]
    return crm, trx


def dealt(spark, seed, batches, crm, trx):
    chance = random.Random(seed)
    parts = [([], []) for _ in range(batches)]
    for side, feed in enumerate((crm, trx)):
        for row in feed:
            parts[chance.randrange(batches)][side].append(row)
            if chance.random() < 0.1:
                parts[chance.randrange(batches)][side].append(row)
    return [(spark.createDataFrame(c, CRM_RAW), spark.createDataFrame(t, TRANSACTION_RAW)) for c, t in parts]


@pytest.mark.parametrize(("seed", "settings"), [
    (1, Settings()),
    (2, Settings(sample_size=2, match_rules=(MatchRule("email", ("normalized_email",), 1.0, 3, match_blank=True),
                              MatchRule("phone", ("normalized_phone",), 0.4, 2)))),
])
def test_batches_give_what_one_run_gives(spark, tmp_path, seed, settings):
    crm, trx = feeds(seed)
    whole = master_feeds(spark.createDataFrame(crm, CRM_RAW), spark.createDataFrame(trx, TRANSACTION_RAW), settings, as_of=AS_OF)
    state = apply_all(Mastery(spark, str(tmp_path / "state"), settings), dealt(spark, seed, 3, crm, trx))
    assert state.version() == 3
    want = rows(whole.master)
    assert rows(state.master(AS_OF)) == want
    assert rows(state.compact(str(tmp_path / "compacted")).master(AS_OF)) == want


def test_only_touched_customers_are_written(spark, tmp_path, crm_raw, trx_raw):
    state = Mastery(spark, str(tmp_path / "state"))
    state.apply(crm_raw, trx_raw)
    assert {r.crm_id for r in state.touched_by(1).collect()} == {"C1", "C2", "C3", "C4", "C5"}
    purchase = ("T7", "bea@mail.fr", "B", "R", None, None, None, "France", "2024-05-01")
    state.apply(crm_raw.limit(0), spark.createDataFrame([purchase], TRANSACTION_RAW))
    (row,) = state.touched_by(2).collect()
    assert (row.crm_id, row.txn_id, row.total_transactions) == ("C2", "T7", 1)
    # An older row of a known transaction changes nothing.
    state.apply(crm_raw.limit(0), spark.createDataFrame([(*purchase[:8], "2023-05-01")], TRANSACTION_RAW))
    assert state.touched_by(3).count() == 0
    # A newer one that goes to another customer takes the purchase from the first.
    moved = ("T7", "eve@mail.com", "E", "K", None, None, None, "UK", "2024-06-01")
    state.apply(crm_raw.limit(0), spark.createDataFrame([moved], TRANSACTION_RAW))
    assert {r.crm_id: (r.txn_id, r.total_transactions) for r in state.touched_by(4).collect()} == {"C2": (None, 0), "C5": ("T7", 1)}
    assert state.merged(version=2).filter("txn_id = 'T7'").select("crm_id").collect()[0][0] == "C2"


def test_untouched_customers_reach_no_join(spark, tmp_path, crm_raw, trx_raw):
    """The semi join that picks touched customers is the first thing that happens to the table."""
    state = Mastery(spark, str(tmp_path / "state"))
    state.apply(crm_raw, trx_raw)
    changes = state._changes("transactions", op.clean_transactions(trx_raw.filter("transaction_id = 'T4'")), 0, _Stay())
    none = state._changes("customers", op.clean_crm(crm_raw.limit(0)), 0, _Stay())
    touched = state._touched(none, changes, 1)
    assert [r.customer_id for r in touched.collect()] == ["C4"]
    plan = touched._jdf.queryExecution().optimizedPlan().toString()
    # Before any join and window, rows of the state are cut to those with a touched id.
    assert plan.count("LeftSemi") == 2
    assert plan.index("Window") < plan.index("LeftSemi")


class _Stay:
    """In place of a scratch folder: frames as they are."""

    def stage(self, df, name):
        return df


class _Kept(_Stay):
    """Frames as they are, by name."""

    def __init__(self):
        self.staged = {}

    def stage(self, df, name):
        self.staged[name] = df
        return df


def _purchase(number, mail, day):
    return (f"T{number}", f"{mail}@x.org", f"F{mail}", "L", None, None, "Bath", "UK", day)


def test_a_batch_writes_facts_and_links_of_its_own_rows_only(spark, tmp_path, crm_raw):
    """What earlier batches know of a key is merged when it is read, not joined and written again."""
    state, none = Mastery(spark, str(tmp_path / "state")), crm_raw.limit(0)
    for number in (1, 2, 3):
        state.apply(none, spark.createDataFrame([_purchase(number, "a", f"2024-01-0{number}")], TRANSACTION_RAW))
    assert {r.transaction_id for r in state._read("links").filter("version = 3").collect()} == {"T3"}
    assert [r.total_transactions for r in state._read("facts").filter("version = 3").collect()] == [1]
    assert {r.transaction_id for r in state._merged_links(3).collect()} == {"T1"}
    (fact,) = state._merged_facts(3).collect()
    assert (fact.total_transactions, fact.latest_transaction_id, fact.sample_transaction_ids) == (3, "T3", ["T1", "T2", "T3"])


def test_only_ids_seen_before_meet_known_rows(spark, tmp_path, crm_raw):
    state = Mastery(spark, str(tmp_path / "state"))
    old = [_purchase(n, n, "2024-01-01") for n in range(20)]
    state.apply(crm_raw.limit(0), spark.createDataFrame(old, TRANSACTION_RAW))
    new = [_purchase(n, n, "2024-02-01") for n in range(18, 40)] + [(None, *_purchase(0, "n", "2024-02-01")[1:])]
    kept = _Kept()
    changes = state._changes("transactions", op.clean_transactions(spark.createDataFrame(new, TRANSACTION_RAW)), 1, kept)
    assert sorted(r.transaction_id for r in kept.staged["both_transactions"].collect()) == ["T18", "T18", "T19", "T19"]
    assert changes.came.count() == 23
    assert sorted(r.transaction_id for r in changes.gone.collect()) == ["T18", "T19"]


def test_keys_are_reduced_anew_only_where_their_lowest_id_goes(spark, tmp_path, crm_raw):
    state, none = Mastery(spark, str(tmp_path / "state")), crm_raw.limit(0)
    state.apply(none, spark.createDataFrame([_purchase(n, "a", "2024-01-01") for n in (1, 2, 3)], TRANSACTION_RAW))
    # A newer row with the same keys, and one that is not the lowest of the keys it leaves.
    renewed = [_purchase(1, "a", "2024-02-01"), _purchase(3, "b", "2024-02-01")]
    state.apply(none, spark.createDataFrame(renewed, TRANSACTION_RAW))
    assert state._read("links").filter("anew").count() == 0
    state.apply(none, spark.createDataFrame([_purchase(1, "b", "2024-03-01")], TRANSACTION_RAW))
    anew = state._read("links").filter("anew").collect()
    assert {(r.version, r.transaction_id) for r in anew} == {(3, "T2")}
    assert {(r._key0, r.transaction_id) for r in state._merged_links(3).collect()} == {
        ("a@x.org", "T2"), ("b@x.org", "T1"), ("Fa", "T2"), ("Fb", "T1"),
    }


def test_a_failed_batch_is_written_again(spark, tmp_path, crm_raw, trx_raw, monkeypatch):
    state = Mastery(spark, str(tmp_path / "state"))
    state.apply(crm_raw.limit(2), trx_raw.limit(2))

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Mastery, "_remastered", fails)
        with pytest.raises(RuntimeError, match="lost"):
            state.apply(crm_raw, trx_raw)
    assert state.version() == 1
    state.apply(crm_raw, trx_raw)
    assert rows(state.master(AS_OF)) == rows(master_feeds(crm_raw, trx_raw, as_of=AS_OF).master)


def test_needs_a_rule_and_a_batch(spark, tmp_path):
    with pytest.raises(ValueError, match="threshold"):
        Mastery(spark, str(tmp_path), Settings(confidence_threshold=2.0))
    with pytest.raises(ValueError, match="no batch"):
        Mastery(spark, str(tmp_path)).merged()


# --- streams --------------------------------------------------------------------


def test_a_stream_of_files_is_one_batch_after_another(spark, tmp_path):
    _, trx = feeds(5, purchases=24)
    whole = op.clean_transactions(spark.createDataFrame([[None if x == "" else x for x in row] for row in trx], TRANSACTION_RAW))
    for k in range(2):
        part = spark.createDataFrame(trx[k::2], TRANSACTION_RAW)
        write_feed(part.coalesce(1), str(tmp_path / "feed" / str(k)))
    state = Mastery(spark, str(tmp_path / "state"))
    rows_in = stream_feed(spark, str(tmp_path / "feed" / "*"), "transactions", files=1)
    stream_into(state, rows_in, "transactions", str(tmp_path / "progress")).awaitTermination()
    assert state.version() == 2
    assert rows(state.cleaned("transactions")) == rows(whole)
    # Nothing new, and a micro-batch that comes again.
    stream_into(state, rows_in, "transactions", str(tmp_path / "progress")).awaitTermination()
    assert state.apply(spark.createDataFrame([], CRM_RAW), whole.limit(0), tag=f"{tmp_path / 'progress'}#0") == 1
    assert state.version() == 2


# --- history ------------------------------------------------------------------


def test_history_gives_back_every_snapshot(spark):
    layout = "id string, a string, b int, seen int"
    snapshots = [
        [("1", "x", 1, 0), ("2", None, 2, 0), (None, "n", 3, 0), ("4", "", None, 0)],
        [("1", "x", 1, 9), ("2", "", 2, 0), (None, "m", 3, 0), ("5", "y", 1, 0)],
        [],
        [("1", "x", 1, 0), ("4", None, None, 0), (None, "m", 3, 0)],
    ]
    days = [dt.date(2024, 1, k + 1) for k in range(4)]
    history = op.first_history(spark.createDataFrame(snapshots[0], layout), days[0])
    for snapshot, day in zip(snapshots[1:], days[1:], strict=True):
        history = op.next_history(history, spark.createDataFrame(snapshot, layout), day, "id", ignore=["seen"])
    for snapshot, day in zip(snapshots, days, strict=True):
        back = [tuple(r)[:3] for r in op.at_moment(history, day).collect()]
        assert sorted(back, key=repr) == sorted((r[:3] for r in snapshot), key=repr)
    spans = [(r.a, r.valid_from.day, r.valid_to and r.valid_to.day) for r in history.filter("id = '1'").collect()]
    assert sorted(spans) == [("x", 1, 3), ("x", 4, None)]
    assert op.at_moment(history, dt.date(2023, 1, 1)).count() == 0


def test_only_changes_are_new_rows(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7).alias("v"))
    history = op.first_history(df, dt.date(2024, 1, 1))
    later = df.withColumn("v", F.when(F.col("id") == "5", 99).otherwise(F.col("v")))
    changed = op.changes(history, later, "id").collect()
    assert [(r._id_text, r._open, r._there) for r in changed] == [("5", True, True)]
    assert op.next_history(history, later, dt.date(2024, 1, 2), "id").count() == 1001
