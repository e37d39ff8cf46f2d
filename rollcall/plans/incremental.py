"""Mastering batch by batch: what a batch doesn't touch is neither joined nor written.

The state is five tables below one folder. Each batch appends a version to them:

=============  =======================  ==================================================
table          key                      what a row holds
=============  =======================  ==================================================
customers      customer id              the newest cleaned row of the customer
transactions   transaction id           the newest cleaned row of the transaction
facts          email                    purchase facts of the batch's transactions
links          match rule and its key   the lowest transaction id of the batch
merged         customer id              the mastered record before derived fields
=============  =======================  ==================================================

The last version of an id is the one that counts. Facts and links of a key merge when they
are read, so a batch writes its own and meets none of those before. A batch may also bring
a newer row of a transaction seen before; what the older row gave can't be taken out of a
minimum, so the keys that lose one alone are reduced anew from all of their transactions.
Such a row is ``anew``: it stands for all versions before it, too.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.functions import blank_to_null
from rollcall.functions.derived import AsOf
from rollcall.operators import clean_crm, clean_transactions, derive, with_lineage
from rollcall.operators.keys import ID_KEY, hash_led, id_key, unused
from rollcall.operators.mastering import matches_blank_emails, merge_facts
from rollcall.operators.matching import customer_keys, lowest_per_key, reconcile_keys
from rollcall.operators.purchases import email_facts, merged_facts
from rollcall.rules import MatchRule, Settings
from rollcall.schemas import CRM_RAW, TRANSACTION_RAW
from rollcall.sources import Scratch
from rollcall.sources.scratch import hadoop_path

TABLES = ("customers", "transactions", "facts", "links", "merged")
_VERSION = "version"
_ANEW = "anew"


def _short(tag: str | None) -> str:
    """A tag as part of a file name."""
    return hashlib.sha256(tag.encode()).hexdigest()[:32] if tag else ""


def _semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys``; neither side's keys are NULL."""
    named, columns = hash_led(df, on)
    wanted, _ = hash_led(keys.select(*on), on)
    return named.join(wanted.distinct(), columns, "left_semi").select(*df.columns)


def _semi_id(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is among ``ids``, left where :func:`_last` looks for them."""
    return df.join(ids.select(*ID_KEY).distinct(), list(ID_KEY), "left_semi").select(*df.columns)


def _last(df: DataFrame) -> DataFrame:
    """The last version of every id."""
    order = Window.partitionBy(*ID_KEY).orderBy(F.col(_VERSION).desc())
    rank = unused(df, "_rank")
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).drop(rank)


def _since_anew(rows: DataFrame, on: Sequence[str], among: DataFrame | None = None) -> DataFrame:
    """The versions of every key, or of those ``among`` others, that merge into what holds now.

    The ``_hash`` that leads the key stays, so that they merge where they are."""
    keyed, keys = hash_led(rows, on)
    if among is not None:
        wanted, _ = hash_led(among.select(*on), on)
        keyed = keyed.join(wanted.distinct(), keys, "left_semi")
    since = unused(keyed, "_since")
    last = F.max(F.when(F.col(_ANEW), F.col(_VERSION))).over(Window.partitionBy(*keys))
    kept = keyed.withColumn(since, last).filter(F.col(since).isNull() | (F.col(_VERSION) >= F.col(since)))
    return kept.drop(since, _ANEW, _VERSION)


@dataclass(frozen=True)
class _Changes:
    """Rows that a batch brings or renews, and the older rows it replaces."""

    came: DataFrame
    gone: DataFrame


class Mastery:
    """The mastered customers of all batches so far, in ``folder``.

    A version counts once all of its tables are written. :meth:`apply` writes the next one
    again if a run before it has failed in between. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: Settings = Settings()) -> None:
        if all(rule.confidence < settings.confidence_threshold for rule in settings.match_rules):
            raise ValueError("no match rule reaches the confidence threshold")
        self.spark, self.folder, self.settings = spark, folder.rstrip("/"), settings

    # --- tables -------------------------------------------------------------------

    def _done(self) -> dict[int, str]:
        """Whole versions, and the tags of their batches."""
        folder, files = hadoop_path(self.spark, f"{self.folder}/done")
        if not files.exists(folder):
            return {}
        names = (f.getPath().getName() for f in files.listStatus(folder))
        return {int(number): tag for number, _, tag in (name.partition("-") for name in names)}

    def _finish(self, version: int, tag: str | None = None) -> None:
        mark, files = hadoop_path(self.spark, f"{self.folder}/done/{version}-{_short(tag)}")
        files.create(mark).close()

    def version(self) -> int:
        """The last whole version; 0 before the first batch."""
        return max(self._done(), default=0)

    def _read(self, table: str, upto: int | None = None) -> DataFrame | None:
        """All versions of a table's rows, up to a version."""
        upto = self.version() if upto is None else upto
        if not upto:
            return None
        paths = [f"{self.folder}/{table}/{_VERSION}={v}" for v in range(1, upto + 1)]
        return self.spark.read.option("basePath", f"{self.folder}/{table}").parquet(*paths)

    def _append(self, df: DataFrame, table: str, version: int) -> DataFrame:
        """The rows as written."""
        path = f"{self.folder}/{table}/{_VERSION}={version}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # --- one batch ----------------------------------------------------------------

    def apply(
        self,
        crm_raw: DataFrame,
        trx_raw: DataFrame,
        at: dt.datetime | Column | None = None,
        tag: str | None = None,
    ) -> int:
        """Take in a batch of raw rows of either feed; the number of its version.

        A ``tag`` names the batch: the one of a whole version is not taken in again.

        A batch may bring new ids, newer or older rows of known ids, and rows seen before.
        The order of batches doesn't matter for the result, nor how rows are dealt to them.
        """
        done = self._done()
        if tag is not None and _short(tag) in done.values():
            return next(version for version, name in done.items() if name == _short(tag))
        known = max(done, default=0)
        version = known + 1
        settings = self.settings
        with Scratch(self.spark, f"{self.folder}/scratch") as scratch:
            crm = self._changes("customers", clean_crm(crm_raw, settings, at), known, scratch)
            trx = self._changes("transactions", clean_transactions(trx_raw, settings, at), known, scratch)
            # What came is read where it is written from now on.
            crm = _Changes(self._append(crm.came, "customers", version), crm.gone)
            trx = _Changes(self._append(trx.came, "transactions", version), trx.gone)
            transactions = self._read("transactions", version)

            self._append(self._facts(trx, transactions, known, scratch), "facts", version)
            links = self._append(self._links(trx, transactions, known, scratch), "links", version)
            touched = scratch.stage(self._touched(crm, trx, version, links, scratch), "touched")
            self._append(self._remastered(touched, version), "merged", version)
        self._finish(version, tag)
        return version

    def _changes(self, table: str, new: DataFrame, known: int, scratch: Scratch) -> _Changes:
        """Which rows of ``new``, one per id, are newer than the known ones of their ids.

        Of the known rows only the hashes of their ids move. Rows, known and new, whose hash is
        on both sides meet by their ids; all other new rows came.
        """
        key, newest, names = {
            "customers": ("customer_id", "last_updated", CRM_RAW.names),
            "transactions": ("transaction_id", "purchase_date", TRANSACTION_RAW.names),
        }[table]
        new = new.select("*", *id_key(key))
        old = self._read(table, known)
        if old is None:
            return _Changes(new, new.filter(F.lit(False)))
        new, name = scratch.stage(new, f"new_{table}"), ID_KEY[0]
        shared = old.select(name).join(new.select(name), name, "left_semi").distinct()
        shared = scratch.stage(shared, f"shared_{table}")
        old = _last(old.join(shared, name, "left_semi").select(*old.columns)).drop(_VERSION)
        again = new.join(shared, name, "left_semi").select(*new.columns)
        both = old.withColumn("_new", F.lit(0)).unionByName(again.withColumn("_new", F.lit(1)))
        ties = [F.col(c).asc_nulls_last() for c in names if c not in (key, newest)]
        order = Window.partitionBy(*ID_KEY).orderBy(F.col(newest).desc_nulls_last(), *ties, "_new")
        first = F.first("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        both = scratch.stage(
            both.withColumns({"_rank": F.row_number().over(order), "_renewed": first}), f"both_{table}"
        )
        kept = both.filter((F.col("_rank") == 1) & (F.col("_new") == 1)).select(*new.columns)
        lost = both.filter((F.col("_rank") == 2) & (F.col("_new") == 0) & (F.col("_renewed") == 1))
        came = new.join(shared, name, "left_anti").select(*new.columns).unionByName(kept)
        return _Changes(came, lost.select(*new.columns))

    def _live(self, transactions: DataFrame, some: DataFrame, scratch: Scratch, name: str) -> DataFrame:
        """The last rows of the transactions that have a row in ``some``."""
        ids = scratch.stage(some.select(*ID_KEY).distinct(), name)
        return _last(_semi_id(transactions, ids)).drop(_VERSION)

    def _facts(self, trx: _Changes, transactions: DataFrame, known: int, scratch: Scratch) -> DataFrame:
        size, blank = self.settings.sample_size, matches_blank_emails(self.settings)

        def facts(rows: DataFrame) -> DataFrame:
            return email_facts(rows, size, blank)

        if not known:
            return facts(trx.came).withColumn(_ANEW, F.lit(False))
        on = ["normalized_email"]
        email = F.col(on[0]) if blank else blank_to_null(on[0])
        # Staged, so that Spark knows how few there are and leaves the state where it is.
        lost = scratch.stage(trx.gone.select(*on).filter(email.isNotNull()).distinct(), "lost_emails")
        fresh = facts(trx.came.join(lost, on, "left_anti"))
        again = self._live(transactions, _semi(transactions, lost, on), scratch, "ids_by_email")
        again = facts(_semi(again, lost, on))
        # An email whose purchases all went to others keeps an empty row.
        again = lost.join(again, on, "left").fillna(0, ["total_transactions"])
        return fresh.withColumn(_ANEW, F.lit(False)).unionByName(again.withColumn(_ANEW, F.lit(True)))

    def _links(self, trx: _Changes, transactions: DataFrame, known: int, scratch: Scratch) -> DataFrame:
        rules, threshold = self.settings.match_rules, self.settings.confidence_threshold
        fresh, before = self._keys(trx.came), self._read("links", known)
        if before is None:
            return fresh.withColumn(_ANEW, F.lit(False))
        on = [c for c in fresh.columns if c != "transaction_id"]

        def entries(rows: DataFrame) -> DataFrame:
            named = rows.select(F.struct(*ID_KEY).alias("_row"), *rows.columns)
            return customer_keys(named.withColumn("customer_id", F.col("_row")), rules, threshold)

        # A key loses the id of a replaced row unless the new row has the key as well, and
        # misses it only if the id was the lowest.
        gone = scratch.stage(entries(trx.gone).select("customer_id.*", *on), "gone_keys")
        renewed = scratch.stage(entries(_semi_id(trx.came, gone)).select("customer_id.*", *on), "renewed_keys")
        dropped = gone.join(renewed, [*ID_KEY, *on], "left_anti")
        dropped = dropped.filter(~F.col("_id_missing")).withColumn("transaction_id", F.col("_id_text"))
        dropped = scratch.stage(dropped.select(*on, "transaction_id").distinct(), "dropped_keys")
        lost = scratch.stage(_semi(before, dropped, [*on, "transaction_id"]).select(*on).distinct(), "lost_keys")
        ids = _semi(entries(transactions), lost, on).select("customer_id.*")
        again = _semi(self._keys(self._live(transactions, ids, scratch, "ids_by_key")), lost, on)
        again = lost.join(again, on, "left").withColumn(_ANEW, F.lit(True))
        return fresh.join(lost, on, "left_anti").withColumn(_ANEW, F.lit(False)).unionByName(again)

    def _keys(self, rows: DataFrame) -> DataFrame:
        return lowest_per_key(rows, self.settings.match_rules, self.settings.confidence_threshold)

    def _touch_rules(self) -> tuple[MatchRule, ...]:
        """The match rules, and one for the email that brings purchase facts, unless one of them is."""
        blank, threshold = matches_blank_emails(self.settings), self.settings.confidence_threshold
        facts = MatchRule("facts", ("normalized_email",), confidence=2.0, priority=0, match_blank=blank)
        for rule in self.settings.match_rules:
            if (rule.keys, rule.match_blank) == (facts.keys, blank) and rule.confidence >= threshold:
                return tuple(self.settings.match_rules)
        return (*self.settings.match_rules, facts)

    def _touched(
        self,
        crm: _Changes,
        trx: _Changes,
        version: int,
        links: DataFrame | None = None,
        scratch: Scratch | None = None,
    ) -> DataFrame:
        """The last rows of customers that are new or share a key with a changed transaction.

        ``links`` has the keys of the rows that came, where they have been reduced already.
        """
        rules, threshold = self._touch_rules(), self.settings.confidence_threshold
        customers = self._read("customers", version)
        if links is not None and rules == tuple(self.settings.match_rules):
            on = [c for c in links.columns if c not in ("transaction_id", _ANEW)]
            changed = links.select(*on).unionByName(self._keys(trx.gone).select(*on))
        else:
            changed = lowest_per_key(trx.came.unionByName(trx.gone), rules, threshold)
            on = [c for c in changed.columns if c != "transaction_id"]
        named = customers.select(F.struct(*ID_KEY).alias("_row"), *customers.columns)
        keys = customer_keys(named.withColumn("customer_id", F.col("_row")), rules, threshold)
        ids = _semi(keys, changed, on).select("customer_id.*").unionByName(crm.came.select(*ID_KEY))
        if scratch is not None:
            ids = scratch.stage(ids.distinct(), "touched_ids")
        return _last(_semi_id(customers, ids)).drop(_VERSION)

    def _merged_facts(self, version: int, among: DataFrame | None = None) -> DataFrame:
        """The facts of every email, or of some, as of a version."""
        rows = _since_anew(self._read("facts", version), ["normalized_email"], among)
        return merged_facts(rows, self.settings.sample_size, ["_hash", "normalized_email"])

    def _merged_links(self, version: int, among: DataFrame | None = None) -> DataFrame:
        """The links of every key, or of some, as of a version."""
        rows = self._read("links", version)
        on = [c for c in rows.columns if c not in ("transaction_id", _ANEW, _VERSION)]
        rows = _since_anew(rows, on, among)
        return rows.groupBy("_hash", *on).agg(F.min("transaction_id").alias("transaction_id")).drop("_hash")

    def _remastered(self, customers: DataFrame, version: int) -> DataFrame:
        settings = self.settings
        rules, threshold = settings.match_rules, settings.confidence_threshold
        links = self._merged_links(version, customer_keys(customers, rules, threshold))
        links = links.filter(F.col("transaction_id").isNotNull())
        emails = customers.select("normalized_email").filter(F.col("normalized_email").isNotNull())
        facts = self._merged_facts(version, emails).filter("total_transactions > 0")
        crm = customers.drop(*ID_KEY)
        mapping = reconcile_keys(crm, links, rules, threshold, keyed=True)
        merged = merge_facts(crm, facts, mapping, settings)
        return merged.select("*", *id_key("crm_id"))

    # --- what there is --------------------------------------------------------------

    def cleaned(self, table: str, version: int | None = None) -> DataFrame:
        """The newest cleaned row of every customer or transaction."""
        rows = self._read(table, version)
        if rows is None:
            raise ValueError("no batch has been applied yet")
        return _last(rows).drop(_VERSION, *ID_KEY)

    def merged(self, version: int | None = None) -> DataFrame:
        """Every customer's record before derived fields, as of a version."""
        return self.cleaned("merged", version)

    def master(
        self,
        as_of: AsOf = None,
        at: dt.datetime | Column | None = None,
        version: int | None = None,
    ) -> DataFrame:
        """The full mastered record, equal to that of all rows so far in one batch."""
        record = derive(self.merged(version), self.settings, as_of)
        return with_lineage(record, "GOLDEN_RECORD", at)

    def touched_by(self, version: int) -> DataFrame:
        """The records that a batch has written."""
        rows = self._read("merged", version).filter(F.col(_VERSION) == version)
        return rows.drop(_VERSION, *ID_KEY)

    def compact(self, other: str) -> Mastery:
        """The same state as one version in a new folder, so that reads stop growing with
        the number of batches."""
        new, version = Mastery(self.spark, other, self.settings), self.version()
        for table in ("customers", "transactions", "merged"):
            new._append(_last(self._read(table, version)).drop(_VERSION), table, 1)
        for table, rows in (("facts", self._merged_facts(version)), ("links", self._merged_links(version))):
            new._append(rows.withColumn(_ANEW, F.lit(False)), table, 1)
        new._finish(1)
        return new


def apply_all(
    state: Mastery, batches: Sequence[tuple[DataFrame, DataFrame]], at: dt.datetime | None = None
) -> Mastery:
    """The state after a sequence of batches of either feed."""
    for crm_raw, trx_raw in batches:
        state.apply(crm_raw, trx_raw, at)
    return state
