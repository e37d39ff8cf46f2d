"""From two raw feeds to published layers."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rollcall.functions.derived import AsOf
from rollcall.operators import (
    build_master,
    clean_crm,
    clean_transactions,
    match_stats,
    profile,
    reconcile,
)
from rollcall.rules import Settings
from rollcall.schemas import MAPPING_COLUMNS
from rollcall.sources import Scratch, write_analytics, write_master, write_report


@dataclass(frozen=True)
class Mastered:
    """The frames of one run; lazy, from staged feeds if there are any."""

    crm: DataFrame
    transactions: DataFrame
    mapping: DataFrame
    master: DataFrame


@dataclass(frozen=True)
class Published:
    """What a run has written, read back from where it was written."""

    master: DataFrame
    analytics: DataFrame
    stats: DataFrame
    reports: tuple[str, ...]


def master_feeds(
    crm_raw: DataFrame,
    trx_raw: DataFrame,
    settings: Settings = Settings(),
    as_of: AsOf = None,
    at: dt.datetime | None = None,
    scratch: Scratch | None = None,
) -> Mastered:
    """Clean both feeds, link them and build the mastered record.

    With ``scratch`` the cleaned feeds are staged there first. Do that when more
    than one action follows: parsing and deduplicating the feeds then happens
    once, and survives the loss of executors. The frames can be used until the
    scratch tables are removed.
    """
    crm = clean_crm(crm_raw, settings, at)
    trx = clean_transactions(trx_raw, settings, at)
    if scratch:
        crm, trx = scratch.stage(crm, "crm"), scratch.stage(trx, "transactions")
    mapping = reconcile(
        crm, trx, settings.match_rules, settings.confidence_threshold, keyed=True
    )
    master = build_master(crm, trx, mapping, settings, as_of, at)
    return Mastered(crm, trx, mapping.select(*MAPPING_COLUMNS), master)


def publish(
    run: Mastered,
    layer_folder: str,
    report_folder: str,
    settings: Settings = Settings(),
    at: dt.datetime | None = None,
) -> Published:
    """Write both layers and the three quality reports.

    The mastered record is computed once, by the write of the full layer. The
    analyst layer, the report on the mastered record and the match statistics all
    read that layer back.
    """
    at = at or dt.datetime.now()
    reports = [
        write_report(profile(df, name, settings.profile, at), report_folder, name, at)
        for name, df in (("CRM", run.crm), ("TRX", run.transactions))
    ]
    master = write_master(run.master, layer_folder)
    analytics = write_analytics(master, layer_folder)
    reports.append(
        write_report(
            profile(master, "GOLDEN", settings.profile, at), report_folder, "GOLDEN", at
        )
    )
    return Published(master, analytics, match_stats(master), tuple(reports))
