"""Feeds in, layers and reports out."""

from rollcall.sources.feeds import Sifted, read_crm, read_sifted, read_transactions, write_feed
from rollcall.sources.layers import write_analytics, write_master, write_report
from rollcall.sources.scratch import Scratch

__all__ = [
    "Scratch",
    "Sifted",
    "read_crm",
    "read_sifted",
    "read_transactions",
    "write_analytics",
    "write_feed",
    "write_master",
    "write_report",
]
