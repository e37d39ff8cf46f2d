"""Tolerant date parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.rules import DATE_FORMATS


def parse_date(value: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits, strictly; NULL if none does."""
    attempts = []
    for pattern in formats:
        parsed = F.try_to_date(value, pattern)
        # A failed parse costs an exception inside the JVM. Text that lacks the
        # separators of a format cannot fit it, so it is not even tried. Quoted and
        # optional parts may hold separators that the text need not show.
        if not set("'[]") & set(pattern):
            for separator in sorted({c for c in pattern if not c.isalnum()}):
                parsed = F.when(value.contains(separator), parsed)
        attempts.append(parsed)
    return F.coalesce(*attempts)
