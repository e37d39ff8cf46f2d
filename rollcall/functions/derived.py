"""Fields derived from a mastered row."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.rules import LOWEST_BAND, QUALITY_BANDS, SCORE_RULES, ScoreRule

AsOf = dt.date | Column | None


def reference_day(as_of: AsOf = None) -> Column:
    """The day ages are measured from: today unless pinned."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def percentage(part: Column | str, whole: Column | str) -> Column:
    """``100 * part / whole`` to two places; 0 when there is nothing to divide by."""
    part, whole = (F.col(x) if isinstance(x, str) else x for x in (part, whole))
    return F.when(whole > 0, F.round(part * 100 / whole, 2)).otherwise(0.0)


def match_quality(confidence: Column) -> Column:
    """Band of a confidence; lower bounds are inclusive."""
    (first_bound, first_name), *others = QUALITY_BANDS
    band = F.when(confidence >= first_bound, first_name)
    for bound, name in others:
        band = band.when(confidence >= bound, name)
    return band.otherwise(LOWEST_BAND)


def tenure_days(registered: Column, as_of: AsOf = None) -> Column:
    return F.date_diff(reference_day(as_of), registered)


def tenure_months(registered: Column, as_of: AsOf = None) -> Column:
    return F.round(F.months_between(reference_day(as_of), registered), 1)


def is_active(last_purchase: Column, as_of: AsOf = None, days: int = 365) -> Column:
    """Whether the last purchase is at most ``days`` old; never NULL."""
    age = F.date_diff(reference_day(as_of), last_purchase)
    return F.coalesce(age <= days, F.lit(False))


def data_quality_score(rules: Sequence[ScoreRule] = SCORE_RULES) -> Column:
    """Sum of the points each field earns."""

    def points(rule: ScoreRule) -> Column:
        value = F.col(rule.field)
        earned = value.isNotNull() if rule.prefix is None else value.startswith(rule.prefix)
        return F.when(earned, rule.points).otherwise(rule.otherwise)

    return reduce(lambda a, b: a + b, [points(rule) for rule in rules])
