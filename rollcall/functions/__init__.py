"""``Column`` builders."""

from rollcall.functions.contact import (
    all_present,
    blank_to_null,
    email,
    phone,
)
from rollcall.functions.dates import parse_date
from rollcall.functions.derived import (
    data_quality_score,
    is_active,
    match_quality,
    percentage,
    reference_day,
    tenure_days,
    tenure_months,
)

__all__ = [
    "all_present",
    "blank_to_null",
    "data_quality_score",
    "email",
    "is_active",
    "match_quality",
    "parse_date",
    "percentage",
    "phone",
    "reference_day",
    "tenure_days",
    "tenure_months",
]
