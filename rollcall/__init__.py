"""Customer mastering on Spark: clean two feeds, link them, merge them.

The package is organised by what a caller composes:

* ``rollcall.functions``  - ``Column`` builders (contact details, dates, scores)
* ``rollcall.operators``  - ``DataFrame`` -> ``DataFrame`` steps
* ``rollcall.sources``    - CSV feeds in, Parquet layers and JSON reports out
* ``rollcall.plans``      - the whole batch, wired together
"""

from rollcall.rules import (
    FieldRule,
    MatchRule,
    PhoneRegion,
    ProfileSpec,
    ScoreRule,
    Settings,
)

__all__ = [
    "FieldRule",
    "MatchRule",
    "PhoneRegion",
    "ProfileSpec",
    "ScoreRule",
    "Settings",
]
