"""``DataFrame`` steps."""

from rollcall.operators.cleaning import (
    clean_crm,
    clean_transactions,
    latest_per_key,
    tidy_crm,
    tidy_transactions,
    with_lineage,
)
from rollcall.operators.fuzzy import fuzzy_match, near_names
from rollcall.operators.history import at_moment, changes, first_history, next_history
from rollcall.operators.households import households, hub_links
from rollcall.operators.mastering import (
    analytics_view,
    build_master,
    derive,
    master_sample,
    survivorship,
)
from rollcall.operators.matching import (
    all_matches,
    best_match,
    match_key_counts,
    match_pairs,
    match_rate,
    match_stats,
    reconcile,
    unmatched_customers,
)
from rollcall.operators.profiling import (
    completeness,
    freshness,
    profile,
    profile_lines,
    row_count,
    uniqueness,
    validity,
)
from rollcall.operators.purchases import aggregate_transactions, latest_transaction

__all__ = [
    "aggregate_transactions",
    "all_matches",
    "analytics_view",
    "at_moment",
    "best_match",
    "build_master",
    "changes",
    "clean_crm",
    "clean_transactions",
    "completeness",
    "derive",
    "first_history",
    "freshness",
    "fuzzy_match",
    "households",
    "hub_links",
    "latest_per_key",
    "latest_transaction",
    "master_sample",
    "match_key_counts",
    "match_pairs",
    "match_rate",
    "match_stats",
    "near_names",
    "next_history",
    "profile",
    "profile_lines",
    "reconcile",
    "row_count",
    "survivorship",
    "tidy_crm",
    "tidy_transactions",
    "uniqueness",
    "unmatched_customers",
    "validity",
    "with_lineage",
]
