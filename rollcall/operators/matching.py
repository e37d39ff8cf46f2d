"""Linking customers to transactions by exact keys.

Two ways to ask. :func:`match_pairs` and :func:`all_matches` return every pair a
rule finds. :func:`best_match` and :func:`reconcile` need one transaction per
customer and never build the pairs: transactions are first reduced to one row per
rule and key, so a phone number shared by a third of all rows is one row by the
time the two sides meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import all_present, blank_to_null, percentage
from rollcall.operators.keys import ID_KEY, hash_led, id_key
from rollcall.rules import MATCH_RULES, MatchRule
from rollcall.schemas import MAPPING_COLUMNS, PAIR_COLUMNS

_RANK = "_rule_rank"
_SHOWN = "_shown"


def gold_id(customer_id: Column) -> Column:
    return F.concat_ws("_", F.lit("GOLD"), customer_id)


def _key_parts(rule: MatchRule) -> list[Column]:
    columns = [F.col(name) for name in rule.keys]
    return columns if rule.match_blank else [blank_to_null(c) for c in columns]


# --- every pair ---------------------------------------------------------------


def match_pairs(crm: DataFrame, trx: DataFrame, rule: MatchRule) -> DataFrame:
    """All (customer, transaction) pairs that agree on every key of ``rule``."""
    return all_matches(crm, trx, [rule])


def all_matches(
    crm: DataFrame,
    trx: DataFrame,
    rules: Sequence[MatchRule] = MATCH_RULES,
    threshold: float = 0.0,
) -> DataFrame:
    """The pairs of every rule whose confidence reaches ``threshold``.

    All rules share one join. The result is as large as the question makes it: a
    key of many customers and many transactions gives all of their pairs.
    :func:`match_key_counts` tells beforehand how many.
    """
    ranked = _ranked(rules, threshold)
    if not ranked:
        texts = [F.lit(None).cast("string").alias(c) for c in PAIR_COLUMNS[1:-1]]
        score = F.lit(0.0).alias(PAIR_COLUMNS[-1])
        ids = F.col("customer_id").alias(PAIR_COLUMNS[0])
        return crm.select(ids, *texts, score).filter(F.lit(False))
    transactions = _rule_keys(trx, "transaction_id", ranked)
    parts = [c for c in transactions.columns if c != "transaction_id"]
    customers, keys = hash_led(_rule_keys(crm, "customer_id", ranked, shown=True), parts)
    transactions, _ = hash_led(transactions, parts)
    kind, score = _kind_and_score(ranked)
    return customers.join(transactions, keys, "inner").select(
        F.col("customer_id").alias("crm_customer_id"),
        "transaction_id",
        F.col(_SHOWN).alias("match_key"),
        kind.alias("match_type"),
        score.alias("confidence_score"),
    )


def match_key_counts(
    crm: DataFrame,
    trx: DataFrame,
    rules: Sequence[MatchRule] = MATCH_RULES,
    threshold: float = 0.0,
) -> DataFrame:
    """Customers, transactions and pairs of every key that both sides have, per rule.

    Both sides are counted by key before they meet, so that no pair is built.
    """
    ranked = _ranked(rules, threshold)
    if not ranked:
        counts = [F.lit(0).cast("long").alias(c) for c in ("customers", "transactions", "pairs")]
        texts = [F.lit(None).cast("string").alias(c) for c in ("match_type", "match_key")]
        return crm.select(*texts, *counts).filter(F.lit(False))
    customers = _rule_keys(crm, "customer_id", ranked)
    parts = [c for c in customers.columns if c != "customer_id"]

    def counted(df: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
        keyed, keys = hash_led(df, parts)
        return keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), keys

    ours, keys = counted(customers, "customers")
    theirs, _ = counted(_rule_keys(trx, "transaction_id", ranked), "transactions")
    label = F.lit(None).cast("string")
    for rank, rule in enumerate(ranked):
        own = F.concat_ws("|", *parts[1 : 1 + len(rule.keys)])
        label = F.when(F.col(_RANK) == rank, own).otherwise(label)
    return ours.join(theirs, keys, "inner").select(
        _kind_and_score(ranked)[0].alias("match_type"),
        label.alias("match_key"),
        "customers",
        "transactions",
        (F.col("customers") * F.col("transactions")).alias("pairs"),
    )


# --- one transaction per customer ---------------------------------------------


def _ranked(rules: Sequence[MatchRule], threshold: float) -> list[MatchRule]:
    """Rules that reach the threshold, strongest first.

    A rule's confidence is a constant, so weak rules are left out of the plan
    instead of being computed and filtered away.
    """
    kept = [rule for rule in rules if rule.confidence >= threshold]
    return sorted(kept, key=lambda r: (r.confidence, r.priority), reverse=True)


def _rule_keys(
    df: DataFrame, id_column: str, ranked: Sequence[MatchRule], shown: bool = False
) -> DataFrame:
    """One narrow row per rule a row has a complete key for; ``shown`` adds its label.

    All rules share one scan and one shuffle: the rank of the rule is part of the
    key, and rules with fewer key columns are padded with a constant.
    """
    width = max(len(rule.keys) for rule in ranked)
    names = [f"_key{i}" for i in range(width)]

    def entry(rank: int, rule: MatchRule) -> Column:
        parts = [part.cast("string") for part in _key_parts(rule)]
        parts += [F.lit("")] * (width - len(parts))
        label = F.concat_ws("|", *[F.col(c) for c in rule.label_columns])
        return F.struct(
            F.lit(rank).alias(_RANK),
            *[part.alias(name) for part, name in zip(parts, names, strict=True)],
            *([label.alias(_SHOWN)] if shown else []),
        )

    entries = F.array(*[entry(rank, rule) for rank, rule in enumerate(ranked)])
    return df.select(id_column, F.inline(entries)).filter(
        all_present([F.col(name) for name in names])
    )


def lowest_per_key(
    trx: DataFrame, rules: Sequence[MatchRule] = MATCH_RULES, threshold: float = 0.5
) -> DataFrame:
    """The lowest transaction id per rule and key: all that :func:`reconcile` needs of
    the transactions. Two of them merge into one by the minimum per key."""
    ranked = _ranked(rules, threshold)
    transactions = _rule_keys(trx, "transaction_id", ranked)
    parts = [c for c in transactions.columns if c != "transaction_id"]
    keyed, keys = hash_led(transactions, parts)
    return keyed.groupBy(*keys).agg(F.min("transaction_id").alias("transaction_id")).drop(keys[0])


def customer_keys(
    crm: DataFrame, rules: Sequence[MatchRule] = MATCH_RULES, threshold: float = 0.5
) -> DataFrame:
    """customer_id and the keys it has, laid out as in :func:`lowest_per_key`."""
    return _rule_keys(crm, "customer_id", _ranked(rules, threshold))


def _candidates(
    crm: DataFrame, links: DataFrame, ranked: Sequence[MatchRule]
) -> DataFrame:
    """Per customer and rule that matches: rank and lowest transaction id."""
    customers = _rule_keys(crm, "customer_id", ranked)
    parts = [c for c in customers.columns if c != "customer_id"]
    customers, keys = hash_led(customers, parts)
    # A key may belong to very many customers. Spark splits such a partition of a
    # join, but only if both sides were shuffled for that join and nothing else;
    # hashing the reduced keys anew parts it from the shuffle of the aggregate.
    reduced, _ = hash_led(links, parts)
    return customers.join(reduced, keys, "inner").select(
        "customer_id", _RANK, "transaction_id"
    )


def _no_candidates(crm: DataFrame) -> DataFrame:
    return crm.select(
        "customer_id",
        F.lit(0).alias(_RANK),
        F.lit(None).cast("string").alias("transaction_id"),
    ).filter(F.lit(False))


def _strongest(candidates: DataFrame) -> DataFrame:
    """Grouped by what is never NULL, so that a later join on the id, a missing one
    included, finds the rows where they are."""
    best = F.min(F.struct(_RANK, "transaction_id"))
    customer_id = F.when(~F.col("_id_missing"), F.col("_id_text")).alias("customer_id")
    return (
        candidates.select(*id_key("customer_id"), _RANK, "transaction_id")
        .groupBy(*ID_KEY)
        .agg(best.alias("_best"))
        .select(*ID_KEY, customer_id, f"_best.{_RANK}", "_best.transaction_id")
    )


def _kind_and_score(ranked: Sequence[MatchRule]) -> tuple[Column, Column]:
    """Name and confidence of the rule of a rank."""
    kind, score = F.lit(None).cast("string"), F.lit(0.0)
    for rank, rule in enumerate(ranked):
        here = F.col(_RANK) == rank
        kind = F.when(here, rule.name).otherwise(kind)
        score = F.when(here, float(rule.confidence)).otherwise(score)
    return kind, score


def _as_mapping(
    best: DataFrame, ranked: Sequence[MatchRule], extra: Sequence[str] = ()
) -> DataFrame:
    kind, score = _kind_and_score(ranked)
    return best.select(
        F.col("customer_id").alias("crm_customer_id"),
        "transaction_id",
        kind.alias("match_type"),
        score.alias("confidence_score"),
        gold_id(F.col("customer_id")).alias("gold_customer_id"),
        *extra,
    ).select(*MAPPING_COLUMNS, *extra)


def best_match(
    crm: DataFrame,
    trx: DataFrame,
    rules: Sequence[MatchRule] = MATCH_RULES,
    threshold: float = 0.5,
) -> DataFrame:
    """The strongest match of every customer that has one.

    Confidence decides, then the rule's priority, then the lowest transaction id.
    """
    ranked = _ranked(rules, threshold)
    if not ranked:
        return _as_mapping(_strongest(_no_candidates(crm)), ranked)
    links = lowest_per_key(trx, rules, threshold)
    return _as_mapping(_strongest(_candidates(crm, links, ranked)), ranked)


def unmatched_customers(crm: DataFrame, matched: DataFrame) -> DataFrame:
    """Customers that do not appear in ``matched``, in mapping layout."""
    known = matched.select(*id_key("crm_customer_id"))
    alone = crm.select("customer_id", *id_key("customer_id")).join(
        known, list(ID_KEY), "left_anti"
    )
    return _as_mapping(
        alone.withColumns(
            {_RANK: F.lit(None).cast("int"), "transaction_id": F.lit(None).cast("string")}
        ),
        [],
    )


def reconcile(
    crm: DataFrame,
    trx: DataFrame,
    rules: Sequence[MatchRule] = MATCH_RULES,
    threshold: float = 0.5,
    keyed: bool = False,
) -> DataFrame:
    """One row per customer: the strongest match, or none with confidence 0.

    Every customer also enters as a "no match" candidate of the weakest rank.
    Picking the strongest candidate then keeps unmatched customers, without an
    anti join and a union of its result. ``keyed`` adds the columns the rows are
    grouped by, which saves :func:`~rollcall.operators.mastering.survivorship`
    their shuffle.
    """
    links = lowest_per_key(trx, rules, threshold) if _ranked(rules, threshold) else None
    return reconcile_keys(crm, links, rules, threshold, keyed)


def reconcile_keys(
    crm: DataFrame,
    links: DataFrame | None,
    rules: Sequence[MatchRule] = MATCH_RULES,
    threshold: float = 0.5,
    keyed: bool = False,
) -> DataFrame:
    """:func:`reconcile` with transactions that :func:`lowest_per_key` has reduced."""
    ranked = _ranked(rules, threshold)
    found = crm.select(
        "customer_id",
        F.lit(len(ranked)).alias(_RANK),
        F.lit(None).cast("string").alias("transaction_id"),
    )
    if ranked:
        found = _candidates(crm, links, ranked).unionByName(found)
    return _as_mapping(_strongest(found), ranked, ID_KEY if keyed else ())


# --- figures ------------------------------------------------------------------


def match_stats(mapping: DataFrame) -> DataFrame:
    """Customers and share of all customers per match type (NULL: unmatched)."""
    counts = mapping.groupBy("match_type").agg(F.count(F.lit(1)).alias("count"))
    # One row per match type by now, so the grand total is a tiny sum.
    total = F.sum("count").over(Window.partitionBy()).alias("total")
    return counts.select("match_type", "count", total).select(
        "match_type", "count", percentage("count", "total").alias("percentage")
    )


def match_rate(mapping: DataFrame) -> DataFrame:
    """Matched customers, all customers and the matched share in percent."""
    totals = mapping.agg(
        F.count("match_type").alias("matched"), F.count(F.lit(1)).alias("total")
    )
    return totals.withColumn("match_rate", percentage("matched", "total"))
