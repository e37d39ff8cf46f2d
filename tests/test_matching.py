from __future__ import annotations

import random
from dataclasses import replace

import pytest

from rollcall import operators as op
from rollcall.rules import MATCH_RULES, MatchRule
from rollcall.schemas import MAPPING_COLUMNS, PAIR_COLUMNS

EMAIL, PHONE, NAME = MATCH_RULES
FULL = ("e@mail.com", "+447911000001", "Ann", "Lee", "Leeds", "UK")
EMPTY = (None,) * 6


def test_each_rule_finds_its_pairs(customers, transactions):
    crm = customers(("C1", *FULL))
    trx = transactions(
        ("T1", "e@mail.com", *EMPTY[1:]),
        ("T2", None, "+447911000001", *EMPTY[2:]),
        ("T3", None, None, "Ann", "Lee", "Leeds", "UK"),
        ("T4", None, None, "ann", "Lee", "Leeds", "UK"),  # case matters
        ("T5", None, None, "Ann", "Lee", "Leeds", None),
    )
    rows = {
        rule.name: [tuple(r) for r in op.match_pairs(crm, trx, rule).collect()]
        for rule in MATCH_RULES
    }
    assert rows == {
        "email": [("C1", "T1", "e@mail.com", "email", 1.0)],
        "phone": [("C1", "T2", "+447911000001", "phone", 0.8)],
        "name_address": [("C1", "T3", "Ann|Lee|Leeds", "name_address", 0.6)],
    }
    assert op.match_pairs(crm, trx, EMAIL).columns == list(PAIR_COLUMNS)


def test_all_pairs_are_returned(customers, transactions):
    crm = customers(("C1", *FULL), ("C2", *FULL))
    trx = transactions(("T1", *FULL), ("T2", *FULL))
    assert op.match_pairs(crm, trx, EMAIL).count() == 4
    assert op.all_matches(crm, trx).count() == 12
    assert op.all_matches(crm, trx, threshold=0.7).count() == 8
    assert op.all_matches(crm, trx, threshold=2.0).count() == 0


def test_missing_and_blank_keys_never_match(customers, transactions):
    crm = customers(("C1", *EMPTY), ("C2", "", " ", "", "", "", ""))
    trx = transactions(("T1", *EMPTY), ("T2", "", " ", "", "", "", ""))
    assert op.all_matches(crm, trx).count() == 0
    assert {r.match_type for r in op.reconcile(crm, trx).collect()} == {None}
    loose = replace(EMAIL, match_blank=True)
    assert op.match_pairs(crm, trx, loose).count() == 1


def test_confidence_is_inclusive(customers, transactions):
    crm, trx = customers(("C1", None, *FULL[1:2], *EMPTY[2:])), transactions(("T1", *FULL))
    assert op.best_match(crm, trx, threshold=0.8).first().match_type == "phone"
    assert op.best_match(crm, trx, threshold=0.9).count() == 0
    assert op.reconcile(crm, trx, threshold=0.9).first().match_type is None
    assert op.reconcile(crm, trx, threshold=5.0).first().confidence_score == 0.0


def test_strongest_rule_wins(customers, transactions):
    crm = customers(("C1", *FULL))
    trx = transactions(
        ("T1", None, *FULL[1:]), ("T2", FULL[0], *EMPTY[1:]), ("T3", FULL[0], *EMPTY[1:])
    )
    rows = op.reconcile(crm, trx).collect()
    assert [tuple(r) for r in rows] == [("C1", "T2", "email", 1.0, "GOLD_C1")]


def test_priority_breaks_equal_confidence(customers, transactions):
    crm, trx = customers(("C1", *FULL)), transactions(("T2", *FULL), ("T1", None, *FULL[1:]))
    level = [replace(rule, confidence=0.7) for rule in MATCH_RULES]
    assert op.best_match(crm, trx, level).first().match_type == "email"
    swapped = [replace(rule, priority=-rule.priority) for rule in level]
    best = op.best_match(crm, trx, swapped).first()
    assert (best.match_type, best.transaction_id) == ("name_address", "T1")


def test_unmatched_customers_are_kept(customers, transactions):
    crm = customers(("C1", *FULL), ("C2", "x@mail.com", *EMPTY[1:]))
    trx = transactions(("T1", *FULL))
    rows = {r.crm_customer_id: tuple(r) for r in op.reconcile(crm, trx).collect()}
    assert rows["C2"] == ("C2", None, None, 0.0, "GOLD_C2")
    alone = op.unmatched_customers(crm, op.best_match(crm, trx))
    assert [tuple(r) for r in alone.collect()] == [rows["C2"]]
    assert alone.columns == list(MAPPING_COLUMNS)


def test_one_transaction_may_serve_many_customers(customers, transactions):
    crm = customers(("C1", *FULL), ("C2", *FULL))
    rows = op.reconcile(crm, transactions(("T1", *FULL))).collect()
    assert [r.transaction_id for r in rows] == ["T1", "T1"]


def test_customer_without_id_is_one_row(customers, transactions):
    crm = customers((None, *FULL))
    rows = op.reconcile(crm, transactions(("T1", *FULL))).collect()
    assert [tuple(r) for r in rows] == [(None, "T1", "email", 1.0, "GOLD")]


def test_empty_inputs(customers, transactions):
    nobody, nothing = customers(("C", *EMPTY)).filter("false"), transactions(("T", *FULL)).filter("false")
    mapping = op.reconcile(nobody, nothing)
    assert mapping.count() == 0
    assert op.match_stats(mapping).count() == 0
    assert op.match_stats(mapping).dtypes == [
        ("match_type", "string"), ("count", "bigint"), ("percentage", "double"),
    ]
    rate = op.match_rate(mapping).first()
    assert (rate.matched, rate.total, rate.match_rate) == (0, 0, 0.0)


def test_stats(customers, transactions):
    crm = customers(("C1", *FULL), ("C2", *EMPTY), ("C3", *EMPTY))
    mapping = op.reconcile(crm, transactions(("T1", *FULL)))
    stats = {r["match_type"]: (r["count"], r["percentage"]) for r in op.match_stats(mapping).collect()}
    assert stats == {"email": (1, 33.33), None: (2, 66.67)}
    assert op.match_rate(mapping).first().match_rate == 33.33


def brute_best(crm, trx):
    """Every pair, ranked."""
    best = {}
    for customer in crm:
        found = []
        for transaction in trx:
            for rule, at in ((EMAIL, (1,)), (PHONE, (2,)), (NAME, (3, 4, 5, 6))):
                key = [customer[i] for i in at]
                if all(key) and key == [transaction[i] for i in at]:
                    found.append((-rule.confidence, transaction[0], rule.name))
        _, txn, kind = min(found, default=(0, None, None))
        best[customer[0]] = (txn, kind)
    return best


@pytest.mark.parametrize("hot", [False, True])
def test_reduction_equals_ranking_all_pairs(customers, transactions, hot):
    chance = random.Random(11)

    def row(prefix, n):
        def pick(kind, spread):
            if hot and chance.random() < 0.33:
                return f"{kind}-hot"
            return chance.choice([None, "", f"{kind}{chance.randint(0, spread)}"])

        return (f"{prefix}{n:04d}", pick("e", 60), pick("p", 60), pick("f", 3),
                pick("l", 3), pick("c", 2), pick("k", 1))

    crm, trx = [row("C", n) for n in range(150)], [row("T", n) for n in range(300)]
    chance.shuffle(trx)
    mapping = op.reconcile(customers(*crm), transactions(*trx)).collect()
    got = {r.crm_customer_id: (r.transaction_id, r.match_type) for r in mapping}
    assert got == brute_best(crm, trx)
    assert len(mapping) == len(crm)


def test_keys_with_separators_stay_apart(customers, transactions):
    crm = customers(("C1", None, None, "A|B", "C", "X", "UK"))
    trx = transactions(("T1", None, None, "A", "B|C", "X", "UK"))
    assert op.best_match(crm, trx).count() == 0


def test_other_rules_can_be_given(customers, transactions):
    rule = MatchRule("surname", ("last_name", "country"), confidence=0.55, priority=0)
    crm = customers(("C1", None, None, "Ann", "Lee", None, "UK"))
    trx = transactions(("T1", None, None, "Bob", "Lee", None, "UK"))
    assert op.best_match(crm, trx, [*MATCH_RULES, rule]).first().match_type == "surname"
    assert op.match_pairs(crm, trx, rule).first().match_key == "Lee|UK"
