from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from rollcall import operators as op
from rollcall.operators.fuzzy import full_name, variants


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_variants(spark):
    df = spark.createDataFrame([("abca",), ("a",), ("",)], "n string")
    got = [sorted(r[0]) for r in df.select(variants(F.col("n"), 1)).collect()]
    assert got == [["aba", "abc", "abca", "aca", "bca"], ["", "a"], [""]]
    two = df.limit(1).select(variants(F.col("n"), 2)).first()[0]
    assert {"ab", "bc", "ca", "aa", "ba", "ac"} < set(two)


@pytest.mark.parametrize("most", [1, 2])
def test_near_names_equal_all_pairs(spark, most):
    chance = random.Random(most)
    word = lambda: "".join(chance.choice("aBcé") for _ in range(chance.randint(0, 6)))
    sides = [[(chance.choice([None, word(), word(), word()]), chance.choice(["x", "y", None]), "k") for _ in range(150)] for _ in "ab"]
    frames = [spark.createDataFrame(rows, "name string, city string, country string") for rows in sides]
    want = {
        (a[0], b[0], a[1], a[2], edits(a[0], b[0]))
        for a, b in itertools.product(*sides)
        if None not in (*a, *b) and a[1:] == b[1:] and edits(a[0], b[0]) <= most
    }
    got = [(r.name, r.other_name, r.city, r.country, r.edits) for r in op.near_names(*frames, most).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_fuzzy_match_takes_the_nearest_and_lowest(customers, transactions):
    crm = customers(
        ("C1", None, None, "Jon", "Smith", "Leeds", "UK"), ("C2", None, None, "Ann", "Lee", "Leeds", "UK"),
        ("C3", None, None, " ", "Lee", "Leeds", "UK"), (None, None, None, "JON", "smith", "Leeds", "UK"),
    )
    trx = transactions(
        ("T3", None, None, "John", "Smith", "Leeds", "UK"), ("T2", None, None, "John", "Smith", "Leeds", "UK"),
        ("T1", None, None, "Jonas", "Smith", "Leeds", "UK"), ("T5", None, None, "Ann", "Lee", "York", "UK"),
        ("T6", None, None, "Ann", "Lee", "Leeds", "UK"), ("T0", None, None, "Anna", "Lee", "Leeds", "UK"),
    )
    got = {r.crm_customer_id: (r.transaction_id, r.edits) for r in op.fuzzy_match(crm, trx).collect()}
    assert got == {"C1": ("T2", 1), None: ("T2", 1), "C2": ("T6", 0)}


def test_no_cross_join_and_no_pairs_of_a_hot_name(spark):
    rows = [(str(k), "Ann", "Lee", "Leeds", "UK") for k in range(3000)]
    crm = spark.createDataFrame(rows, "customer_id string, first_name string, last_name string, city string, country string")
    trx = crm.withColumnRenamed("customer_id", "transaction_id")
    found = op.fuzzy_match(crm, trx)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 3000
    assert crm.select(full_name()).distinct().count() == 1
