from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rollcall import operators as op
from rollcall.rules import MatchRule
from rollcall.sources import Scratch

RULES = (MatchRule("phone", ("normalized_phone",), 1.0, 2), MatchRule("email", ("normalized_email",), 1.0, 1))


def found(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "customer_id string, normalized_phone string, normalized_email string")
    with Scratch(spark, str(tmp_path)) as scratch:
        got = op.households(df, scratch, RULES).collect()
    return sorted((repr(r.customer_id), r.household_id, r.members) for r in got)


def brute(rows):
    names = {c: c for c, *_ in rows if c is not None}
    while True:
        before = dict(names)
        for at in (1, 2):
            least = {}
            for row in rows:
                if row[0] is not None and (row[at] or "").strip():
                    least[row[at]] = min(least.get(row[at], names[row[0]]), names[row[0]])
            for row in rows:
                if row[0] is not None and (row[at] or "").strip():
                    names[row[0]] = min(names[row[0]], least[row[at]])
        if names == before:
            break
    members = list(names.values())
    own = [(repr(c), names.get(c), members.count(names[c]) if c is not None else 1) for c, *_ in rows]
    return sorted(own, key=lambda r: (r[0], r[1] or "", r[2]))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(spark, tmp_path, seed):
    chance = random.Random(seed)
    pick = lambda kind, n: chance.choice([None, "", " ", *(f"{kind}{chance.randint(0, n)}" for _ in range(4))])
    rows = [(f"C{k:03}", pick("p", 60), pick("e", 60)) for k in chance.sample(range(900), 120)] + [(None, "p1", "e1")]
    assert found(spark, tmp_path, rows) == brute(rows)


def test_a_long_chain(spark, tmp_path):
    rows = [(f"C{k:03}", f"p{k // 2}", f"e{(k + 1) // 2}") for k in range(120)]
    random.Random(3).shuffle(rows)
    assert {(home, n) for _, home, n in found(spark, tmp_path, rows)} == {("C000", 120)}


def test_a_hot_key_gives_a_link_per_customer(spark):
    df = spark.range(2000).select(
        F.format_string("C%05d", "id").alias("customer_id"), F.concat(F.lit("p"), F.col("id") * 0).alias("normalized_phone"),
        F.lit(None).cast("string").alias("normalized_email"),
    )
    links = op.hub_links(df, RULES)
    assert links.count() == 1999 and links.select("hub").distinct().count() == 1


def test_no_customers_and_no_keys(spark, tmp_path):
    assert found(spark, tmp_path, [("C1", None, ""), (None, None, None)]) == [("'C1'", "C1", 1), ("None", None, 1)]
