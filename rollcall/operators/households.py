"""Customers that belong together: connected over keys they share.

A key's customers are linked to the smallest of them, its hub, never to each other, so a
key of a third of all customers gives as many links as it has customers. The links are
then gathered into one star per household by alternating two steps (Kiveris et al.
2014): everyone links its larger neighbours, then its smaller ones, to the smallest of all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.keys import hash_led
from rollcall.operators.matching import customer_keys
from rollcall.rules import MatchRule
from rollcall.sources.scratch import Scratch

# What people of one household share.
HOUSEHOLD_RULES = (
    MatchRule("phone", ("normalized_phone",), confidence=1.0, priority=2),
    MatchRule("address", ("address", "city", "country"), confidence=1.0, priority=1),
)


def hub_links(crm: DataFrame, rules: Sequence[MatchRule] = HOUSEHOLD_RULES) -> DataFrame:
    """(member, hub) for every customer and key of it that a smaller customer id has, too.

    Missing and blank key parts link nobody; customers without an id have no links.
    """
    keys = customer_keys(crm.filter(F.col("customer_id").isNotNull()), rules, 0.0)
    parts = [c for c in keys.columns if c != "customer_id"]
    keyed, led = hash_led(keys, parts)
    hubs = keyed.groupBy(*led).agg(F.min("customer_id").alias("hub")).drop(led[0])
    # Hashed anew, so that Spark can split the partition of a key with very many customers.
    hubs, _ = hash_led(hubs, parts)
    met = keyed.join(hubs, led, "inner").filter(F.col("customer_id") > F.col("hub"))
    return met.select(F.col("customer_id").alias("member"), "hub").distinct()


def _to_smallest(links: DataFrame, both: bool) -> DataFrame:
    """Each end's neighbours, all larger ones (``both``) or the smaller ones, linked to the smallest around."""
    near = links.select(F.col("member").alias("end"), F.col("hub").alias("other"))
    if both:
        near = near.unionByName(links.select(F.col("hub").alias("end"), F.col("member").alias("other")))
    least = near.groupBy("end").agg(F.min("other").alias("least"))
    least = least.select("end", F.least("end", "least").alias("least"))
    met = near.join(least, "end")
    if both:
        moved = met.filter("other > end").select(F.col("other").alias("member"), F.col("least").alias("hub"))
    else:
        moved = met.select(F.col("other").alias("member"), F.col("least").alias("hub"))
        moved = moved.unionByName(least.select(F.col("end").alias("member"), F.col("least").alias("hub")))
    return moved.filter("member <> hub").distinct()


def _gathered(links: DataFrame) -> bool:
    """Whether every member has one hub, which is no member."""
    ends = links.groupBy(F.col("member").alias("end")).agg(F.count("*").alias("hubs"))
    hubs = links.select(F.col("hub").alias("end")).distinct()
    return ends.filter("hubs > 1").isEmpty() and hubs.join(ends, "end", "left_semi").isEmpty()


def households(
    crm: DataFrame, scratch: Scratch, rules: Sequence[MatchRule] = HOUSEHOLD_RULES
) -> DataFrame:
    """customer_id, household_id and members of every customer.

    household_id is the smallest id that a customer is connected with over shared keys, its own
    included, and members how many customers have that id. A customer without an id is a
    household of its own, without a name. Rounds grow with the logarithm of the longest
    chain; each is written to ``scratch``.
    """
    links, step = scratch.stage(hub_links(crm, rules), "household_links_0"), 0
    while not _gathered(links):
        step += 1
        links = scratch.stage(_to_smallest(_to_smallest(links, True), False), f"household_links_{step}")
    ids = crm.select("customer_id")
    named = ids.join(links.withColumnRenamed("member", "customer_id"), "customer_id", "left")
    named = named.select("customer_id", F.coalesce("hub", "customer_id").alias("household_id"))
    sizes = named.groupBy("household_id").agg(F.count("*").alias("members"))
    sizes = sizes.filter(F.col("household_id").isNotNull())
    counted = named.join(sizes, "household_id", "left")
    return counted.select("customer_id", "household_id", F.coalesce("members", F.lit(1)).alias("members"))
