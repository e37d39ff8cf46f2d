"""Linking by names that are nearly the same.

Two names within one edit of each other share a *variant*: a name itself, or it without
one of its characters. Within two edits they share one of two characters less, and so on.
Variants are joined by equality, and what meets is verified by its edit distance, so no
name is compared with all others. Both sides are reduced to distinct names first: a
name of a third of all rows is one row of either side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import all_present, blank_to_null
from rollcall.operators.keys import hash_led

PLACE = ("city", "country")


def full_name(parts: Sequence[str] = ("first_name", "last_name")) -> Column:
    """The parts in lower case, joined by a space; NULL if one is missing or blank."""
    present = [blank_to_null(F.col(part)) for part in parts]
    return F.when(all_present(present), F.lower(F.concat_ws(" ", *parts)))


def variants(name: Column, edits: int) -> Column:
    """The name and what is left of it without up to ``edits`` characters, each once."""
    found = F.array(name)
    for _ in range(edits):

        def shorter(text: Column) -> Column:
            places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
            return F.transform(places, lambda k: F.concat(text.substr(F.lit(1), k - 1), text.substr(k + 1, F.length(text))))

        found = F.array_distinct(F.flatten(F.array(found, F.flatten(F.transform(found, shorter)))))
    return found


def near_names(ours: DataFrame, theirs: DataFrame, edits: int = 1, place: Sequence[str] = PLACE) -> DataFrame:
    """Pairs of distinct names in one place within ``edits`` edits: our name, their name, edits.

    Both frames have ``name`` and the columns of ``place``; a row that lacks one of them
    matches nothing. Characters count as they are, case included.
    """

    def distinct(df: DataFrame, alias: str) -> tuple[DataFrame, list[str]]:
        named = df.select("name", *place).filter(all_present([F.col(c) for c in ("name", *place)])).distinct()
        named = named.withColumnRenamed("name", alias).withColumn("_variant", F.explode(variants(F.col(alias), edits)))
        return hash_led(named, ["_variant", *place])

    our, keys = distinct(ours, "name")
    their, _ = distinct(theirs, "other_name")
    met = our.join(their, keys, "inner").select("name", "other_name", *place).distinct()
    distance = F.levenshtein("name", "other_name", edits)
    return met.withColumn("edits", distance).filter(F.col("edits") >= 0)


def fuzzy_match(
    crm: DataFrame,
    trx: DataFrame,
    edits: int = 1,
    parts: Sequence[str] = ("first_name", "last_name"),
    place: Sequence[str] = PLACE,
) -> DataFrame:
    """The transaction of every customer whose name, in the same place, is nearest to the customer's.

    Fewest edits decide, then the lowest transaction id. Transactions are reduced to the
    lowest id per name before they meet any customer; no pairs are built of names that
    many rows share.
    """
    keys = ["name", *place]
    customers = crm.select("customer_id", full_name(parts).alias("name"), *[blank_to_null(F.col(c)).alias(c) for c in place])
    bought = trx.select("transaction_id", full_name(parts).alias("name"), *[blank_to_null(F.col(c)).alias(c) for c in place])
    keyed, led = hash_led(bought.filter(all_present([F.col(c) for c in keys])), keys)
    lowest = keyed.groupBy(*led).agg(F.min("transaction_id").alias("transaction_id")).drop(led[0])
    pairs = near_names(customers, lowest, edits, place)
    their, led = hash_led(lowest.withColumnRenamed("name", "other_name"), ["other_name", *place])
    pairs, _ = hash_led(pairs, ["other_name", *place])
    best, led = hash_led(pairs.join(their, led, "inner").select(*keys, "edits", "transaction_id"), keys)
    best = best.groupBy(*led).agg(F.min(F.struct("edits", "transaction_id")).alias("_best"))
    # A name may be that of very many customers: hashed anew, Spark can split its partition.
    best, led = hash_led(best.select(*keys, "_best.*"), keys)
    customers, _ = hash_led(customers, keys)
    return customers.join(best, led, "inner").select(
        F.col("customer_id").alias("crm_customer_id"), "transaction_id", F.col("name").alias("match_key"), "edits"
    )
