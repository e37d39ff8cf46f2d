"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.tables import Workspace


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex moves to the smallest one around."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a").where("b > a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours move to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _is_star_forest(links: DataFrame) -> bool:
    """Whether everyone has one smaller neighbour, which has none itself."""
    ends = links.select(F.col("a").alias("id"), F.lit(1).alias("smaller"), F.lit(0).alias("larger"))
    ends = ends.unionByName(links.select(F.col("b").alias("id"), F.lit(0).alias("smaller"), F.lit(1).alias("larger")))
    counts = ends.groupBy("id").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return counts.where("smaller > 1 or smaller = 1 and larger = 1").isEmpty()


def components(links: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """(id, component) of every vertex that has a link and isn't its component's smallest.

    ``links`` has columns a, b of one type, in any order, repeated or not. Alternating
    large and small stars (Kiveris et al. 2014) reach one star per component in a
    number of rounds that grows with the logarithm of its size. Minima are combined
    before the shuffle; no vertex's neighbours meet in one task.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    links, step = work.write(links.distinct(), f"{name}-0"), 0
    while not _is_star_forest(links):
        step += 1
        links = work.write(_small_star(_large_star(links)).distinct(), f"{name}-{step}")
        work.remove(f"{name}-{step - 1}")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
