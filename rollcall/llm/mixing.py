"""Mix sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source's target is cut into blocks of ``block`` words. Blocks are seats: sources
receive them by highest quotients, and each source's seats go to its shards the same way,
which gives every (source, shard) an integer quota. Within a shard, documents lie in a
seeded order; whole passes are taken first, and the rest of the quota are consecutive
blocks from a seeded start, around the end if need be. Only DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.tables import Workspace

#: Words of a block, shards of every source, and how often a text may be taken.
BLOCK = 32
SHARDS = 256
REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def apportioned(cells: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """Column ``seats`` of each cell: Sainte-Laguë's highest quotients of ``votes``.

    ``cells`` has votes (0 or more) and total, the seats to give in the cell's group. A
    cell holds votes / (total votes / total), give or take the group's number of cells
    over total of itself, and a few; only these contested seats are ranked by their
    quotients votes / (2k + 1). ``order`` decides between equal quotients.
    """
    whole = Window.partitionBy(*group)
    cells = cells.withColumns({"_sum": F.sum("votes").over(whole), "_cells": F.count("*").over(whole)})
    even = F.when(F.col("_sum") > 0, F.col("votes") * F.col("total") / F.col("_sum")).otherwise(0.0)
    spread = F.ceil(even * F.col("_cells") / F.greatest(F.col("total"), F.lit(1))) + 2
    cells = cells.withColumn("_even", F.floor(even))
    cells = cells.withColumn("_sure", F.greatest(F.lit(0), F.col("_even") - spread).cast("long"))
    cells = cells.withColumn("_last", (F.col("_even") + spread).cast("long"))
    cells = cells.withColumn("_open", F.col("total") - F.sum("_sure").over(whole))
    seats = cells.select(
        "*", F.explode(F.sequence("_sure", "_last")).alias("_seat")
    ).withColumn("_quotient", F.col("votes") / (2 * F.col("_seat") + 1))
    best = Window.partitionBy(*group).orderBy(F.desc("_quotient"), *order)
    won = (F.row_number().over(best) <= F.col("_open")) & (F.col("_quotient") > 0)
    helpers = ["_sum", "_cells", "_even", "_last", "_open", "_seat", "_quotient"]
    seats = seats.withColumn("_won", won.cast("long")).drop(*helpers)
    keys = [c for c in seats.columns if c not in ("_won", "_sure")]
    return seats.groupBy(*keys).agg((F.max("_sure") + F.sum("_won")).alias("seats"))


def source_targets(sizes: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """source_key, source, source_size, weight, target of (source_key, source, source_size).

    Sources by code point, null last, weigh 1, 2, 3, repeating. Target: weight x the level
    at which min(weight x level, ``repeats`` x size) adds up to all sizes. Sources are
    filled in the order of the level at which they are full.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    sizes = sizes.withColumn("weight", 1 + F.pmod(F.row_number().over(by_name) - 1, F.lit(3)))
    sizes = sizes.withColumn("full", F.lit(repeats) * F.col("source_size"))
    by_level = Window.orderBy(F.col("full") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    words = F.sum("source_size").over(Window.partitionBy())
    level = (words - F.coalesce(F.sum("full").over(before), F.lit(0))) / F.sum("weight").over(rest)
    sizes = sizes.withColumn("level", level)
    # The first source that isn't full sets the level for all that follow.
    above = F.min(F.when(F.col("level") * F.col("weight") <= F.col("full"), F.struct(F.col("full") / F.col("weight"), "level")))
    sizes = sizes.withColumn("set", above.over(Window.partitionBy()).getField("level"))
    target = F.least(F.col("full").cast("double"), F.col("weight") * F.coalesce("set", F.lit(float("inf"))))
    return sizes.select("source_key", "source", "source_size", "weight", target.cast("double").alias("target"))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long")


def _piece(begin: Column, end: Column, low: Column, high: Column) -> Column:
    """The words of a text at begin..end that lie in low..high, counted from its first."""
    start = F.greatest(begin, low)
    stop = F.greatest(start, F.least(end, high))
    return F.struct((start - begin).alias("start"), (stop - begin).alias("stop"))


def mixed_sources(
    documents: DataFrame,
    work: Workspace,
    seed: int = 17,
    block: int = BLOCK,
    shards: int = SHARDS,
    repeats: int = REPEATS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken, passes, pieces per row of (doc_id, text, source).

    size counts the text's words (null: 0), taken the words that the mix takes of it,
    repeats counted, never more than ``repeats`` x size: ``passes`` times the whole text and
    once each of its ``pieces``, runs of words from start to before stop. A source's taken words miss its
    target by less than one block for the source and one for each shard that ``repeats``
    limits. ``carry`` names further columns of ``documents`` to return.

    A null source is a source of its own. A null doc_id counts like any other, and texts
    without words take nothing. Repeated rows are taken as rows of their own. The same
    rows give the same mix in any order and partitioning. No rows give no rows; where
    no text has words, all targets and taken words are 0. Other columns aren't read.

    Shards bound what one task sorts: a source's rows / ``shards``.
    """
    text = F.col("text").cast("string")
    order = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    source = F.col("source").cast("string")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        source.alias("source"),
        F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)).alias("source_key"),
        word_count(text).alias("size"),
        order.alias("order"),
        *(F.col(name).alias(f"carried_{name}") for name in carry),
    )
    rows = rows.withColumn("shard", F.pmod(_number(F.col("order")), F.lit(shards)))
    if not carry:
        rows = work.write(rows, "sizes")

    cells = work.write(
        rows.groupBy("source_key", "source", "shard").agg(F.sum("size").alias("words"), F.count("*").alias("rows")), "cells"
    )
    sources = source_targets(cells.groupBy("source_key", "source").agg(F.sum("words").alias("source_size")), repeats)
    # All blocks to sources, then each source's blocks to its shards.
    blocks = F.round(F.sum("source_size").over(Window.partitionBy()) / F.lit(block)).cast("long")
    sources = sources.withColumn("total", blocks).withColumn("votes", F.col("target"))
    sources = apportioned(sources.withColumn("all", F.lit(0)), ["all"], [F.asc_nulls_last("source")])
    sources = sources.select("source_key", "source_size", "target", F.col("seats").alias("total"))
    parts = cells.join(sources, "source_key").withColumn("votes", F.col("words"))
    parts = apportioned(parts, ["source_key"], [F.asc("shard")])
    most = F.lit(repeats) * F.col("words")
    # A source that is taken whole so many times needs no blocks.
    full = F.col("target") >= F.lit(repeats) * F.col("source_size")
    quota = F.when(full, most).otherwise(F.least(most, F.col("seats") * F.lit(block)))
    chance = _number(F.md5(F.concat_ws("|", F.lit(seed), "source_key", F.col("shard").cast("string"))))
    start = F.when(F.col("words") > 0, F.pmod(chance, F.ceil(F.col("words") / F.lit(block))) * F.lit(block))
    parts = parts.select(
        "source_key", "shard", "words", "source_size", "target", quota.alias("quota"), F.coalesce(start, F.lit(0)).alias("start")
    )
    parts = work.write(parts, "quotas")

    laid = Window.partitionBy("source_key", "shard").orderBy("order", "size")
    placed = rows.withColumn("end", F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(parts, ["source_key", "shard"])
    begin, end, words = F.col("end") - F.col("size"), F.col("end"), F.col("words")
    passes = F.when(words > 0, F.floor(F.col("quota") / words)).otherwise(0)
    low = F.col("start")
    high = low + F.col("quota") - passes * words
    # Around the end of the shard, the first words follow the last.
    pieces = F.array(_piece(begin, end, F.lit(0), high - words), _piece(begin, end, low, F.least(high, words)))
    pieces = F.filter(pieces, lambda x: x["stop"] > x["start"])
    placed = placed.withColumns({"passes": passes.cast("long"), "pieces": pieces})
    cut = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, x: n + x["stop"] - x["start"])
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + cut).alias("taken"),
        "passes",
        "pieces",
        *(F.col(f"carried_{name}") for name in carry),
    )


def mixed_documents(documents: DataFrame, work: Workspace, **options) -> DataFrame:
    """The mix itself, with the columns of ``documents``: a row per whole pass of a text, and one
    with its further pieces. n_chars, where there is such a column, counts the cut text.

    Texts that the mix takes no words of have no row.
    """
    columns = documents.columns
    mixed = mixed_sources(documents, work, carry=tuple(columns), **options).where("taken > 0")
    text = F.col("carried_text").cast("string")
    runs = F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(F.flatten(F.transform("pieces", lambda x: F.slice(runs, x["start"] + 1, x["stop"] - x["start"]))), "")
    cuts = F.when(F.size("pieces") > 0, F.array(cut)).otherwise(F.array().cast("array<string>"))
    rows = mixed.withColumn("taken_text", F.explode(F.concat(F.array_repeat(text, F.col("passes").cast("int")), cuts)))
    kinds = dict(documents.dtypes)
    new = {"text": F.col("taken_text"), "n_chars": F.char_length("taken_text")}
    return rows.select(
        *(new.get(name, F.col(f"carried_{name}")).cast(kinds[name]).alias(name) for name in columns)
    )
