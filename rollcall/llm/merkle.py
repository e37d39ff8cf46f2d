"""A manifest of a dataset: a Merkle tree per source, and one over the sources (Merkle 1987).

A level is a table of nodes (tree, idx, digest, n), n being the nodes of the tree's level. Each
node asks for its siblings by their computed places: for two children a node that is the index
with its last bit flipped (XOR), for more the slots that lie 1, 2, … behind its own, around
the end of the run. The level is equijoined with itself on these places. Rows of slot 0
then hold a whole run and emit its parent.

Proofs go the other way: a node's path is its own siblings before its parent's path, so that
every path is built once for all the leaves below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.tables import Workspace

#: Children of a node.
FANOUT = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "struct<left:binary,right:binary>"


def field(value: Column) -> Column:
    """A value as leaves hash it: its UTF-8 byte count, ``:`` and itself, or ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def ranked(frame: DataFrame, order: list[Column], work: Workspace, name: str) -> DataFrame:
    """``frame`` written in ``order``, with each row's place as ``rank``, from 0 on.

    Range partitioning sorts; a part's places follow from the row counts of the parts before it.
    Only those counts, one per part, meet in a window.
    """
    rows = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = work.write(rows.withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", 33).alias("_part")
    counts = rows.groupBy(part).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    counts = work.write(counts, f"{name}-parts")
    placed = rows.withColumn("_part", F.shiftright("_place", 33)).join(counts, "_part")
    return placed.withColumn("rank", F.col("_place") - F.col("_first") + F.col("_before")).drop("_place", "_part", "_first", "_before")


def _siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with the digests left and right of each in its run, joined.

    All joins are merge joins, so that a level of any size is worked on alike.
    """
    slot = F.col("idx") % fanout
    if fanout == 2:
        place = F.col("idx").bitwiseXOR(F.lit(1).cast("long"))
    else:
        shifts = F.sequence(F.lit(1), F.lit(fanout - 1))
        place = F.explode(F.transform(shifts, lambda shift: F.col("idx") - slot + (slot + shift) % fanout))
    asked = nodes.select("tree", F.col("idx").alias("asking"), "n", place.alias("idx")).where("idx < n").drop("n")
    found = asked.join(nodes.select("tree", "idx", "digest").hint("merge"), ["tree", "idx"])
    of_node = found.groupBy("tree", F.col("asking").alias("idx")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("idx").alias("place"), "digest"))).alias("others")
    )
    sides = nodes.join(of_node.hint("merge"), ["tree", "idx"], "left")

    def side(keeps) -> Column:
        digests = F.transform(F.filter("others", keeps), lambda x: x["digest"])
        # The only node of a last run has no siblings.
        return F.coalesce(F.aggregate(digests, F.lit(b""), lambda a, b: F.concat(a, b)), F.lit(b""))

    both = {"left": side(lambda x: x["place"] < F.col("idx")), "right": side(lambda x: x["place"] > F.col("idx"))}
    return sides.withColumns(both).drop("others")


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _digest(*digests: Column) -> Column:
    """The digest of digests as hex text, as bytes."""
    return F.unhex(F.sha2(_text(F.concat(*digests)), 256))


def grow(leaves: DataFrame, work: Workspace, name: str, fanout: int = FANOUT) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels of trees from ``leaves`` (tree, idx, digest, n, and more) up, and the roots of each height.

    ``levels[k]`` has tree, idx, digest, left, right of the nodes of trees with several nodes at level k,
    ``roots[k]`` has tree and digest of the trees with one. Level 0 keeps the other columns of the leaves.
    """
    levels, roots, nodes = [], [], leaves
    while True:
        roots.append(nodes.where("n = 1"))
        several = nodes.where("n > 1")
        if several.isEmpty():
            return levels, roots
        level = work.write(_siblings(several, fanout), f"{name}-{len(levels)}")
        levels.append(level.drop("n"))
        nodes = level.where(F.col("idx") % fanout == 0).select(
            "tree",
            F.expr(f"idx div {fanout}").alias("idx"),
            _digest(F.col("digest"), F.col("right")).alias("digest"),
            F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
        )


def paths(levels: list[DataFrame], tops: list[DataFrame], work: Workspace, name: str, fanout: int = FANOUT) -> DataFrame:
    """(tree, idx, path, the columns of ``tops``, and the other ones of the leaves) of all leaves.

    ``tops[k]`` has the trees whose root lies at level k, with the path from there on and
    whatever else their leaves are to know; ``tops[0]`` also has the other columns of its leaves.
    """
    below = None
    for k in reversed(range(len(tops))):
        own = tops[k].withColumn("idx", F.lit(0).cast("long"))
        if below is not None:
            above = below.withColumnRenamed("idx", "parent")
            step = F.array(F.struct("left", "right")).cast(f"array<{_STEP}>")
            level = levels[k].drop("digest") if k else levels[k]
            level = level.withColumn("parent", F.expr(f"idx div {fanout}")).join(above.hint("merge"), ["tree", "parent"])
            own = own.unionByName(level.withColumn("path", F.concat(step, "path")).select(own.columns))
        below = work.write(own, f"{name}-{k}") if k else own
    return below


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, digest, lambda d, s: _digest(s["left"], d, s["right"]))


def proof_digest(path: Column) -> Column:
    """sha256 of all siblings on a path, as hex text."""
    siblings = F.transform(path, lambda s: _text(F.concat(s["left"], s["right"])))
    return F.sha2(F.array_join(siblings, ""), 256)


def manifest(documents: DataFrame, work: Workspace, fanout: int = FANOUT, tampered: int = 5) -> DataFrame:
    """doc_id, leaf, subroot, root, path, folded_root, verified per row of ``documents``
    (doc_id, source, lang, n_chars, text).

    A source's leaves ascend by doc_id (null first, equal ones by digest); the trees of the sources
    ascend by source (null first, bytewise). ``path`` are the siblings left and right of the leaf and
    of each node above it. Where ``tampered`` divides the crc32 of the doc_id's decimals, the folded leaf is
    that of the text with A-Z in lower case, as someone who changes the data would have it.

    Nulls are hashed as ``-``; a row without a doc_id is not tampered with. Repeated rows are
    leaves of their own. An empty table gives no rows. Other columns aren't read.

    Texts are hashed where they are read, and nothing but digests is shuffled. A hot source is
    many runs like any other, as joins go by (tree, place).
    """
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % tampered == 0, F.lit(False))
    lowered = F.translate(text, UPPER, LOWER)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf_digest(*values, text).alias("leaf"),
        F.when(hit & (lowered != text), leaf_digest(*values, lowered)).alias("changed"),
    )
    rows = ranked(rows, [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("leaf")], work, "leaves")
    sources = rows.groupBy("source").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    sources = ranked(sources, [F.asc_nulls_first("source")], work, "sources").withColumnRenamed("rank", "tree")
    sources = work.write(sources, "trees").alias("s")
    leaves = rows.alias("r").join(sources, F.col("r.source").eqNullSafe(F.col("s.source")))
    leaves = leaves.select(
        "tree",
        (F.col("rank") - F.col("first")).alias("idx"),
        F.unhex("leaf").alias("digest"),
        "n",
        "doc_id",
        F.unhex("changed").alias("changed"),
    )
    levels, subroots = grow(work.write(leaves, "placed"), work, "level", fanout)

    # The roots of the sources are the leaves of one more tree.
    n_trees = sources.count()
    tops = subroots[0].select("tree", "digest").withColumn("height", F.lit(0))
    for height, roots in enumerate(subroots[1:], 1):
        tops = tops.unionByName(roots.select("tree", "digest").withColumn("height", F.lit(height)))
    tops = work.write(tops, "subroots")
    every = tops.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest", F.lit(n_trees).cast("long").alias("n"), "height"
    )
    upper, root = grow(every, work, "upper", fanout)
    none = F.array().cast(f"array<{_STEP}>")
    own = [F.col("digest").alias("subroot"), "height"]
    starts = [
        one.select("tree", F.col("digest").alias("root"), none.alias("path"), *(() if height else own))
        for height, one in enumerate(root)
    ]
    upper = [upper[0].withColumnRenamed("digest", "subroot"), *upper[1:]] if upper else []
    over = paths(upper, starts, work, "above", fanout)
    over = work.write(over.select(F.col("idx").alias("tree"), "subroot", "root", "path", "height"), "over")
    carried = ["digest", "doc_id", "changed"]
    lone = subroots[0].select("tree", *carried).join(over.where("height = 0").drop("height"), "tree")
    starts = [lone, *[over.where(F.col("height") == k).drop("height") for k in range(1, len(subroots))]]
    proven = paths(levels, starts, work, "paths", fanout)
    root_of = folded(F.coalesce("changed", "digest"), F.col("path"))
    proven = proven.withColumn("folded_root", root_of)
    return proven.select(
        "doc_id",
        _text(F.col("digest")).alias("leaf"),
        _text(F.col("subroot")).alias("subroot"),
        _text(F.col("root")).alias("root"),
        "path",
        _text(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
