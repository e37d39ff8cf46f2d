"""What was known when: validity intervals of snapshots of one table.

A history is a snapshot's columns with ``valid_from`` and ``valid_to``: a row held from the
first of them until just before the second, which is NULL while it still holds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.keys import ID_KEY, id_key, unused

Moment = dt.date | dt.datetime | Column
FROM, TO = "valid_from", "valid_to"


def _moment(at: Moment) -> Column:
    return at if isinstance(at, Column) else F.lit(at)


def _prints(columns: Sequence[str], name: str) -> list[Column]:
    """Two hashes of a row's content, NULL told apart from every value and from its place."""
    parts = [F.struct(F.col(c).isNull(), F.col(c)) for c in columns]
    return [F.xxhash64(*parts).alias(f"{name}_1"), F.xxhash64(F.lit(1), *parts).alias(f"{name}_2")]


def first_history(snapshot: DataFrame, at: Moment) -> DataFrame:
    """The history that begins with a snapshot."""
    begun = _moment(at).alias(FROM)
    return snapshot.select("*", begun).withColumn(TO, F.lit(None).cast(snapshot.select(begun).dtypes[0][1]))


def changes(history: DataFrame, snapshot: DataFrame, key: str, ignore: Sequence[str] = ()) -> DataFrame:
    """Ids (as :func:`id_key` columns) whose open row and snapshot row differ, with
    ``_open`` and ``_there``: whether either has the id at all.

    Only ids and hashes of rows meet; rows without a change move nowhere. ``key`` is unique
    within a snapshot, a missing id being one, too.
    """
    content = [c for c in snapshot.columns if c != key and c not in ignore]
    held = history.filter(F.col(TO).isNull()).select(*id_key(key), *_prints(content, "_held"))
    there = snapshot.select(*id_key(key), *_prints(content, "_new"))
    both = held.join(there, list(ID_KEY), "full")
    same = (F.col("_held_1") == F.col("_new_1")) & (F.col("_held_2") == F.col("_new_2"))
    return both.filter(~F.coalesce(same, F.lit(False))).select(
        *ID_KEY, F.col("_held_1").isNotNull().alias("_open"), F.col("_new_1").isNotNull().alias("_there")
    )


def next_history(
    history: DataFrame, snapshot: DataFrame, at: Moment, key: str, ignore: Sequence[str] = ()
) -> DataFrame:
    """``history`` brought up to a later snapshot.

    A changed or vanished id's open row ends at ``at``; a changed or new id's row begins there.
    A row that is the same in all columns but ``ignore`` goes on as it is. Stage the
    history between steps.
    """
    changed = changes(history, snapshot, key, ignore)
    ended = unused(history, "_ended")
    over = changed.filter("_open").select(*ID_KEY, F.lit(True).alias(ended))
    keyed = history.select("*", *id_key(key)).join(over, list(ID_KEY), "left").drop(*ID_KEY)
    ends = F.col(ended).isNotNull() & F.col(TO).isNull()
    kept = keyed.withColumn(TO, F.when(ends, _moment(at)).otherwise(F.col(TO))).drop(ended)
    begun = snapshot.select("*", *id_key(key)).join(changed.filter("_there").select(*ID_KEY), list(ID_KEY), "left_semi")
    return kept.unionByName(first_history(begun.drop(*ID_KEY), at))


def at_moment(history: DataFrame, at: Moment) -> DataFrame:
    """The snapshot that held at a moment."""
    moment = _moment(at)
    holds = (F.col(FROM) <= moment) & (F.col(TO).isNull() | (F.col(TO) > moment))
    return history.filter(holds).drop(FROM, TO)
