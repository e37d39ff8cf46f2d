"""Data quality: completeness, format validity, uniqueness, freshness.

Each check is a small ``DataFrame``. A whole profile is one row computed in one
job: every per-row check sits in one global aggregate, and uniqueness adds one
aggregation by key that is combined before it is shuffled, so a repeated key (or
a NULL one) never piles up in one task.

Figures are first counted into plain columns (``_rows``, ``_full_<column>``, ...)
and then laid out as structs, one per line of the result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import percentage
from rollcall.operators.cleaning import ingestion_time
from rollcall.rules import ProfileSpec

Formats = Sequence[tuple[str, str, str]]

_COMPLETENESS = ("complete_count", "total_records", "null_count", "completeness_percentage")
_VALIDITY = ("valid_count", "non_null_count", "invalid_count", "validity_percentage")
_UNIQUENESS = (
    "total_records",
    "distinct_records",
    "duplicate_count",
    "duplicate_groups_count",
    "uniqueness_percentage",
)


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _figure(name: str) -> Column:
    return F.col(_name(name))


def _struct(values: Iterable[Column], names: Iterable[str]) -> Column:
    return F.struct(*[v.alias(n) for v, n in zip(values, names, strict=True)])


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _lines(row: DataFrame, first: str, entries: dict[str, list[Column]], names) -> DataFrame:
    """One output row per entry: its label and its figures."""
    layout = (first, *names)
    structs = [_struct([F.lit(k), *v], layout) for k, v in entries.items()]
    if not structs:  # keep the layout, without rows
        counts = [F.lit(0).cast("long")] * (len(names) - 1)
        structs = [_struct([_null("string"), *counts, F.lit(0.0)], layout)]
        row = row.filter(F.lit(False))
    return row.select(F.inline(F.array(*structs)))


def _distinct(names: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(names))


def row_count(df: DataFrame, source: str) -> DataFrame:
    return df.agg(_size("total_records")).select(
        F.lit(source).alias("source"), "total_records"
    )


def _size(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


# --- figures ------------------------------------------------------------------


def _count_filled(columns: Sequence[str]) -> list[Column]:
    return [F.count(_name(c)).alias(f"_full_{c}") for c in columns]


def _filled(column: str) -> list[Column]:
    full, rows = _figure(f"_full_{column}"), F.col("_rows")
    return [full, rows, rows - full, percentage(full, rows)]


def _count_valid(formats: Formats) -> list[Column]:
    counts = []
    for label, column, pattern in formats:
        value = F.col(_name(column))
        counts.append(F.count_if(value.rlike(pattern)).alias(f"_good_{label}"))
        counts.append(F.count(value).alias(f"_some_{label}"))
    return counts


def _valid(label: str) -> list[Column]:
    good, some = _figure(f"_good_{label}"), _figure(f"_some_{label}")
    return [good, some, some - good, percentage(good, some)]


def _count_groups(position: int = 0, width: int = 1) -> list[Column]:
    """Figures over the groups (``_n`` rows each) of one of ``width`` grouping sets.

    ``grouping_id`` has one bit per column, the first column's highest; a set bit
    means that the column is *not* part of the set.
    """
    own = F.col("_set") == 2**width - 1 - 2 ** (width - 1 - position)
    rows = F.coalesce(F.sum(F.when(own, F.col("_n"))), F.lit(0))
    return [
        rows.alias(f"_keyed_{position}"),
        F.count_if(own).alias(f"_distinct_{position}"),
        F.count_if(own & (F.col("_n") > 1)).alias(f"_repeated_{position}"),
    ]


def _unique(position: int = 0) -> list[Column]:
    rows, distinct, repeated = (
        F.col(f"_{figure}_{position}") for figure in ("keyed", "distinct", "repeated")
    )
    return [rows, distinct, rows - distinct, repeated, percentage(distinct, rows)]


# --- single checks ------------------------------------------------------------


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-NULL share per column. A column ``df`` lacks gets NULL figures."""
    present = set(df.columns)
    wanted = _distinct(columns)
    row = df.agg(_size("_rows"), *_count_filled([c for c in wanted if c in present]))
    unknown = [_null("long"), F.col("_rows"), _null("long"), _null("double")]
    entries = {c: _filled(c) if c in present else unknown for c in wanted}
    return _lines(row, "column_name", entries, _COMPLETENESS)


def validity(df: DataFrame, formats: Formats) -> DataFrame:
    """Share of non-NULL values that fit a pattern, per ``(label, column, pattern)``."""
    known = [entry for entry in formats if entry[1] in df.columns]
    row = df.agg(_size("_rows"), *_count_valid(known))
    return _lines(row, "field", {f[0]: _valid(f[0]) for f in known}, _VALIDITY)


def uniqueness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values (NULL is one) and repeated groups per column.

    All columns are counted in one pass, as grouping sets. Columns ``df`` lacks
    are left out.
    """
    known = [c for c in _distinct(columns) if c in df.columns]
    if len(known) > 1:
        sets = df.groupingSets([[_name(c)] for c in known], *map(_name, known))
        groups = sets.agg(_size("_n"), F.grouping_id().alias("_set"))
    else:
        groups = df.groupBy(*map(_name, known)).agg(_size("_n"), F.lit(0).alias("_set"))
    counts = [c for i in range(len(known)) for c in _count_groups(i, len(known))]
    row = groups.agg(*(counts or [_size("_rows")]))
    entries = {c: _unique(i) for i, c in enumerate(known)}
    return _lines(row, "column_name", entries, _UNIQUENESS)


def freshness(df: DataFrame, column: str) -> DataFrame:
    """Earliest and latest date; NULL if ``df`` lacks the column."""
    value = F.col(_name(column)) if column in df.columns else F.lit(None).cast("date")
    return df.agg(F.min(value).alias("min_date"), F.max(value).alias("max_date")).select(
        F.lit(column).alias("column_name"), "min_date", "max_date"
    )


# --- a whole profile ----------------------------------------------------------


def profile(
    df: DataFrame,
    source: str,
    spec: ProfileSpec = ProfileSpec(),
    at: dt.datetime | Column | None = None,
) -> DataFrame:
    """All checks of ``spec`` as one nested row, in the layout of the JSON report.

    Checks on columns the input lacks are left out of their section.
    """
    present = df.columns
    columns = [c for c in _distinct(spec.columns) if c in present]
    formats = [entry for entry in spec.formats if entry[1] in present]
    key = next((c for c in spec.unique_columns if c in present), None)
    dated = next((c for c in spec.date_columns if c in present), None)

    counts = [_size("_rows"), *_count_filled(columns), *_count_valid(formats)]
    oldest = newest = _null("date")
    if dated is not None:
        oldest, newest = F.col("_oldest"), F.col("_newest")
        counts += [F.min(_name(dated)).alias("_oldest"), F.max(_name(dated)).alias("_newest")]
    row = df.agg(*counts)
    if key is not None:
        groups = df.groupBy(_name(key)).agg(_size("_n"), F.lit(0).alias("_set"))
        row = _side_by_side(row, groups.agg(*_count_groups()))

    # The report calls the rows a format was checked on total_records, too.
    valid_names = ("valid_count", "total_records", "invalid_count", "validity_percentage")
    complete = {c: _struct(_filled(c), _COMPLETENESS) for c in columns}
    valid = {f[0]: _struct(_valid(f[0]), valid_names) for f in formats}
    unique = {key: _struct(_unique(), _UNIQUENESS)} if key is not None else {}
    name = F.lit(dated).cast("string")
    fresh = _struct([name, oldest, newest], ("column", "min_date", "max_date"))
    sections = {
        "completeness": _struct(complete.values(), complete),
        "format_validity": _struct(valid.values(), valid),
        "uniqueness": _struct(unique.values(), unique),
        "freshness": fresh,
    }
    return row.select(
        F.lit(source).alias("source"),
        F.col("_rows").alias("total_records"),
        ingestion_time(at).alias("generated_at"),
        F.lit(len(present)).alias("column_count"),
        *[section.alias(name) for name, section in sections.items()],
    )


def _side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two one-row frames in one row."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(_name(c)).alias(c) for c in both.columns])


def profile_lines(report: DataFrame) -> DataFrame:
    """A nested profile as tidy lines: section, column, metric and its value.

    Figures are in ``metric_value``, dates in ``metric_date``.
    """
    layout = ("section", "column_name", "metric", "metric_value", "metric_date")

    def line(section: str, column: Column, metric: str, figure=None, date=None) -> Column:
        values = (
            _null("double") if figure is None else F.col(figure).cast("double"),
            _null("date") if date is None else F.col(date).cast("date"),
        )
        return _struct([F.lit(section), column, F.lit(metric), *values], layout)

    schema = report.schema
    lines = [line("summary", _null("string"), m, m) for m in ("total_records", "column_count")]
    for section in ("completeness", "format_validity", "uniqueness"):
        for entry in schema[section].dataType.fields:
            path = f"{section}.{_name(entry.name)}"
            lines += [
                line(section, F.lit(entry.name), m, f"{path}.{m}")
                for m in entry.dataType.names
            ]
    lines += [
        line("freshness", F.col("freshness.column"), bound, date=f"freshness.{bound}")
        for bound in ("min_date", "max_date")
    ]
    return report.select("source", F.inline(F.array(*lines)))
