"""Reading the two CSV feeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rollcall.schemas import CRM_RAW, TRANSACTION_RAW


def _read(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_crm(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The customer feed, all text, columns bound by position."""
    return _read(spark, path, CRM_RAW)


def read_transactions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The purchase feed, all text, columns bound by position."""
    return _read(spark, path, TRANSACTION_RAW)


@dataclass(frozen=True)
class Sifted:
    """The rows of a feed that fit its layout, and the lines that don't."""

    rows: DataFrame
    rejects: DataFrame


def read_sifted(spark: SparkSession, path: str | list[str], schema: StructType, header: bool = True) -> Sifted:
    """A CSV feed without the lines that can't be what was sent.

    A line with too many or too few columns is rejected for its ``columns``, and one with bytes that
    are no UTF-8 for its ``encoding``. Rejects have file, reason and line; with the rows they
    are all lines of the feed. Each of the two frames reads the files once.
    """
    taken = {name.lower() for name in schema.names}
    broken = next(name for name in ("_line", "__line", "___line") if name not in taken)
    layout = StructType([*schema.fields, StructField(broken, StringType(), True)])
    reader = spark.read.schema(layout).option("header", header).option("mode", "PERMISSIVE")
    # All columns are looked at, whichever are asked for.
    reader = reader.option("columnNameOfCorruptRecord", broken).option("columnPruning", False)
    lines = reader.csv(path)
    fields = [F.col(name) for name in schema.names]
    garbled = F.coalesce(F.concat_ws("", *fields).contains("\ufffd"), F.lit(False))
    fits = F.col(broken).isNull()
    reason = F.when(~fits, F.lit("columns")).otherwise(F.lit("encoding"))
    line = F.coalesce(broken, F.concat_ws(",", *[F.coalesce(field, F.lit("")) for field in fields]))
    rejects = lines.filter(~fits | garbled).select(
        F.col("_metadata.file_path").alias("file"), reason.alias("reason"), line.alias("line")
    )
    return Sifted(lines.filter(fits & ~garbled).select(*schema.names), rejects)


def write_feed(df: DataFrame, path: str) -> None:
    """Write a feed so that reading it back gives the same text, blanks included."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
