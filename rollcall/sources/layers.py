"""Writing the mastered layers and the quality reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.mastering import analytics_view
from rollcall.sources.scratch import hadoop_path

# Folder names of the two layers.
FULL_LAYER = "gold_raw"
ANALYTICS_LAYER = "ba_gold"


def _overwrite(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_master(master: DataFrame, folder: str) -> DataFrame:
    """Write the full layer and return it as written."""
    return _overwrite(master, f"{folder}/{FULL_LAYER}")


def write_analytics(written_master: DataFrame, folder: str) -> DataFrame:
    """Write the analyst layer from the written full layer and return it.

    Reading the full layer back, instead of computing it again, keeps both layers
    in step.
    """
    return _overwrite(analytics_view(written_master), f"{folder}/{ANALYTICS_LAYER}")


def report_path(folder: str, source: str, at: dt.datetime) -> str:
    day, moment = at.strftime("%d-%m-%y"), at.strftime("%Y%m%d_%H%M%S")
    return f"{folder}/{day}/{source}_data_quality_report_{moment}.json"


def write_report(
    report: DataFrame, folder: str, source: str, at: dt.datetime | None = None
) -> str:
    """Write a one-row profile as an indented JSON document; returns its path.

    Spark writes the one part file, so any file system will do; that file is then
    renamed to the path. A document of the same name is replaced.
    """
    path = report_path(folder, source, at or dt.datetime.now())
    options = {"pretty": "true", "ignoreNullFields": "false"}
    document = F.to_json(F.struct(*report.columns), options).alias("value")
    parts = f"{path}.parts"
    report.select(document).coalesce(1).write.mode("overwrite").text(parts)
    spark = report.sparkSession
    pattern, files = hadoop_path(spark, f"{parts}/part-*")
    target, _ = hadoop_path(spark, path)
    files.delete(target, True)
    if not files.rename(files.globStatus(pattern)[0].getPath(), target):
        raise OSError(f"can't rename the report to {path}")
    files.delete(pattern.getParent(), True)
    return path
