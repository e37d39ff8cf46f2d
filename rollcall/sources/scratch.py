"""Where a run keeps intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, whichever that is."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


class Scratch:
    """Intermediate tables of one run, below a folder that all executors see.

    The caller names the folder, or the session does in ``spark.checkpoint.dir``.
    Leaving the context removes what the run has staged.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        folder = folder or spark.conf.get(_CHECKPOINT_DIR, None)
        if not folder:
            raise ValueError(f"name a folder every executor can reach, or set {_CHECKPOINT_DIR}")
        self.spark = spark
        self.folder = f"{folder.rstrip('/')}/rollcall-{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and go on from the written table.

        Unlike a cache this outlives the executors that computed it, and later steps
        read only the columns they need.
        """
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        location, files = hadoop_path(self.spark, self.folder)
        files.delete(location, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.remove()
