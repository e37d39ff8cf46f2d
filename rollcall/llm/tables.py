"""Input tables, and tables written between the jobs of one operator."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


class Workspace:
    """Tables below the shared folder that the session names in ``spark.checkpoint.dir``.

    They cut lineage and outlive any executor. A local session without the setting,
    as in tests, gets a temporary folder; elsewhere the setting is required.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            master = spark.sparkContext.master
            if not (master == "local" or master.startswith("local[")):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="rollcall-")
            spark.conf.set("spark.checkpoint.dir", folder)
        self.folder = f"{folder.rstrip('/')}/rollcall-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}

    def path(self, name: str) -> str:
        """A new path for a table; the name stands for it from now on."""
        self.paths[name] = f"{self.folder}/{uuid.uuid4().hex[:8]}-{name}"
        return self.paths[name]

    def write(self, frame: DataFrame, name: str, **options: str) -> DataFrame:
        """The frame, written once and read back."""
        frame.write.parquet(self.path(name), **options)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.paths[name])

    def remove(self, *names: str) -> None:
        """Delete tables that no later job reads."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def let_go(self) -> None:
        """Have Spark delete shuffle files of jobs that are over.

        Its context cleaner does so once the driver's JVM has collected the plans, which a driver
        that does little may put off for long.
        """
        gc.collect()
        self.spark._jvm.System.gc()
