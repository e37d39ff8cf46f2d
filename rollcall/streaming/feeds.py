"""Files of a feed, taken into the mastered customers as they arrive."""

from __future__ import annotations

import datetime as dt
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rollcall.plans.incremental import Mastery
from rollcall.schemas import CRM_RAW, TRANSACTION_RAW

Feed = Literal["customers", "transactions"]
SCHEMAS = {"customers": CRM_RAW, "transactions": TRANSACTION_RAW}


def stream_feed(spark: SparkSession, folder: str, feed: Feed, files: int | None = None) -> DataFrame:
    """The CSV files of a feed as a stream, at most so many files a micro-batch."""
    reader = spark.readStream.schema(SCHEMAS[feed]).option("header", True)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.csv(folder)


def stream_into(
    state: Mastery, rows: DataFrame, feed: Feed, checkpoint: str, at: dt.datetime | None = None
) -> StreamingQuery:
    """Take what there is of a stream of raw rows into ``state``, micro-batch by micro-batch.

    Cleaning, the newest row per id and mastering are those of :class:`Mastery`: their state is
    in its tables and not in memory, so it needs no watermark to stay bounded, and no row
    comes too late. A row that is older than the one known of its id changes nothing,
    however late; a newer one replaces it, and whatever followed from it.

    A micro-batch that is delivered again after a failure is known by its number and the
    checkpoint's place, and taken once. Let one stream at a time write into a state.
    """
    none = {name: state.spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}

    def take(batch: DataFrame, number: int) -> None:
        given = none | {feed: batch}
        state.apply(given["customers"], given["transactions"], at, tag=f"{checkpoint}#{number}")

    writer = rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
