"""Scheduled catch-up: feed files that arrived since the last run are added to bronze.

The stream remembers which files it has read and which output files it has committed, so a
run reads new files only, and a restart or a lost executor leaves neither gaps nor
duplicates. Late files of an old month are added to that month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.sources.schemas import raw_schema
from riskloom.sources.tables import MONTH


def arriving(spark: SparkSession, feed: str, source: str) -> DataFrame:
    """Files of a feed as a stream of raw text rows."""
    return spark.readStream.schema(raw_schema(feed)).option("header", True).option("escape", '"').csv(source)


def catch_up(spark: SparkSession, feed: str, source: str, table: str, progress: str) -> None:
    """Process all files of ``feed`` that are new below ``source``, then stop.

    ``progress`` keeps the state of the stream. ``table`` is written by this stream alone.
    """
    query = (
        arriving(spark, feed, source)
        .writeStream.format("parquet")
        .partitionBy(MONTH)
        .option("path", table)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
