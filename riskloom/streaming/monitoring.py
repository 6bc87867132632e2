"""Monitoring of scores as they arrive: drift and retrain decision of every month that got new rows.

Each micro-batch is written under its own number and replaces what an interrupted attempt with the same number left, so no
score counts twice. The months it holds are then compared anew over all their rows and committed to the decisions; the
number of the batch is part of the commit, and a repeated batch finds its commit and changes nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.decide import COOLDOWN_DAYS
from riskloom.plans.monitoring import store_decisions, wanted_months
from riskloom.sources.tables import MONTH, write_table

BATCH = "arrival_batch"


def arrived_scores(spark: SparkSession, scores: str) -> DataFrame:
    """All scores that were taken in, without the number of their batch."""
    return spark.read.parquet(scores).drop(BATCH)


def take_batch(
    batch: DataFrame,
    number: int,
    base: DataFrame,
    root: str,
    model_name: str,
    baseline_from: str | date | None = None,
    days: int = COOLDOWN_DAYS,
) -> None:
    """Take in one micro-batch: scores below ``root``/scores, decisions below ``root``/decisions.

    An empty batch and rows without a month decide nothing.
    """
    spark = batch.sparkSession
    scores = f"{root}/scores"
    dated = batch.where(F.col(MONTH).isNotNull()).withColumn(BATCH, F.lit(number).cast("long"))
    write_table(dated, scores, partition_by=(BATCH, MONTH))
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{scores}/{BATCH}={number}")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return
    taken = spark.read.parquet(scores)
    # Partition columns: the months come from folder names and the scan reads no other month.
    months = [r[0] for r in taken.where(F.col(BATCH) == number).select(MONTH).distinct().collect()]
    touched = taken.where(F.col(MONTH).isin(months)).drop(BATCH)
    spine = touched.select(F.col(MONTH).cast("date").alias(MONTH)).distinct()
    wanted = wanted_months(base, touched, spine, model_name, baseline_from)
    store_decisions(wanted, f"{root}/decisions", days, token=f"{model_name}:{number}")


def watch_scores(
    arrivals: DataFrame,
    base: DataFrame,
    root: str,
    progress: str,
    model_name: str,
    baseline_from: str | date | None = None,
    days: int = COOLDOWN_DAYS,
) -> None:
    """Take in everything that has arrived on the stream ``arrivals``, then stop. ``progress`` keeps its state."""
    query = (
        arrivals.writeStream.foreachBatch(
            lambda batch, number: take_batch(batch, number, base, root, model_name, baseline_from, days)
        )
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
