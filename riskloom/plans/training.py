"""Training run: windows, split, preprocessing, search, evaluation, registry, baseline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.months import as_date
from riskloom.operators import assemble as A
from riskloom.operators import model as M
from riskloom.operators import registry as R
from riskloom.sources.tables import MONTH


@dataclass
class TrainingRun:
    model: M.ScoringModel
    version: str
    registry_row: DataFrame
    baseline: DataFrame


def training_rows(
    labels: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    train_date: str | date,
    key: Sequence[str] = ("loan_id", "Customer_ID", "snapshot_date"),
) -> DataFrame:
    """Assembled rows with ``split`` train, test or oot."""
    rows = A.temporal_split(A.assemble_training(labels, attributes, financials, train_date), train_date)
    tagged = A.hash_split(rows, list(key))
    return tagged.withColumn("split", F.when(F.col("window") == "oot", "oot").otherwise(F.col("split")))


def run_training(
    spark: SparkSession,
    labels: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    train_date: str | date,
    bank: str,
    space: Mapping[str, Sequence] = M.SEARCH_SPACE,
    draws: int = M.SEARCH_DRAWS,
    rungs: Sequence[int] = (),
) -> TrainingRun:
    """Train on one date: the model and its registry row go below ``bank``."""
    rows = training_rows(labels, attributes, financials, train_date).checkpoint()
    A.check_two_classes(rows.where("window = 'train_test'"))
    train = rows.where("split = 'train'")
    model, _ = M.random_search(
        train, ["loan_id", "Customer_ID", "snapshot_date"], space=space, n=draws, rungs=rungs
    )
    day = A.train_date_frame(spark, train_date)
    version = day.select(R.model_version(F.col(MONTH))).first()[0]
    M.save_model(spark, model, f"{bank}/{version}")
    metrics = (
        M.evaluate(model, rows)
        .select("split", "auc")
        .join(A.split_stats(rows), "split", "right")
        .withColumn("train_date", as_date(train_date))
    )
    row = R.with_params(R.registry_rows(metrics), model.params)
    R.append_registry(row, f"{bank}/registry")
    month = M.baseline_month(as_date(train_date))
    known = A.assemble_scoring(
        attributes.where(F.col(MONTH) == month), financials.where(F.col(MONTH) == month)
    )
    baseline = M.baseline_scores(model, known, version)
    baseline.write.mode("overwrite").parquet(f"{bank}/{version}_psi_ref_preds")
    return TrainingRun(model, version, row, spark.read.parquet(f"{bank}/{version}_psi_ref_preds"))
