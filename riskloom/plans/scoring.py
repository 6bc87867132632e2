"""Scoring run: assembled features of one or more months through a saved model."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from riskloom.functions.months import listed_months
from riskloom.operators.assemble import assemble_scoring
from riskloom.operators.model import load_model, score
from riskloom.sources.tables import between_months, write_table


def run_scoring(
    spark: SparkSession,
    attributes: DataFrame,
    financials: DataFrame,
    bank: str,
    version: str,
    lo: str | date,
    hi: str | date,
    path: str,
) -> None:
    """Score every month from ``lo`` to ``hi`` into one table by model and month."""
    rows = assemble_scoring(between_months(attributes, lo, hi), between_months(financials, lo, hi))
    scored = score(load_model(spark, f"{bank}/{version}"), rows, version)
    own = {"model_name": version}
    write_table(scored, path, ["model_name", "snapshot_date"], months=listed_months(lo, hi), within=own)
