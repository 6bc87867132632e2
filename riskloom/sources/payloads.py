"""Stores of the drift monitor: monthly payloads, history, feature PSI and baselines.

All of them hold one row per month, feature or bin, never row-level data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.schemas import BASELINE_DOCUMENT, PSI_PAYLOAD
from riskloom.sources.tables import latest_per, write_table


def write_psi_payload(df: DataFrame, path: str) -> None:
    """One JSON document per month; rewriting a month replaces its document."""
    documents = df.select("month", "overall", "psi", "status", F.col("month").alias("file_month"))
    write_table(documents, path, partition_by=("file_month",), fmt="json")


def read_psi_payload(spark: SparkSession, path: str) -> DataFrame:
    """All payload documents, one JSON object per file, pretty-printed or not."""
    return (
        spark.read.schema(PSI_PAYLOAD)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )


def ok_payloads(payloads: DataFrame) -> DataFrame:
    """Months with a computed index, one row per month and feature, with a month date."""
    return payloads.where(F.col("status") == "OK").select(
        "month",
        F.to_date("month", "yyyy-MM").alias("month_dt"),
        F.col("overall").alias("overall_psi"),
        F.explode_outer("psi").alias("feature", "psi"),
    )


def append_history(payloads: DataFrame, path: str) -> None:
    """Add computed months to the history; a rerun replaces its month."""
    rows = payloads.where(F.col("status") == "OK").select(
        "overall", F.to_json("psi").alias("detail_json"), "month"
    )
    write_table(rows, path, partition_by=("month",))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("overall double, detail_json string, month string").parquet(path)


def latest_history(history: DataFrame, written_at: str) -> DataFrame:
    """Last row per month of a history that was appended to without replacing."""
    return latest_per(history, ["month"], F.col(written_at))


def write_feature_psi(df: DataFrame, path: str) -> None:
    write_table(df, path, partition_by=("model_name", "current_snapshot"))


def read_feature_psi(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "baseline_snapshot string, feature string, value_type string, psi double, psi_grade string, "
        "model_name string, current_snapshot string"
    )
    return spark.read.schema(schema).parquet(path)


def write_baseline(baseline: DataFrame, path: str) -> None:
    write_table(baseline, path, partition_by=("model_name", "baseline_snapshot"))


def read_baseline(spark: SparkSession, path: str, model_name: str, snapshot: str) -> DataFrame:
    return spark.read.parquet(path).where(
        (F.col("model_name") == model_name)
        & (F.col("baseline_snapshot") == F.lit(snapshot).cast("date"))
    )


def import_baseline_json(spark: SparkSession, path: str) -> DataFrame:
    """Baseline document ``{numeric: {..}, categorical: {..}}`` as the long table
    (feature, value_type, bin_id, lo, hi, category, p_ref). Infinite edges are accepted."""
    document = (
        spark.read.schema(BASELINE_DOCUMENT)
        .option("multiLine", True)
        .option("allowNonNumericNumbers", True)
        .json(path)
    )
    numeric = document.select(F.explode("numeric").alias("feature", "m")).select(
        "feature",
        F.lit("numeric").alias("value_type"),
        F.posexplode("m.p_ref").alias("bin_id", "p_ref"),
        F.col("m.edges").alias("edges"),
    )
    numeric = numeric.select(
        "feature",
        "value_type",
        "bin_id",
        F.get("edges", F.col("bin_id")).alias("lo"),
        F.get("edges", F.col("bin_id") + 1).alias("hi"),
        F.lit(None).cast("string").alias("category"),
        "p_ref",
    )
    categorical = document.select(F.explode("categorical").alias("feature", "m")).select(
        "feature",
        F.lit("categorical").alias("value_type"),
        F.lit(None).cast("int").alias("bin_id"),
        F.lit(None).cast("double").alias("lo"),
        F.lit(None).cast("double").alias("hi"),
        F.explode("m.p_ref").alias("category", "p_ref"),
    )
    return numeric.unionByName(categorical)
