"""Model registry: one row per trained version, baseline or activation event."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.months import as_date
from riskloom.operators.assemble import OOT_MONTHS, TRAIN_MONTHS, window_columns
from riskloom.session import stored
from riskloom.sources import versions

# Fixed value: how a version is named after its training date.
VERSION_PREFIX = "credit_model_"


def model_version(train_date: Column) -> Column:
    return F.concat(F.lit(VERSION_PREFIX), F.date_format(train_date, "yyyy_MM_dd"))


def registry_rows(
    metrics: DataFrame, train_months: int = TRAIN_MONTHS, oot_months: int = OOT_MONTHS
) -> DataFrame:
    """Registry rows from per-split metrics, with the training windows of their date.

    ``metrics`` has one row per (train_date, split) with split train, test or oot and the
    columns row_count, label_rate and auc.
    """

    def of(split: str, col: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(col)))

    splits = ("train", "test", "oot")
    wide = metrics.groupBy("train_date").agg(
        *[of(s, "row_count").alias(f"rows_{s}") for s in splits],
        *[of(s, "label_rate").alias(f"label_rate_{s}") for s in splits],
        *[of(s, "auc").alias(f"auc_{s}") for s in splits],
    )
    gini = [F.round(F.col(f"auc_{s}") * 2 - 1, 4).alias(f"gini_{s}") for s in splits]
    bounds = window_columns(F.col("train_date"), train_months, oot_months)
    return wide.select(
        model_version(F.col("train_date")).alias("model_version"),
        "train_date",
        *[c.alias(name) for name, c in bounds.items()],
        *[c for c in wide.columns if c != "train_date"],
        *gini,
    )


def with_params(registry: DataFrame, params: Mapping[str, object]) -> DataFrame:
    """Attach the hyper-parameters of the version as a map of text."""
    pairs = [F.lit(str(x)) for pair in params.items() for x in pair]
    return registry.withColumn("params", F.create_map(*pairs).cast("map<string,string>"))


def latest_version(registry: DataFrame) -> DataFrame:
    """The last version by name, as one row."""
    return registry.agg(F.max("model_version").alias("model_version"))


def active_model(activations: DataFrame, registry: DataFrame) -> DataFrame:
    """Version of the last activation event whose model exists; no row without one."""
    known = activations.join(registry.select("model_version").distinct(), "model_version", "left_semi")
    return known.agg(F.max_by("model_version", F.struct("activated_at", "model_version")).alias("model_version")).where(
        F.col("model_version").isNotNull()
    )


def activate_model(
    activations: DataFrame, registry: DataFrame, version: str | None, day: str | date
) -> DataFrame:
    """Activation history with one more event; a missing version adds nothing."""
    event = registry.where(F.col("model_version") == F.lit(version)).select(
        "model_version", as_date(day).alias("activated_at")
    )
    return activations.unionByName(event.distinct())


def needs_initial_training(activations: DataFrame, registry: DataFrame) -> DataFrame:
    """One row: true when no existing model is active."""
    return active_model(activations, registry).agg((F.count("*") == 0).alias("needs_training"))


def resolve_model(
    registry: DataFrame,
    baselines: DataFrame,
    activations: DataFrame,
    fresh: DataFrame | None = None,
) -> DataFrame:
    """One row with the version to score with, where it came from and its baseline.

    Precedence: freshly trained, then active, then latest by name. The baseline is the one
    of the same version, else the latest one.
    """
    candidates = [
        (3, "active", active_model(activations, registry)),
        (4, "latest", latest_version(registry)),
    ]
    if fresh is not None:
        candidates.insert(0, (1, "fresh", fresh.select("model_version")))
    ranked = None
    for rank, source, df in candidates:
        one = df.where(F.col("model_version").isNotNull()).select(
            F.struct(F.lit(-rank).alias("rank"), F.col("model_version").alias("version"),
                     F.lit(source).alias("source")).alias("c")
        )
        ranked = one if ranked is None else ranked.unionAll(one)
    best = ranked.agg(F.max("c").alias("c")).where(F.col("c").isNotNull()).select(
        F.col("c.version").alias("model_version"), F.col("c.source").alias("source")
    )
    paired = baselines.select("model_version", F.col("baseline").alias("_own"))
    newest = baselines.agg(F.max("baseline")).scalar()
    return best.join(paired, "model_version", "left").select(
        "model_version", "source", F.coalesce("_own", newest).alias("baseline")
    )


def append_registry(row: DataFrame, path: str) -> None:
    """Commit the registry with the versions of ``row``; rows of the same version are replaced, so a rerun adds nothing."""
    row = stored(row, "registry-row")

    def change(known: DataFrame | None) -> DataFrame:
        if known is None:
            return row
        others = known.join(row.select("model_version").distinct(), "model_version", "left_anti")
        return others.unionByName(row, allowMissingColumns=True)

    versions.update(row.sparkSession, path, change)


def read_registry(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The registry as last committed, or at an earlier commit."""
    found = versions.read(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"{path} holds no registry")
    return found


ACTIVATIONS = "model_version string, activated_at date"


def record_activation(
    registry: DataFrame, path: str, version: str, day: str | date, token: str | None = None
) -> int:
    """Commit one more activation event. The event of a version and day is kept once."""
    spark = registry.sparkSession

    def change(known: DataFrame | None) -> DataFrame:
        events = spark.createDataFrame([], ACTIVATIONS) if known is None else known
        return activate_model(events, registry, version, day).distinct()

    return versions.update(spark, path, change, token)


def read_activations(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The activation events as last committed; none before the first."""
    found = versions.read(spark, path, number)
    return spark.createDataFrame([], ACTIVATIONS) if found is None else found
