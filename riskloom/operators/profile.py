"""Table profiling. Every function is one distributed pass over the columns it needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.ranks import exact_quantiles, long_numeric, spearman
from riskloom.session import stored

# Names left out of drift features, and the deviation that counts as spread.
EXCLUDED_NAMES = {
    "label",
    "target",
    "y",
    "id",
    "customer_id",
    "article_id",
    "user_id",
    "item_id",
    "timestamp",
    "date",
    "dt",
    "snapshot_date",
}
SPREAD = 0.01


def _per_column(df: DataFrame, cols: Sequence[str], one, name: str) -> DataFrame:
    """One aggregate per column, returned as rows (column_name, name)."""
    wide = df.agg(*[one(c).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias(name))
            for i, c in enumerate(cols)
        ]
    )
    return wide.select(F.inline(rows))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return _per_column(df, cols or df.columns, lambda c: F.count_if(F.col(c).isNull()), "nulls")


def distinct_counts(
    df: DataFrame, cols: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Distinct non-null values per column: exact through one shuffle of distinct
    (column, value) pairs, or a sketch."""
    cols = list(cols or df.columns)
    if approximate:
        return _per_column(df, cols, F.approx_count_distinct, "distinct_values")
    text = df.select([F.col(c).cast("string").alias(c) for c in cols])
    pairs = text.unpivot([], cols, "column_name", "value").distinct()
    return pairs.groupBy("column_name").agg(F.count("value").alias("distinct_values"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max of numeric columns."""
    # Four passes follow; what the columns are made from is worked out once.
    rows = long_numeric(stored(df.select(*[F.col(c).try_cast("double").alias(c) for c in cols]), "described"), cols)
    moments = rows.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(rows, ["feature"], "value", [0.25, 0.5, 0.75]).select(
        "feature", *[F.get("quantiles", F.lit(i)).alias(f"p{25 * (i + 1)}") for i in range(3)]
    )
    return moments.join(quartiles, "feature", "left").select(
        F.col("feature").alias("column_name"), "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Percentage of rows per value, nulls included."""
    counts = df.groupBy(col).agg(F.count("*").alias("row_count"))
    all_rows = counts.agg(F.sum("row_count")).scalar()
    return counts.select(col, "row_count", (F.col("row_count") / all_rows * 100).alias("percentage"))


def records_per_customer(df: DataFrame, key: str = "Customer_ID") -> DataFrame:
    """Summary of the number of rows per customer."""
    records = df.groupBy(key).agg(F.count("*").alias("records"))
    return describe(records, ["records"])


def histogram(
    df: DataFrame, cols: Sequence[str], bins: int, hue: Sequence[str] = (), log_scale: bool = False
) -> DataFrame:
    """Equal-width counts of several columns at once, optionally per ``hue`` value.

    With ``log_scale`` the bins are equally wide in log10 and only positive values count.
    Empty bins are not listed.
    """
    rows = long_numeric(df, cols, hue).where(F.col("value").isNotNull())
    if log_scale:
        rows = rows.where(F.col("value") > 0).withColumn("value", F.log10("value"))
    span = rows.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    # One span per column: bounded by the number of columns.
    width = (F.col("hi") - F.col("lo")) / bins
    position = F.floor(F.try_divide(F.col("value") - F.col("lo"), width)).cast("int")
    binned = rows.join(F.broadcast(span), "feature").withColumn(
        "bin", F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1))
    )
    return (
        binned.groupBy("feature", *hue, "bin", "lo", "hi")
        .agg(F.count("*").alias("row_count"))
        .withColumn("bin_start", F.col("lo") + F.col("bin") * width)
        .drop("lo", "hi")
    )


def category_by_label(df: DataFrame, cols: Sequence[str], label: str = "label") -> DataFrame:
    """Rows per category and label for several columns in one pass; nulls are left out."""
    text = df.select(label, *[F.col(c).cast("string").alias(c) for c in cols])
    rows = text.unpivot([label], list(cols), "feature", "category")
    return (
        rows.where(F.col("category").isNotNull())
        .groupBy("feature", "category", label)
        .agg(F.count("*").alias("row_count"))
    )


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Square rank-correlation table: one row per column, one column per column."""
    upper = spearman(df, cols).select("x_name", "y_name", "rho")
    lower = upper.select(F.col("y_name").alias("x_name"), F.col("x_name").alias("y_name"), "rho")
    both = upper.unionAll(lower)
    wide = both.groupBy("x_name").agg(
        *[
            F.max(F.when(F.col("x_name") == c, F.lit(1.0)).when(F.col("y_name") == c, F.col("rho"))).alias(c)
            for c in cols
        ]
    )
    return wide.withColumnRenamed("x_name", "feature")


def score_stats(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.count("*").alias("count"),
    )


def score_diagnostics(current: DataFrame, col: str, by: str = "snapshot_date") -> DataFrame:
    """Per month: rows, distinct scores, range, mean and population deviation."""
    return current.groupBy(by).agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(col).alias("unique_values"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.avg(col).alias("mean"),
        F.stddev_pop(col).alias("std"),
    )


def constant_score_report(base: DataFrame, base_col: str, current: DataFrame, col: str) -> DataFrame:
    """One row: whether all current scores are one value while the baseline varies."""
    now = current.agg(
        F.min(col).alias("current_min"), F.max(col).alias("current_max"), F.count(col).alias("current_count")
    )
    spread = base.agg(F.stddev_pop(base_col)).scalar()
    constant = (F.col("current_min") == F.col("current_max")) & (spread > SPREAD)
    return now.select(
        "current_count",
        "current_min",
        "current_max",
        spread.alias("baseline_std"),
        F.when(constant, "All predictions identical").otherwise("Predictions vary").alias("issue"),
        F.when(constant, "CRITICAL").otherwise("INFO").alias("severity"),
        F.when(constant, "RETRAIN MODEL").otherwise("NONE").alias("recommended_action"),
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Column name, type and number of non-null values."""
    counts = _per_column(df, df.columns, F.count, "non_null")
    types = F.create_map(
        *[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())]
    )
    return counts.select("column_name", types[F.col("column_name")].alias("data_type"), "non_null")


def classify_columns(df: DataFrame, drop: Sequence[str] = ()) -> dict[str, list[str]]:
    """Numeric and other columns by type, without excluded names (case does not matter)."""
    excluded = EXCLUDED_NAMES | {c.lower() for c in drop}
    kept = [f for f in df.schema.fields if f.name.lower() not in excluded]
    numeric = [f.name for f in kept if isinstance(f.dataType, T.NumericType)]
    return {"numeric": numeric, "categorical": [f.name for f in kept if f.name not in numeric]}
