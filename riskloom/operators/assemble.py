"""Joining labels, features and predictions; temporal windows and splits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.months import as_date
from riskloom.operators.asof import asof_join
from riskloom.operators.joins import lookup_join
from riskloom.operators.ranks import SMALL_GROUP, rank_candidates
from riskloom.sources.tables import MONTH, select_present

# Columns taken from each feature table and the default windows.
ATTRIBUTE_FEATURES = ["Age", "Occupation"]
FINANCIAL_FEATURES = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Credit_Mix",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Credit_History_Age",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Payment_Behaviour",
    "Monthly_Balance",
    "Num_Fin_Pdts",
    "Loans_per_Credit_Item",
    "Debt_to_Salary",
    "EMI_to_Salary",
    "Repayment_Ability",
    "Loan_Extent",
]
LABEL_COLUMNS = ["Customer_ID", "snapshot_date", "label", "loan_id", "label_def"]
TRAIN_MONTHS = 12
OOT_MONTHS = 2
DATA_START = "2023-01-01"
TRAIN_SHARE = 0.8
SPLIT_SEED = 88


def feature_list() -> list[str]:
    """The 26 model features, in model order."""
    return [*ATTRIBUTE_FEATURES, *FINANCIAL_FEATURES]


def window_columns(
    train_date: Column, train_months: int = TRAIN_MONTHS, oot_months: int = OOT_MONTHS
) -> dict[str, Column]:
    """Bounds of the training and out-of-time windows for a training date."""
    oot_start = F.add_months(train_date, -oot_months)
    return {
        "train_start": F.add_months(oot_start, -train_months),
        "train_end": F.date_sub(oot_start, 1),
        "oot_start": oot_start,
        "oot_end": F.date_sub(train_date, 1),
    }


def training_windows(
    months: DataFrame, train_months: int = TRAIN_MONTHS, oot_months: int = OOT_MONTHS
) -> DataFrame:
    """Windows for every training date in ``months.snapshot_date``."""
    bounds = window_columns(F.col(MONTH), train_months, oot_months)
    return months.select(
        F.col(MONTH).alias("train_date"), *[c.alias(name) for name, c in bounds.items()]
    )


def training_feasible(windows: DataFrame, data_start: str | date = DATA_START) -> DataFrame:
    """Whether the full training window lies after the start of the data."""
    enough = F.col("train_start") >= as_date(data_start)
    return windows.select(
        "train_date",
        enough.alias("feasible"),
        F.when(enough, "feasible").otherwise("skipped_insufficient_data").alias("status"),
    )


def assemble_training(
    labels: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    train_date: str | date,
    train_months: int = TRAIN_MONTHS,
    oot_months: int = OOT_MONTHS,
    point_in_time: bool = False,
) -> DataFrame:
    """Labels of both windows with all features known by the end of the later one.

    Features match on customer alone. A customer with several feature rows multiplies the
    label rows, as a plain left join does; with ``point_in_time`` only the last snapshot of
    each customer up to that day counts.
    """
    bounds = window_columns(as_date(train_date), train_months, oot_months)
    inside = select_present(labels, LABEL_COLUMNS).where(
        F.col(MONTH).between(bounds["train_start"], bounds["oot_end"])
    )

    def known(features: DataFrame, cols: Sequence[str]) -> DataFrame:
        kept = select_present(features, ["Customer_ID", MONTH, *cols])
        kept = kept.where(F.col(MONTH) <= bounds["oot_end"])
        return last_snapshot(kept) if point_in_time else kept.drop(MONTH)

    joined = lookup_join(
        inside,
        [known(attributes, ATTRIBUTE_FEATURES), known(financials, FINANCIAL_FEATURES)],
        "Customer_ID",
    )
    return select_present(joined, [*LABEL_COLUMNS, *feature_list()])


def assemble_training_per_row(
    labels: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    train_date: str | date,
    train_months: int = TRAIN_MONTHS,
    oot_months: int = OOT_MONTHS,
    strict: bool = False,
) -> DataFrame:
    """Labels of both windows, each with the features last known on its own day (``strict``: before it).

    No label sees a later snapshot than its own, so what is trained on is what a score of that day could have used.
    Every label row is returned once.
    """
    bounds = window_columns(as_date(train_date), train_months, oot_months)
    inside = select_present(labels, LABEL_COLUMNS).where(
        F.col(MONTH).between(bounds["train_start"], bounds["oot_end"])
    )

    def known(features: DataFrame, cols: Sequence[str]) -> DataFrame:
        kept = select_present(features, ["Customer_ID", MONTH, *cols])
        return kept.where(F.col(MONTH) <= bounds["oot_end"])

    tables = [known(attributes, ATTRIBUTE_FEATURES), known(financials, FINANCIAL_FEATURES)]
    joined = asof_join(inside, tables, "Customer_ID", MONTH, strict)
    return select_present(joined, [*LABEL_COLUMNS, *feature_list()])


def last_snapshot(features: DataFrame) -> DataFrame:
    """One row per customer, of its last month; of several in that month the largest. Summed before the shuffle."""
    cols = [c for c in features.columns if c not in ("Customer_ID", MONTH)]
    last = features.groupBy("Customer_ID").agg(F.max(F.struct(MONTH, *cols)).alias("_last"))
    return last.select("Customer_ID", *[F.col("_last")[c].alias(c) for c in cols])


def assemble_scoring(attributes: DataFrame, financials: DataFrame, how: str = "inner") -> DataFrame:
    """Attributes with the financials of the same customer and month, any number of months."""
    left = select_present(attributes, ["Customer_ID", MONTH, *ATTRIBUTE_FEATURES])
    right = select_present(financials, ["Customer_ID", MONTH, *FINANCIAL_FEATURES])
    return lookup_join(left, right, ["Customer_ID", MONTH], how)


def match_predictions_to_labels(labels: DataFrame, predictions: DataFrame, lag: int = 6) -> DataFrame:
    """Labels with the prediction made ``lag`` months earlier for the same customer."""
    earlier = predictions.withColumnRenamed(MONTH, "prediction_date").withColumn(
        MONTH, F.add_months("prediction_date", lag)
    )
    return lookup_join(labels, earlier, ["Customer_ID", MONTH], "inner")


def label_feature_table(
    labels: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    as_of: str | date,
    point_in_time: bool = False,
) -> DataFrame:
    """Labels of one month with the features recorded before it, dates dropped.

    With ``point_in_time`` only the last snapshot of each customer before it counts.
    """
    day = as_date(as_of)

    def earlier(features: DataFrame, cols: Sequence[str]) -> DataFrame:
        known = features.where(F.col(MONTH) < day)
        if point_in_time:
            return last_snapshot(select_present(known, ["Customer_ID", MONTH, *cols]))
        return select_present(known, ["Customer_ID", *cols])

    on_day = labels.where(F.col(MONTH) == day).select("loan_id", "Customer_ID", "label")
    return lookup_join(
        on_day,
        [earlier(attributes, ATTRIBUTE_FEATURES), earlier(financials, FINANCIAL_FEATURES)],
        "Customer_ID",
    )


def label_with_clicks(labels: DataFrame, pivoted: DataFrame, as_of: str | date) -> DataFrame:
    return lookup_join(labels.where(F.col(MONTH) == as_date(as_of)), pivoted, "Customer_ID")


def temporal_split(
    df: DataFrame,
    train_date: str | date | Column,
    train_months: int = TRAIN_MONTHS,
    oot_months: int = OOT_MONTHS,
) -> DataFrame:
    """Tag rows ``train_test`` or ``oot`` by month; rows of neither window are dropped."""
    bounds = window_columns(as_date(train_date), train_months, oot_months)
    month = F.col(MONTH)
    window = F.when(month.between(bounds["oot_start"], bounds["oot_end"]), "oot").when(
        month.between(bounds["train_start"], bounds["train_end"]), "train_test"
    )
    return df.withColumn("window", window).where(F.col("window").isNotNull())


def label_classes(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: number of classes and whether a classifier can be trained on them."""
    return df.agg(F.count_distinct(label).alias("classes")).select(
        "classes", (F.col("classes") >= 2).alias("trainable")
    )


def check_two_classes(df: DataFrame, label: str = "label") -> None:
    if not label_classes(df, label).first()["trainable"]:
        raise ValueError("the training window holds a single label class")


def split_hash(key: Sequence[str], seed: int = SPLIT_SEED) -> Column:
    """32 hex digits that depend on the key and the seed alone."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def hash_split(
    df: DataFrame, key: Sequence[str], ratio: float = TRAIN_SHARE, seed: int = SPLIT_SEED
) -> DataFrame:
    """Row-wise train/test split without a shuffle; each class keeps its share on average."""
    bucket = F.conv(F.substring(split_hash(key, seed), 1, 8), 16, 10).cast("bigint")
    inside = bucket < int(ratio * (1 << 32))
    return df.withColumn("split", F.when(inside, "train").otherwise("test"))


def stratified_split(
    df: DataFrame,
    key: Sequence[str],
    label: str = "label",
    ratio: float = TRAIN_SHARE,
    seed: int = SPLIT_SEED,
    small: int = SMALL_GROUP,
) -> DataFrame:
    """Exact stratified split: class sizes in train follow the class shares of the data.

    Test gets ``ceil((1 - ratio) * rows)`` rows; train places go to the classes in
    proportion, left-over places to the largest remainders. Within a class, rows are
    taken in hash order up to one boundary hash per class, so the rows themselves are
    neither sorted nor shuffled. Rows with equal keys stay on one side.
    """
    # 52 bits: exact as a double as well.
    position = F.conv(F.substring(split_hash(key, seed), 1, 13), 16, 10).cast("bigint")
    hashed = df.withColumn("_h", position)
    sizes = hashed.groupBy(label).agg(F.count("*").alias("_class"))
    # One row per class from here on.
    classes = Window.partitionBy()
    total = F.sum("_class").over(classes)
    places = total - F.ceil(F.round((1 - ratio) * total, 6)).cast("bigint")
    fair = F.col("_places") * F.col("_class") / F.col("_total")
    quota = (
        sizes.withColumn("_total", total)
        .withColumn("_places", places)
        .withColumn("_floor", F.floor(fair))
        .withColumn("_left", F.col("_places") - F.sum("_floor").over(classes))
        .withColumn("_rest", F.row_number().over(classes.orderBy((fair - F.col("_floor")).desc(), label)))
        .select(
            label,
            (F.col("_floor") + F.when(F.col("_rest") <= F.col("_left"), 1).otherwise(0)).alias("_take"),
        )
    )
    last = F.col("_take") - 1
    candidates = rank_candidates(hashed, [label], "_h", [ratio], small).select(
        F.col(label).alias("_label"), F.col("_h").alias("_at"), "before", "copies"
    )
    held = (last >= F.col("before")) & (last < F.col("before") + F.col("copies"))
    # A class without places in train has no boundary; any other must have one.
    found = F.max(F.when(held, F.col("_at")))
    checked = F.when(F.col("_take") > 0, F.coalesce(found, F.raise_error(F.lit("rank outside its bracket")).cast("bigint")))
    boundary = (
        quota.join(candidates, F.col(label).eqNullSafe(F.col("_label")), "left")
        .groupBy(F.col(label).alias("_class"), "_take")
        .agg(checked.alias("_boundary"))
        .drop("_take")
    )
    out = hashed.join(F.broadcast(boundary), F.col(label).eqNullSafe(F.col("_class")), "left")
    inside = F.col("_h") <= F.col("_boundary")
    return out.withColumn("split", F.when(inside, "train").otherwise("test")).drop("_h", "_boundary", "_class")


def split_stats(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    return df.groupBy(split).agg(
        F.count("*").alias("row_count"), F.round(F.avg(label), 4).alias("label_rate")
    )


def train_date_frame(spark: SparkSession, train_date: str | date) -> DataFrame:
    return spark.range(1).select(as_date(train_date).alias(MONTH))
