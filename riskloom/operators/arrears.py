"""Loan arrears, default labels and vintage tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.months import as_date
from riskloom.operators.cleaning import enforce_schema, fill_numeric_zero
from riskloom.operators.joins import lookup_join
from riskloom.sources.schemas import LEDGER

# Last installment of a loan and the right-closed age bands.
FINAL_INSTALLMENT = 10
AGE_BANDS = [
    (20, 29, "21-29"),
    (29, 34, "30-34"),
    (34, 39, "35-39"),
    (39, 44, "40-44"),
    (44, 49, "45-49"),
    (49, 54, "50-54"),
    (54, None, "55+"),
]


def month_on_book() -> Column:
    return F.col("installment_num").cast("int")


def installments_missed(overdue: str = "overdue_amt", due: str = "due_amt") -> Column:
    """Overdue amount in installments, rounded up; nothing due or unknown counts 0."""
    return F.coalesce(F.ceil(F.try_divide(overdue, due)).try_cast("int"), F.lit(0))


# More missed installments than this lie before any date that a ledger can hold.
MAX_MISSED = 12_000


def first_missed_date() -> Column:
    """Snapshot minus the missed months; null where nothing is missed or the count is beyond all dates."""
    missed = F.col("installments_missed")
    return F.when(missed.between(1, MAX_MISSED), F.add_months("snapshot_date", -missed))


def days_past_due() -> Column:
    late = F.datediff("snapshot_date", "first_missed_date")
    return F.when(F.col("overdue_amt") > 0, late).otherwise(F.lit(0))


def add_arrears(df: DataFrame) -> DataFrame:
    """Ledger with mob, installments_missed, first_missed_date and dpd.

    Numeric nulls become 0 in the whole frame between the second and the third step.
    """
    counted = df.withColumns({"mob": month_on_book(), "installments_missed": installments_missed()})
    dated = fill_numeric_zero(counted).withColumn("first_missed_date", first_missed_date())
    return dated.withColumn("dpd", days_past_due())


def silver_loan(raw: DataFrame) -> DataFrame:
    return add_arrears(enforce_schema(raw, LEDGER))


def is_bad(dpd: int) -> Column:
    """1 from ``dpd`` days past due, else 0; unknown days past due count 0."""
    return F.when(F.col("dpd") >= dpd, 1).otherwise(0)


def label_store(ledger: DataFrame, dpd: int, mob: int) -> DataFrame:
    """Default label of every loan at ``mob`` months on book, all snapshots at once."""
    return ledger.where(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        is_bad(dpd).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date",
    )


def bad_rate_by_mob(
    ledger: DataFrame, dpd: int = 30, started_before: str | date = "2024-01-01"
) -> DataFrame:
    """Share of loans at least ``dpd`` days late per month on book."""
    return (
        ledger.where(F.col("loan_start_date") < as_date(started_before))
        .groupBy("mob")
        .agg(F.avg(is_bad(dpd)).alias("bad_rate"))
        .orderBy("mob")
    )


def actual_bads(ledger: DataFrame, final: int = FINAL_INSTALLMENT) -> DataFrame:
    """Ledger rows at the final installment."""
    return ledger.where(F.col("installment_num") == final)


def age_band(age: Column) -> Column:
    band = F.lit(None).cast("string")
    for lo, hi, name in reversed(AGE_BANDS):
        inside = age > lo if hi is None else (age > lo) & (age <= hi)
        band = F.when(inside, name).otherwise(band)
    return band


def default_rate_by_age_group(labels: DataFrame, attributes: DataFrame) -> DataFrame:
    """Mean label per age band; loans without a known age or below the bands drop out."""
    aged = lookup_join(labels, attributes.select("Customer_ID", "Age"), "Customer_ID", "left")
    return (
        aged.select("label", age_band(F.col("Age")).alias("age_group"))
        .where(F.col("age_group").isNotNull())
        .groupBy("age_group")
        .agg(F.avg("label").alias("default_rate"))
        .orderBy("age_group")
    )


def ledger_date_range(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("snapshot_date").alias("min_date"), F.max("snapshot_date").alias("max_date")
    )
