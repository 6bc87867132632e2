"""Feature store: derived ratios, customer risk features and click engagement."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.months import as_date, months_before
from riskloom.sources.tables import read_lagged

# Columns of the customer risk feature table.
RISK_COLUMNS = [
    "Customer_ID",
    "snapshot_date",
    "Credit_History_Age",
    "Num_Fin_Pdts",
    "EMI_to_Salary",
    "Debt_to_Salary",
    "Repayment_Ability",
    "Loans_per_Credit_Item",
    "Loan_Extent",
    "Outstanding_Debt",
    "Interest_Rate",
    "Delay_from_due_date",
    "Changed_Credit_Limit",
]


def num_fin_pdts() -> Column:
    return F.col("Num_Bank_Accounts") + F.col("Num_Credit_Card") + F.col("Num_of_Loan")


def loans_per_credit_item() -> Column:
    items = F.col("Num_Bank_Accounts") + F.col("Num_Credit_Card") + 1
    return F.try_divide(F.col("Num_of_Loan"), items)


def debt_to_salary() -> Column:
    return F.try_divide(F.col("Outstanding_Debt"), F.col("Monthly_Inhand_Salary") + 1)


def emi_to_salary() -> Column:
    return F.try_divide(F.col("Total_EMI_per_month"), F.col("Monthly_Inhand_Salary") + 1)


def repayment_ability() -> Column:
    return F.col("Monthly_Inhand_Salary") - F.col("Total_EMI_per_month")


def loan_extent() -> Column:
    return F.try_multiply(F.col("Delay_from_due_date"), F.col("Num_of_Loan"))


def debt_to_income() -> Column:
    return F.try_divide(F.col("Outstanding_Debt"), F.col("Annual_Income"))


def add_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "Num_Fin_Pdts": num_fin_pdts(),
            "Loans_per_Credit_Item": loans_per_credit_item(),
            "Debt_to_Salary": debt_to_salary(),
            "EMI_to_Salary": emi_to_salary(),
            "Repayment_Ability": repayment_ability(),
            "Loan_Extent": loan_extent(),
        }
    )


def add_debt_to_income(df: DataFrame) -> DataFrame:
    """The ratio is added only where it is absent; it is not one of the model features."""
    if "Debt_to_Income" in df.columns:
        return df
    return df.withColumn("Debt_to_Income", debt_to_income())


def customer_risk_features(silver: DataFrame) -> DataFrame:
    return silver.select(*RISK_COLUMNS)


def _click(offset: Column, i: int, feature: str) -> Column:
    return F.min(F.when(offset == i, F.col(feature))).alias(f"click_{i}m")


def engagement_features(
    clicks: DataFrame, as_of: str | date, months: int = 6, feature: str = "fe_1"
) -> DataFrame:
    """Clicks of each of the ``months`` previous months, one row per customer seen in them.

    Every column is present even when a month has no data. Duplicate rows of a customer in
    a month count with their smallest value.
    """
    lagged = read_lagged(clicks, as_of, months)
    ago = F.col("months_ago")
    wide = lagged.groupBy("Customer_ID").agg(*[_click(ago, i, feature) for i in range(1, months + 1)])
    columns = [f"click_{i}m" for i in range(1, months + 1)]
    return wide.select("Customer_ID", as_date(as_of).alias("snapshot_date"), *columns)


def engagement_features_all(
    clicks: DataFrame,
    lo: str | date,
    hi: str | date,
    months: int = 6,
    feature: str = "fe_1",
) -> DataFrame:
    """:func:`engagement_features` of every month from ``lo`` to ``hi`` in one job.

    Rows first shrink to one per customer and month, then each of them serves the following
    ``months`` target months. The reduced rows are partitioned by customer once and the
    copies for the target months are made and combined inside that partitioning.
    """
    lo, hi = as_date(lo), as_date(hi)
    month = F.col("snapshot_date")
    useful = clicks.where((month >= F.add_months(lo, -months)) & (month < hi))
    reduced = (
        useful.groupBy("Customer_ID", "snapshot_date")
        .agg(F.min(feature).alias(feature))
        .repartition("Customer_ID")
    )
    steps = F.explode(F.sequence(F.lit(1), F.lit(months))).alias("months_ago")
    served = reduced.select("Customer_ID", "snapshot_date", feature, steps).select(
        "Customer_ID",
        F.add_months("snapshot_date", F.col("months_ago")).alias("target"),
        "months_ago",
        feature,
    )
    ago = F.col("months_ago")
    wide = (
        served.where(F.col("target").between(lo, hi))
        .groupBy("Customer_ID", "target")
        .agg(*[_click(ago, i, feature) for i in range(1, months + 1)])
    )
    return wide.withColumnRenamed("target", "snapshot_date")


def clickstream_pivot(
    clicks: DataFrame, as_of: str | date, months: int = 6, feature: str = "fe_1"
) -> DataFrame:
    """Clicks in ``[as_of - months, as_of)`` by calendar-month distance, one row per customer."""
    day = as_date(as_of)
    window = clicks.where(
        (F.col("snapshot_date") < day) & (F.col("snapshot_date") >= F.add_months(day, -months))
    ).withColumn("ago", months_before(day, F.col("snapshot_date")))
    return window.groupBy("Customer_ID").agg(
        *[_click(F.col("ago"), i, feature) for i in range(1, months + 1)]
    )


def clickstream_pivot_daily(
    clicks: DataFrame, as_of: str | date, days: int = 6, feature: str = "fe_1"
) -> DataFrame:
    """The same pivot with days instead of months, for daily feeds."""
    day = as_date(as_of)
    window = clicks.where(
        (F.col("snapshot_date") < day) & (F.col("snapshot_date") >= F.date_sub(day, days))
    ).withColumn("ago", F.datediff(day, F.col("snapshot_date")))
    return window.groupBy("Customer_ID").agg(
        *[
            F.min(F.when(F.col("ago") == i, F.col(feature))).alias(f"click_{i}d")
            for i in range(1, days + 1)
        ]
    )


def features_before(features: DataFrame, as_of: str | date) -> DataFrame:
    """Feature rows strictly before the analysis date."""
    return features.where(F.col("snapshot_date") < as_date(as_of))


def labels_on(labels: DataFrame, as_of: str | date) -> DataFrame:
    return labels.where(F.col("snapshot_date") == as_date(as_of))


def customer_records(features: DataFrame, customer: str) -> DataFrame:
    return features.where(F.col("Customer_ID") == customer)
