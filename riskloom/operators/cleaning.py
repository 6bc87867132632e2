"""Silver cleaning of the feeds: one projection per stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import cleaning as X
from riskloom.sources.schemas import ATTRIBUTES, CLICK_COLUMNS, CLICKSTREAM

# Column groups and caps of the financial feed.
CURRENCY_COLUMNS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Outstanding_Debt",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
]
INTEGER_COLUMNS = [
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
    "Interest_Rate",
]
FLOAT_COLUMNS = ["Changed_Credit_Limit", "Credit_Utilization_Ratio"]
OUTLIER_CAPS = {
    "Num_Bank_Accounts": 10,
    "Num_Credit_Card": 10,
    "Interest_Rate": 34,
    "Num_of_Loan": 9,
    "Num_of_Delayed_Payment": 47,
    "Num_Credit_Inquiries": 26,
}


def enforce_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns; unparsable values become null, other columns stay."""
    present = dict(df.dtypes)

    def typed(name: str):
        kind = types[name]
        return X.parse_int(name) if kind == "int" else F.col(name).try_cast(kind)

    wanted = [name for name in types if name in present and present[name] != types[name]]
    return df.withColumns({name: typed(name) for name in wanted}) if wanted else df


def clamp_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: X.clamp_negative_to_zero(c) for c in cols})


def clean_currency(df: DataFrame, cols: Sequence[str] = CURRENCY_COLUMNS, sign: str = "drop") -> DataFrame:
    return df.withColumns({c: X.clean_currency(c, sign) for c in cols})


def clean_integer(df: DataFrame, cols: Sequence[str] = INTEGER_COLUMNS, sign: str = "drop") -> DataFrame:
    return df.withColumns({c: X.clean_integer(c, sign) for c in cols})


def clean_float(df: DataFrame, cols: Sequence[str] = FLOAT_COLUMNS, sign: str = "drop") -> DataFrame:
    return df.withColumns({c: X.clean_float(c, sign) for c in cols})


def cap_outliers(df: DataFrame, caps: Mapping[str, float] = OUTLIER_CAPS) -> DataFrame:
    return df.withColumns({c: X.cap(c, limit) for c, limit in caps.items()})


def whitelist_enum(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    return df.withColumn(col, X.whitelist(col, values))


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """Null becomes 0 in every numeric column; text, dates and booleans stay."""
    return df.fillna(0)


def invalid_names(df: DataFrame, col: str = "Name") -> DataFrame:
    """Rows whose name does not match the pattern, before or after cleaning."""
    return df.where(~X.is_valid_name(col))


def invalid_ssns(df: DataFrame, col: str = "SSN") -> DataFrame:
    return df.where(~X.is_valid_ssn(col))


def clean_clickstream(df: DataFrame) -> DataFrame:
    """Typed clickstream with negative counts set to 0."""
    return clamp_negative(enforce_schema(df, CLICKSTREAM), CLICK_COLUMNS)


def clean_attributes(df: DataFrame) -> DataFrame:
    cleaned = {
        "Name": X.clean_name("Name"),
        "Age": X.clean_age("Age"),
        "SSN": X.validate_ssn("SSN"),
        "Occupation": X.clean_occupation("Occupation"),
        "snapshot_date": F.col("snapshot_date").try_cast(ATTRIBUTES["snapshot_date"]),
    }
    return df.withColumns(cleaned)


def clean_financials(df: DataFrame, sign: str = "drop") -> DataFrame:
    """Typed, capped and encoded financials with the derived ratios.

    Caps come before the ratios, so a ratio is built from capped counts.
    """
    from riskloom.operators.features import add_ratios

    typed = {
        **{c: X.clean_currency(c, sign) for c in CURRENCY_COLUMNS},
        **{c: X.clean_integer(c, sign) for c in INTEGER_COLUMNS},
        **{c: X.clean_float(c, sign) for c in FLOAT_COLUMNS},
        "Credit_History_Age": X.history_to_months("Credit_History_Age"),
        "Credit_Mix": X.encode_ordinal("Credit_Mix", X.CREDIT_MIX_LEVELS),
        "Payment_of_Min_Amount": X.encode_yes_no("Payment_of_Min_Amount"),
        "Payment_Behaviour": X.encode_ordinal("Payment_Behaviour", X.PAYMENT_BEHAVIOUR_LEVELS),
        "snapshot_date": F.col("snapshot_date").try_cast("date"),
    }
    return add_ratios(cap_outliers(df.withColumns(typed)))


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def harmonise_score_name(df: DataFrame, source: str, target: str = "prediction") -> DataFrame:
    """Rename the score column unless the target name is already taken."""
    if source in df.columns and target not in df.columns:
        return df.withColumnRenamed(source, target)
    return df
