"""Fitting and applying the model preprocessing as DataFrame expressions.

Fitted state is a small long table (feature, kind, key, value): medians, scaler moments
and the occupation codes. Medians and moments are bounded by the number of features; the codes
are a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.assemble import feature_list
from riskloom.operators.ranks import exact_quantiles, long_numeric, running_totals
from riskloom.session import stored

# Tokens and column roles of the preprocessing.
UNKNOWN = "__UNK__"
UNKNOWN_CODE = -1
CATEGORICAL = ["Occupation", "Payment_Behaviour"]
BEHAVIOUR_CODES = 6
SKEWED = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Delay_from_due_date",
    "Outstanding_Debt",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
    "Loans_per_Credit_Item",
    "Debt_to_Salary",
    "EMI_to_Salary",
    "Repayment_Ability",
    "Loan_Extent",
    "Debt_to_Income",
]


def numeric_features(features: Sequence[str]) -> list[str]:
    return [c for c in features if c not in CATEGORICAL]


def fit_medians(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """(feature, median) of the non-null values of every column in one pass.

    Exact by default; ``accuracy`` switches to a bounded-size sketch.
    """
    rows = long_numeric(df, cols)
    if accuracy is None:
        exact = exact_quantiles(rows, ["feature"], "value", [0.5])
        return exact.select("feature", F.get("quantiles", F.lit(0)).alias("median"))
    return rows.groupBy("feature").agg(
        F.percentile_approx("value", 0.5, accuracy).alias("median")
    )


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Numeric columns as double with nulls, NaN and unparsable text replaced."""
    return df.withColumns({c: imputed(c, m) for c, m in medians.items()})


def imputed(c: str, median: float | Column) -> Column:
    number = F.nullif(F.col(c).try_cast("double"), F.lit(float("nan")))
    return F.coalesce(number, median if isinstance(median, Column) else F.lit(median))


def fill_category_null(df: DataFrame, cols: Sequence[str] = CATEGORICAL) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)) for c in cols})


def fit_ordinal(df: DataFrame, col: str) -> DataFrame:
    """(value, code): sorted distinct values numbered from 0, the unknown token is -1.

    One row per level; the ordering runs over the levels, not over the rows. Where the
    data holds nulls the token takes a place in the numbering.
    """
    levels = df.select(F.coalesce(F.col(col), F.lit(UNKNOWN)).alias("value")).distinct()
    # The number of smaller levels; ranges of levels are ordered side by side.
    ones = levels.withColumn("n", F.lit(1).cast("bigint"))
    levels = running_totals(ones, [], "value", ["n"])
    position = F.col("n_before").cast("int")
    code = F.when(F.col("value") == UNKNOWN, UNKNOWN_CODE).otherwise(position)
    unknown = df.sparkSession.range(1).select(
        F.lit(UNKNOWN).alias("value"), F.lit(UNKNOWN_CODE).alias("code")
    )
    return levels.select("value", code.alias("code")).unionAll(unknown).distinct()


def apply_ordinal(df: DataFrame, col: str, codes: DataFrame | Mapping[str, int]) -> DataFrame:
    """Replace values with their codes; unseen values and nulls become -1."""
    value = F.coalesce(F.col(col), F.lit(UNKNOWN))
    if isinstance(codes, Mapping):
        return df.withColumn(col, ordinal_code(value, codes))
    table = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    return (
        df.join(table, value == F.col("_value"), "left")
        .withColumn(col, F.coalesce("_code", F.lit(UNKNOWN_CODE)))
        .drop("_value", "_code")
    )


def ordinal_code(value: Column, codes: Mapping[str, int]) -> Column:
    """Code of a value from a fixed mapping, as one literal map lookup."""
    if not codes:
        return F.lit(UNKNOWN_CODE)
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(UNKNOWN_CODE))


def behaviour_code(c: Column | str) -> Column:
    """Codes 0..5 pass through, everything else including null is -1."""
    code = F.col(c) if isinstance(c, str) else c
    code = code.try_cast("int")
    known = code.between(0, BEHAVIOUR_CODES - 1)
    return F.when(known, code).otherwise(F.lit(UNKNOWN_CODE))


def log1p_clipped(c: Column | str) -> Column:
    """``ln(1 + max(x, 0))``; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.log1p(F.when(c < 0, F.lit(0.0)).otherwise(c))


def log1p_skewed(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    numeric = numeric_features(features or feature_list())
    return df.withColumns({c: log1p_clipped(c) for c in SKEWED if c in numeric})


def fit_standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, mean, std) with the population deviation; a zero deviation becomes 1."""
    stats = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
            for i, c in enumerate(cols)
        ]
    )
    scale = F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std"))
    return stats.select(F.inline(rows)).select("feature", "mean", scale.alias("std"))


def standardised(c: str, mean: float | Column, std: float | Column) -> Column:
    return (F.col(c) - mean) / std


@dataclass
class Preprocessor:
    """Fitted state as plain numbers, a few per feature."""

    features: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    #: (value, code) as a table: it grows with the levels of the category.
    occupation_codes: DataFrame | None = None
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)

    def prepare(self, df: DataFrame) -> DataFrame:
        """Everything up to, but without, the scaling."""
        numeric = numeric_features(self.features)
        medians = {c: self.medians.get(c, float("nan")) for c in numeric}
        columns = {c: imputed(c, m) for c, m in medians.items()}
        columns.update({c: log1p_clipped(columns[c]) for c in SKEWED if c in columns})
        if "Payment_Behaviour" in self.features:
            columns["Payment_Behaviour"] = behaviour_code("Payment_Behaviour")
        out = df.withColumns(columns)
        if "Occupation" in self.features:
            out = apply_ordinal(out, "Occupation", self.occupation_codes if self.occupation_codes is not None else {})
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Model inputs in feature order; all other columns are passed through first."""
        others = [c for c in df.columns if c not in self.features]
        scaled = [standardised(c, *map(F.lit, self.scale[c])).alias(c) for c in self.features]
        return self.prepare(df).select(*others, *scaled)


def fit_preprocessor(train: DataFrame, features: Sequence[str] | None = None) -> Preprocessor:
    """Medians and categories in one pass over the training rows, scaler in a second one.

    What reaches the driver is a few numbers per feature; the codes of the levels stay a table.
    """
    fitted = Preprocessor([c for c in (features or feature_list()) if c in train.columns])
    numeric = numeric_features(fitted.features)
    fitted.medians = {r["feature"]: r["median"] for r in fit_medians(train, numeric).toLocalIterator()}
    if "Occupation" in fitted.features:
        fitted.occupation_codes = stored(fit_ordinal(train, "Occupation"), "codes")
    moments = fit_standardise(fitted.prepare(train), fitted.features)
    fitted.scale = {r["feature"]: (r["mean"], r["std"]) for r in moments.toLocalIterator()}
    return fitted
