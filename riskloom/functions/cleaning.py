"""Column expressions that clean raw text. All of them are built-in Spark expressions.

Every cast is a ``try_cast``: one dirty row yields null instead of failing the job,
whatever the session's ANSI setting.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Validity patterns, placeholder tokens and category orders of the feeds.
NAME_PATTERN = r"^[A-Za-z][A-Za-z .'-]*[A-Za-z]?$"
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
BLANK_OCCUPATION = "_______"
CREDIT_MIX_LEVELS = ("Bad", "Standard", "Good")
PAYMENT_BEHAVIOUR_LEVELS = (
    "Low_spent_Small_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Large_value_payments",
    "High_spent_Small_value_payments",
    "High_spent_Medium_value_payments",
    "High_spent_Large_value_payments",
)
MAX_AGE = 100


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(c: Column | str) -> Column:
    """Text or number to int; a decimal fraction is cut off, anything unparsable is null.

    The pattern only runs on text that is not an integer already.
    """
    text = _col(c).cast("string")
    return F.coalesce(text.try_cast("int"), F.regexp_replace(text, r"\.\d*$", "").try_cast("int"))


def clamp_negative_to_zero(c: Column | str) -> Column:
    """Negative values become 0 and null stays null (``greatest`` would turn null into 0)."""
    c = _col(c)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def clean_name(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"[^A-Za-z .'-]", ""))


def is_valid_name(c: Column | str) -> Column:
    return _col(c).rlike(NAME_PATTERN)


def is_valid_ssn(c: Column | str) -> Column:
    return _col(c).rlike(SSN_PATTERN)


def clean_age(c: Column | str) -> Column:
    age = F.regexp_replace(_col(c).cast("string"), r"\D", "").try_cast("int")
    return F.when(age.between(0, MAX_AGE), age)


def validate_ssn(c: Column | str) -> Column:
    c = _col(c)
    return F.when(is_valid_ssn(c), c)


def clean_occupation(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c == BLANK_OCCUPATION, F.lit(None)).when(
        c == "Media_Manager", F.lit("Media Manager")
    ).otherwise(c)


def _unsigned(c: Column, pattern: str, sign: str) -> Column:
    """Text with everything outside ``pattern`` removed.

    ``sign='drop'`` loses a leading minus along with the other characters;
    ``sign='null'`` gives null for such a value.
    """
    if sign not in ("drop", "null"):
        raise ValueError("sign must be 'drop' or 'null'")
    text = c.cast("string")
    kept = F.regexp_replace(text, pattern, "")
    return kept if sign == "drop" else F.when(~text.rlike(r"-\s*[\d.]"), kept)


def clean_currency(c: Column | str, sign: str = "drop") -> Column:
    return F.round(_unsigned(_col(c), r"[^\d.]", sign).try_cast("double"), 3)


def clean_integer(c: Column | str, sign: str = "drop") -> Column:
    return _unsigned(_col(c), r"[^\d]", sign).try_cast("int")


def clean_float(c: Column | str, sign: str = "drop") -> Column:
    return _unsigned(_col(c), r"[^\d.]", sign).try_cast("double")


def history_to_months(c: Column | str) -> Column:
    """``22 Years and 1 Months`` to 265; text that does not start that way is null."""
    c = _col(c)
    pattern = r"^(\d+) Years and (\d+) Months"
    years = F.regexp_extract(c, pattern, 1).try_cast("int")
    months = F.regexp_extract(c, pattern, 2).try_cast("int")
    return F.when(c.rlike(pattern), F.try_add(F.try_multiply(years, F.lit(12)), months))


def cap(c: Column | str, limit: float) -> Column:
    """Values above ``limit`` become ``limit``; null stays null (``least`` skips nulls)."""
    c = _col(c)
    return F.when(c > limit, F.lit(limit)).otherwise(c)


def whitelist(c: Column | str, values: Iterable[str]) -> Column:
    c = _col(c)
    return F.when(c.isin(list(values)), c)


def encode_ordinal(c: Column | str, levels: Sequence[str]) -> Column:
    """Position of the value in ``levels``; values outside it are null."""
    position = F.array_position(F.array(*[F.lit(v) for v in levels]), _col(c))
    return F.when(position > 0, position - 1).cast("int")


def encode_yes_no(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c == "Yes", F.lit(True)).when(c == "No", F.lit(False))


def normalise_snapshot_string(c: Column | str) -> Column:
    return F.date_format(_col(c).try_cast("date"), "yyyy-MM-dd")


def numeric_or_null(c: Column | str) -> Column:
    """Anything to double; unparsable text and NaN are null."""
    return F.nullif(_col(c).try_cast("double"), F.lit(float("nan")))
