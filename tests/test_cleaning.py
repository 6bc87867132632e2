"""Dirty-value catalogue: input, expected result."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions import cleaning as X
from riskloom.operators import cleaning as C

CASES = [
    (X.clean_name, ['"Ann', "Bo#b 9 ", None, "123", "O'Neil-Smith Jr."], ["Ann", "Bob", None, "", "O'Neil-Smith Jr."]),
    (X.clean_age, ["41_", "-500", "2329_", "-5", "100", "", None, "101"], [41, None, None, 5, 100, None, None, None]),
    (X.validate_ssn, ["123-45-6789", "#F%$D@*&8", "123-456-789", None], ["123-45-6789", None, None, None]),
    (X.clean_occupation, ["_______", "Media_Manager", "Lawyer", None], [None, "Media Manager", "Lawyer", None]),
    (
        X.clean_currency,
        ["34847.84_", "__10000__", "-12.3456", "__-333333333333333333333333333__", "_", "1.2.3", "", None],
        [34847.84, 10000.0, 12.346, 3.3333333333333333e26, None, None, None, None],
    ),
    (lambda c: X.clean_currency(c, sign="null"), ["-12.5", "12.5", "a-b 3"], [None, 12.5, 3.0]),
    (X.clean_integer, ["3_", "-100", "1496", "_", "99999999999", "3.0"], [3, 100, 1496, None, None, 30]),
    (lambda c: X.clean_integer(c, sign="null"), ["-100", "100"], [None, 100]),
    (lambda c: X.cap(X.clean_integer(c), 9), ["3_", "-100", "1496", "_"], [3, 9, 9, None]),
    (
        X.history_to_months,
        ["22 Years and 1 Months", "5 Years", "NA", "1 Years and 2 Months x", "x 1 Years and 2 Months", None],
        [265, None, None, 14, None, None],
    ),
    (X.clean_float, ["_", "-6.27", "8.1_"], [None, 6.27, 8.1]),
    (lambda c: X.encode_ordinal(c, X.CREDIT_MIX_LEVELS), ["Good", "_", "Bad", "Standard", None], [2, None, 0, 1, None]),
    (X.encode_yes_no, ["Yes", "No", "NM", None], [True, False, None, None]),
    (
        lambda c: X.encode_ordinal(c, X.PAYMENT_BEHAVIOUR_LEVELS),
        ["!@9#%8", "High_spent_Large_value_payments", "Low_spent_Small_value_payments"],
        [None, 5, 0],
    ),
    (X.parse_int, ["7", "7.9", "", "x", None, "99999999999"], [7, 7, None, None, None, None]),
    (X.numeric_or_null, ["1.5", "NaN", "x", None], [1.5, None, None, None]),
    (X.normalise_snapshot_string, ["2024-03-01", "2024-3-1", "bad"], ["2024-03-01", "2024-03-01", None]),
    (X.is_valid_name, ["Ann", "Bo#b", "", None, "A"], [True, False, False, None, True]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_expression(spark, case):
    expression, given, expected = CASES[case]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    got = [r["out"] for r in rows.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]
    assert got == expected


def test_clamp_keeps_null(spark):
    rows = spark.createDataFrame([(-7,), (0,), (3,), (None,)], "v int")
    assert [r[0] for r in C.clamp_negative(rows, ["v"]).collect()] == [0, 0, 3, None]


@pytest.mark.parametrize(
    "expression", [X.clean_name, X.clean_age, X.validate_ssn, X.clean_occupation, lambda c: X.cap(c.try_cast("int"), 9)]
)
def test_cleaning_twice_changes_nothing(spark, expression):
    given = ['"Ann ', "41_", "123-45-6789", "_______", "Media_Manager", "", None, " a9 ", "200"]
    once = spark.createDataFrame([(v,) for v in given], "v string").select(expression(F.col("v")).cast("string").alias("v"))
    twice = once.select("v", expression(F.col("v")).cast("string").alias("w"))
    assert all(r["v"] == r["w"] for r in twice.collect())


def test_strip_and_harmonise_names(spark):
    rows = spark.createDataFrame([(1.0, 2)], [" model_predictions ", "x"])
    stripped = C.strip_column_names(rows)
    assert stripped.columns == ["model_predictions", "x"]
    renamed = C.harmonise_score_name(stripped, "model_predictions")
    assert renamed.columns == ["prediction", "x"]
    both = stripped.withColumn("prediction", F.lit(0.0))
    assert C.harmonise_score_name(both, "model_predictions").columns == both.columns
