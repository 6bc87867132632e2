"""C1..C23: cleaning expressions on dirty text."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import cleaning as X
from riskloom.operators import cleaning as C
from riskloom.sources.schemas import LEDGER
from riskloom.workload import views as V
from riskloom.workload.registry import query
from riskloom.workload.views import _currency, _float, _integer

_INT = "TRY_CAST(regexp_replace({0}, '\\.[0-9]*$', '') AS INTEGER) AS {0}"


@query(
    "c1_enforce_schema",
    f"""SELECT loan_id, "Customer_ID", TRY_CAST(loan_start_date AS DATE) AS loan_start_date,
  {_INT.format("tenure")}, {_INT.format("installment_num")}, TRY_CAST(loan_amt AS DOUBLE) AS loan_amt,
  TRY_CAST(due_amt AS DOUBLE) AS due_amt, TRY_CAST(paid_amt AS DOUBLE) AS paid_amt,
  TRY_CAST(overdue_amt AS DOUBLE) AS overdue_amt, TRY_CAST(balance AS DOUBLE) AS balance,
  TRY_CAST(snapshot_date AS DATE) AS snapshot_date FROM ledger_text""",
    ["ledger_text"],
)
def _(spark, sf):
    return C.enforce_schema(V.ledger_text(spark, sf), LEDGER)


@query("c2_clamp_negative", "SELECT * FROM silver_clicks", ["silver_clicks"])
def _(spark, sf):
    return C.clamp_negative(V.clicks(spark, sf), C.CLICK_COLUMNS)


@query(
    "c3_clean_name",
    """SELECT "Customer_ID", trim(regexp_replace("Name", '[^A-Za-z .''-]', '', 'g')) AS "Name" FROM attrs_text""",
    ["attrs_text"],
)
def _(spark, sf):
    return V.attrs_text(spark, sf).select("Customer_ID", X.clean_name("Name").alias("Name"))


@query(
    "c3v_valid_flags",
    """SELECT "Customer_ID", regexp_matches("Name", '^[A-Za-z][A-Za-z .''-]*[A-Za-z]?$') AS is_valid_name,
  regexp_matches("SSN", '^[0-9]{3}-[0-9]{2}-[0-9]{4}$') AS is_valid_ssn FROM attrs_text""",
    ["attrs_text"],
)
def _(spark, sf):
    return V.attrs_text(spark, sf).select(
        "Customer_ID",
        X.is_valid_name("Name").alias("is_valid_name"),
        X.is_valid_ssn("SSN").alias("is_valid_ssn"),
    )


_BAD_NAME = """NOT regexp_matches("Name", '^[A-Za-z][A-Za-z .''-]*[A-Za-z]?$')"""


@query(
    "c3v_invalid_rows",
    f"""SELECT 'name before' AS failed, "Customer_ID", "Name" AS value FROM attrs_text WHERE {_BAD_NAME}
UNION ALL SELECT 'name after', "Customer_ID", "Name" FROM attrs WHERE {_BAD_NAME}
UNION ALL SELECT 'ssn before', "Customer_ID", "SSN" FROM attrs_text
  WHERE NOT regexp_matches("SSN", '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$')""",
    ["attrs_text", "attrs"],
)
def _(spark, sf):
    raw, silver = V.attrs_text(spark, sf), V.attrs(spark, sf)
    parts = [
        ("name before", C.invalid_names(raw), "Name"),
        ("name after", C.invalid_names(silver), "Name"),
        ("ssn before", C.invalid_ssns(raw), "SSN"),
        ("ssn after", C.invalid_ssns(silver), "SSN"),
    ]
    out = None
    for failed, rows, col in parts:
        one = rows.select(F.lit(failed).alias("failed"), "Customer_ID", F.col(col).alias("value"))
        out = one if out is None else out.unionAll(one)
    return out


@query("c4_clean_age", 'SELECT "Customer_ID", "Age" FROM attrs', ["attrs"])
def _(spark, sf):
    return V.attrs_text(spark, sf).select("Customer_ID", X.clean_age("Age").alias("Age"))


@query("c5_validate_ssn", 'SELECT "Customer_ID", "SSN" FROM attrs', ["attrs"])
def _(spark, sf):
    return V.attrs_text(spark, sf).select("Customer_ID", X.validate_ssn("SSN").alias("SSN"))


@query("c6_clean_occupation", 'SELECT "Customer_ID", "Occupation" FROM attrs', ["attrs"])
def _(spark, sf):
    return V.attrs_text(spark, sf).select("Customer_ID", X.clean_occupation("Occupation").alias("Occupation"))


@query(
    "c7_clean_currency",
    'SELECT "Customer_ID", ' + ", ".join(_currency(c) for c in C.CURRENCY_COLUMNS) + " FROM fins_text",
    ["fins_text"],
)
def _(spark, sf):
    return C.clean_currency(V.fins_text(spark, sf)).select("Customer_ID", *C.CURRENCY_COLUMNS)


@query(
    "c7_clean_currency_sign_null",
    """SELECT "Customer_ID", CASE WHEN NOT regexp_matches("Outstanding_Debt", '-\\s*[0-9.]')
    THEN ROUND(TRY_CAST(regexp_replace("Outstanding_Debt", '[^0-9.]', '', 'g') AS DOUBLE), 3) END AS "Outstanding_Debt",
  CASE WHEN NOT regexp_matches("Monthly_Balance", '-\\s*[0-9.]')
    THEN ROUND(TRY_CAST(regexp_replace("Monthly_Balance", '[^0-9.]', '', 'g') AS DOUBLE), 3) END AS "Monthly_Balance"
FROM fins_text""",
    ["fins_text"],
)
def _(spark, sf):
    cols = ["Outstanding_Debt", "Monthly_Balance"]
    return C.clean_currency(V.fins_text(spark, sf), cols, sign="null").select("Customer_ID", *cols)


@query(
    "c8_clean_integer",
    'SELECT "Customer_ID", ' + ", ".join(_integer(c) for c in C.INTEGER_COLUMNS) + " FROM fins_text",
    ["fins_text"],
)
def _(spark, sf):
    return C.clean_integer(V.fins_text(spark, sf)).select("Customer_ID", *C.INTEGER_COLUMNS)


@query("c9_history_to_months", 'SELECT "Customer_ID", "Credit_History_Age" FROM fins', ["fins"])
def _(spark, sf):
    return V.fins_text(spark, sf).select(
        "Customer_ID", X.history_to_months("Credit_History_Age").alias("Credit_History_Age")
    )


@query(
    "c10_clean_float",
    'SELECT "Customer_ID", ' + ", ".join(_float(c) for c in C.FLOAT_COLUMNS) + " FROM fins_text",
    ["fins_text"],
)
def _(spark, sf):
    return C.clean_float(V.fins_text(spark, sf)).select("Customer_ID", *C.FLOAT_COLUMNS)


@query(
    "c11_cap_outliers",
    'SELECT "Customer_ID", ' + ", ".join(_integer(c, cap) for c, cap in C.OUTLIER_CAPS.items()) + " FROM fins_text",
    ["fins_text"],
)
def _(spark, sf):
    typed = C.clean_integer(V.fins_text(spark, sf))
    return C.cap_outliers(typed).select("Customer_ID", *C.OUTLIER_CAPS)


@query(
    "c12_whitelist_enum",
    """SELECT "Customer_ID", CASE WHEN "Credit_Mix" IN ('Bad', 'Standard', 'Good') THEN "Credit_Mix" END AS "Credit_Mix",
  NULLIF("Payment_Behaviour", '!@9#%8') AS "Payment_Behaviour" FROM fins_text""",
    ["fins_text"],
)
def _(spark, sf):
    kept = C.whitelist_enum(V.fins_text(spark, sf), "Credit_Mix", X.CREDIT_MIX_LEVELS)
    kept = C.whitelist_enum(kept, "Payment_Behaviour", X.PAYMENT_BEHAVIOUR_LEVELS)
    return kept.select("Customer_ID", "Credit_Mix", "Payment_Behaviour")


@query("c13_encode_credit_mix", 'SELECT "Customer_ID", "Credit_Mix" FROM fins', ["fins"])
def _(spark, sf):
    code = X.encode_ordinal("Credit_Mix", X.CREDIT_MIX_LEVELS)
    return V.fins_text(spark, sf).select("Customer_ID", code.alias("Credit_Mix"))


@query("c14_encode_yes_no", 'SELECT "Customer_ID", "Payment_of_Min_Amount" FROM fins', ["fins"])
def _(spark, sf):
    flag = X.encode_yes_no("Payment_of_Min_Amount")
    return V.fins_text(spark, sf).select("Customer_ID", flag.alias("Payment_of_Min_Amount"))


@query("c15_encode_payment_behaviour", 'SELECT "Customer_ID", "Payment_Behaviour" FROM fins', ["fins"])
def _(spark, sf):
    code = X.encode_ordinal("Payment_Behaviour", X.PAYMENT_BEHAVIOUR_LEVELS)
    return V.fins_text(spark, sf).select("Customer_ID", code.alias("Payment_Behaviour"))


@query(
    "c16_fill_numeric_zero",
    """SELECT loan_id, "Customer_ID", loan_start_date, tenure, installment_num, loan_amt,
  COALESCE(due_amt, 0) AS due_amt, paid_amt, overdue_amt, balance, snapshot_date FROM ledger""",
    ["ledger"],
)
def _(spark, sf):
    return C.fill_numeric_zero(V.ledger(spark, sf))


@query("c17_clean_attributes", "SELECT * FROM attrs", ["attrs"])
def _(spark, sf):
    return V.attrs(spark, sf)


@query("c18_clean_financials", "SELECT * FROM fins", ["fins"],
       ["Loans_per_Credit_Item", "Debt_to_Salary", "EMI_to_Salary", "Repayment_Ability"])
def _(spark, sf):
    return V.fins(spark, sf)


_DIRTY_CLICKS = ", ".join(
    f"CASE WHEN fe_{i} < 0 THEN 0 ELSE fe_{i} END AS fe_{i}" if i != 3 else
    'CASE WHEN CAST("Customer_ID" AS BIGINT) % 11 <> 0 THEN CASE WHEN fe_3 < 0 THEN 0 ELSE fe_3 END END AS fe_3'
    for i in range(1, 21)
)


@query("c19_clean_clickstream", f'SELECT {_DIRTY_CLICKS}, "Customer_ID", snapshot_date FROM clicks', ["clicks"])
def _(spark, sf):
    return C.clean_clickstream(V.clicks_text(spark, sf))


@query("c20_strip_column_names", "SELECT * FROM scores", ["scores"])
def _(spark, sf):
    rows = V.scores(spark, sf)
    return C.strip_column_names(rows.toDF(*[f" {c}  " for c in rows.columns]))


@query(
    "c21_harmonise_score_name",
    """SELECT "Customer_ID", snapshot_date, model_name, model_predictions AS prediction FROM scores""",
    ["scores"],
)
def _(spark, sf):
    return C.harmonise_score_name(V.scores(spark, sf), "model_predictions")


@query(
    "c22_normalise_snapshot_string",
    """SELECT loan_id, installment_num, strftime(TRY_CAST(loan_start_date AS DATE), '%Y-%m-%d') AS snapshot_date
FROM ledger_text""",
    ["ledger_text"],
)
def _(spark, sf):
    return V.ledger_text(spark, sf).select(
        "loan_id", "installment_num", X.normalise_snapshot_string("loan_start_date").alias("snapshot_date")
    )


@query(
    "c23_numeric_or_null",
    """SELECT loan_id, installment_num, TRY_CAST(due_amt AS DOUBLE) AS due_amt, TRY_CAST(tenure AS DOUBLE) AS tenure
FROM ledger_text""",
    ["ledger_text"],
)
def _(spark, sf):
    return V.ledger_text(spark, sf).select(
        "loan_id",
        "installment_num",
        X.numeric_or_null("due_amt").alias("due_amt"),
        X.numeric_or_null("tenure").alias("tenure"),
    )
