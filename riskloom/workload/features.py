"""F1..F11 and J1..J8: feature store, joins and slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import assemble as A
from riskloom.operators import drift as D
from riskloom.operators import features as E
from riskloom.workload import views as V
from riskloom.workload.registry import query

_RATIOS = {
    "f1_num_fin_pdts": ("Num_Fin_Pdts", E.num_fin_pdts),
    "f2_loans_per_credit_item": ("Loans_per_Credit_Item", E.loans_per_credit_item),
    "f3_debt_to_salary": ("Debt_to_Salary", E.debt_to_salary),
    "f4_emi_to_salary": ("EMI_to_Salary", E.emi_to_salary),
    "f5_repayment_ability": ("Repayment_Ability", E.repayment_ability),
    "f6_loan_extent": ("Loan_Extent", E.loan_extent),
}


def _ratio(name, column, expression):
    whole = column in ("Num_Fin_Pdts", "Loan_Extent")

    @query(name, f'SELECT "Customer_ID", "{column}" FROM fins', ["fins"], [] if whole else [column])
    def _(spark, sf):
        return V.fins(spark, sf).select("Customer_ID", expression().alias(column))


for _name, (_column, _expression) in _RATIOS.items():
    _ratio(_name, _column, _expression)


@query(
    "f7_customer_risk_features",
    "SELECT " + ", ".join(f'"{c}"' for c in E.RISK_COLUMNS) + " FROM fins",
    ["fins"],
    ["EMI_to_Salary", "Debt_to_Salary", "Repayment_Ability", "Loans_per_Credit_Item"],
)
def _(spark, sf):
    return E.customer_risk_features(V.fins(spark, sf))


def _click_sql(unit: str, letter: str, ago: str, n: int = 6) -> str:
    return ", ".join(f"min(fe_1) FILTER ({ago} = {i}) AS click_{i}{letter}" for i in range(1, n + 1))


_AGO = "datediff('month', snapshot_date, DATE '1997-06-01')"


@query(
    "f8_engagement_features",
    f"""SELECT "Customer_ID", DATE '1997-06-01' AS snapshot_date, {_click_sql("month", "m", _AGO)}
FROM clicks WHERE snapshot_date BETWEEN DATE '1996-12-01' AND DATE '1997-05-01' GROUP BY 1""",
    ["clicks"],
)
def _(spark, sf):
    return E.engagement_features(V.clicks(spark, sf), "1997-06-01")


@query(
    "f8b_engagement_features_all",
    f"""SELECT "Customer_ID", CAST(snapshot_date + to_months(i) AS DATE) AS snapshot_date,
  {", ".join(f"min(fe_1) FILTER (i = {i}) AS click_{i}m" for i in range(1, 7))}
FROM clicks, (SELECT unnest([1, 2, 3, 4, 5, 6]) AS i) AS steps
WHERE CAST(snapshot_date + to_months(i) AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-08-01'
GROUP BY 1, 2""",
    ["clicks"],
)
def _(spark, sf):
    return E.engagement_features_all(V.clicks(spark, sf), "1995-01-01", "2001-08-01")


@query(
    "f9_clickstream_pivot",
    f"""SELECT "Customer_ID", {_click_sql("month", "m", _AGO)}
FROM clicks WHERE snapshot_date >= DATE '1996-12-01' AND snapshot_date < DATE '1997-06-01' GROUP BY 1""",
    ["clicks"],
)
def _(spark, sf):
    return E.clickstream_pivot(V.clicks(spark, sf), "1997-06-01", 6)


_DAYS = "datediff('day', snapshot_date, DATE '2024-01-20')"


@query(
    "f9_clickstream_pivot_daily",
    f"""SELECT "Customer_ID", {_click_sql("day", "d", _DAYS)}
FROM clicks_daily WHERE snapshot_date >= DATE '2024-01-14' AND snapshot_date < DATE '2024-01-20' GROUP BY 1""",
    ["clicks_daily"],
)
def _(spark, sf):
    return E.clickstream_pivot_daily(V.clicks_daily(spark, sf), "2024-01-20", 6)


@query(
    "f10_debt_to_income",
    """SELECT "Customer_ID", "Outstanding_Debt" / NULLIF("Annual_Income", 0) AS "Debt_to_Income" FROM fins""",
    ["fins"],
    ["Debt_to_Income"],
)
def _(spark, sf):
    return E.add_debt_to_income(V.fins(spark, sf)).select("Customer_ID", "Debt_to_Income")


@query(
    "f11_analysis_slice",
    """SELECT 'features' AS part, "Customer_ID", snapshot_date, fe_1 AS value FROM clicks WHERE snapshot_date < DATE '1998-06-01'
UNION ALL SELECT 'labels', "Customer_ID", snapshot_date, label FROM label_rows WHERE snapshot_date = DATE '1998-06-01'
UNION ALL SELECT 'customer', "Customer_ID", snapshot_date, fe_1 FROM clicks WHERE "Customer_ID" = '17'""",
    ["clicks", "label_rows"],
)
def _(spark, sf):
    clicks, labels = V.clicks(spark, sf), V.labels_silver(spark, sf)
    parts = [
        ("features", E.features_before(clicks, "1998-06-01"), "fe_1"),
        ("labels", E.labels_on(labels, "1998-06-01"), "label"),
        ("customer", E.customer_records(clicks, "17"), "fe_1"),
    ]
    out = None
    for name, rows, value in parts:
        one = rows.select(F.lit(name).alias("part"), "Customer_ID", "snapshot_date", F.col(value).alias("value"))
        out = one if out is None else out.unionAll(one)
    return out


# --- joins ---------------------------------------------------------------------------------

_FIN = ", ".join(f'f."{c}"' for c in A.FINANCIAL_FEATURES)
_FIN_DOUBLES = ["Loans_per_Credit_Item", "Debt_to_Salary", "EMI_to_Salary", "Repayment_Ability"]


@query(
    "j1_assemble_training",
    f"""SELECT l."Customer_ID", l.snapshot_date, l.label, l.loan_id, l.label_def, a."Age", a."Occupation", {_FIN}
FROM label_rows AS l
LEFT JOIN (SELECT * FROM attrs WHERE snapshot_date <= DATE '1998-02-28') AS a ON l."Customer_ID" = a."Customer_ID"
LEFT JOIN (SELECT * FROM fins WHERE snapshot_date <= DATE '1998-02-28') AS f ON l."Customer_ID" = f."Customer_ID"
WHERE l.snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1998-02-28'""",
    ["label_rows", "attrs", "fins"],
    _FIN_DOUBLES,
)
def _(spark, sf):
    return A.assemble_training(V.labels_silver(spark, sf), V.attrs(spark, sf), V.fins(spark, sf), "1998-03-01")


_LAST = """(SELECT * FROM {0} WHERE snapshot_date <= DATE '1998-02-28'
  QUALIFY row_number() OVER (PARTITION BY "Customer_ID" ORDER BY {1}) = 1)"""


@query(
    "j1_assemble_training_as_of",
    f"""WITH several AS (SELECT "Customer_ID", snapshot_date, "Age", "Occupation" FROM attrs
  UNION ALL SELECT "Customer_ID", CAST(snapshot_date - INTERVAL 1 MONTH AS DATE), "Age" + 1, "Occupation" FROM attrs)
SELECT l."Customer_ID", l.snapshot_date, l.label, l.loan_id, l.label_def, a."Age", a."Occupation", {_FIN}
FROM label_rows AS l
LEFT JOIN {_LAST.format("several", 'snapshot_date DESC, "Age" DESC NULLS LAST, "Occupation" DESC NULLS LAST')} AS a
  ON l."Customer_ID" = a."Customer_ID"
LEFT JOIN {_LAST.format("fins", "snapshot_date DESC")} AS f ON l."Customer_ID" = f."Customer_ID"
WHERE l.snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1998-02-28'""",
    ["label_rows", "attrs", "fins"],
    _FIN_DOUBLES,
)
def _(spark, sf):
    attributes = V.attrs(spark, sf).select("Customer_ID", "snapshot_date", "Age", "Occupation")
    older = attributes.withColumns(
        {"snapshot_date": F.add_months("snapshot_date", -1), "Age": F.col("Age") + 1}
    )
    several = attributes.unionByName(older)
    return A.assemble_training(
        V.labels_silver(spark, sf), several, V.fins(spark, sf), "1998-03-01", point_in_time=True
    )


# Snapshots before and after those of the views: the later ones must not reach earlier labels.
_AROUND = """{0}_around AS (SELECT * FROM {0}
  UNION ALL SELECT * REPLACE (CAST(snapshot_date - INTERVAL 7 MONTH AS DATE) AS snapshot_date, "{1}" + 1 AS "{1}") FROM {0}
  UNION ALL SELECT * REPLACE (CAST(snapshot_date + INTERVAL 2 MONTH AS DATE) AS snapshot_date, "{1}" + 2 AS "{1}") FROM {0}),
{0}_once AS (SELECT * FROM {0}_around QUALIFY row_number() OVER (PARTITION BY "Customer_ID", snapshot_date ORDER BY {2}) = 1)"""


def _per_row_sql(compare: str) -> str:
    fins_order = ", ".join(f'"{c}" DESC NULLS LAST' for c in A.FINANCIAL_FEATURES)
    attrs_order = '"Age" DESC NULLS LAST, "Occupation" DESC NULLS LAST'
    return f"""WITH {_AROUND.format("attrs", "Age", attrs_order)},
{_AROUND.format("fins", "Interest_Rate", fins_order)}
SELECT l."Customer_ID", l.snapshot_date, l.label, l.loan_id, l.label_def, a."Age", a."Occupation", {_FIN}
FROM (SELECT * FROM label_rows WHERE snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1998-02-28') AS l
ASOF LEFT JOIN attrs_once AS a ON l."Customer_ID" = a."Customer_ID" AND l.snapshot_date {compare} a.snapshot_date
ASOF LEFT JOIN fins_once AS f ON l."Customer_ID" = f."Customer_ID" AND l.snapshot_date {compare} f.snapshot_date"""


def _around(table, column: str):
    moved = [table]
    for months, more in ((-7, 1), (2, 2)):
        changed = {"snapshot_date": F.add_months("snapshot_date", months), column: F.col(column) + more}
        moved.append(table.withColumns(changed))
    return moved[0].unionByName(moved[1]).unionByName(moved[2])


def _per_row(spark, sf, strict: bool):
    attributes, financials = _around(V.attrs(spark, sf), "Age"), _around(V.fins(spark, sf), "Interest_Rate")
    return A.assemble_training_per_row(V.labels_silver(spark, sf), attributes, financials, "1998-03-01", strict=strict)


@query("j1_assemble_training_per_row", _per_row_sql(">="), ["label_rows", "attrs", "fins"], _FIN_DOUBLES)
def _(spark, sf):
    return _per_row(spark, sf, strict=False)


@query("j1_assemble_training_before_row", _per_row_sql(">"), ["label_rows", "attrs", "fins"], _FIN_DOUBLES)
def _(spark, sf):
    return _per_row(spark, sf, strict=True)


@query(
    "j2_assemble_scoring",
    f"""SELECT a."Customer_ID", a.snapshot_date, a."Age", a."Occupation", {_FIN}
FROM attrs AS a JOIN fins AS f ON a."Customer_ID" = f."Customer_ID" AND a.snapshot_date = f.snapshot_date""",
    ["attrs", "fins"],
    _FIN_DOUBLES,
)
def _(spark, sf):
    return A.assemble_scoring(V.attrs(spark, sf), V.fins(spark, sf))


@query(
    "j3_assemble_scoring_left",
    f"""SELECT a."Customer_ID", a.snapshot_date, a."Age", a."Occupation", {_FIN}
FROM attrs AS a LEFT JOIN (SELECT * FROM fins WHERE "Credit_Mix" IS NOT NULL) AS f
  ON a."Customer_ID" = f."Customer_ID" AND a.snapshot_date = f.snapshot_date""",
    ["attrs", "fins"],
    _FIN_DOUBLES,
)
def _(spark, sf):
    known = V.fins(spark, sf).where(F.col("Credit_Mix").isNotNull())
    return A.assemble_scoring(V.attrs(spark, sf), known, how="left")


@query(
    "j4_match_predictions_to_labels",
    """SELECT l.*, p.snapshot_date AS prediction_date, p.model_name, p.model_predictions
FROM label_rows AS l JOIN scores AS p
  ON l."Customer_ID" = p."Customer_ID" AND CAST(p.snapshot_date + to_months(6) AS DATE) = l.snapshot_date""",
    ["label_rows", "scores"],
)
def _(spark, sf):
    return A.match_predictions_to_labels(V.labels_silver(spark, sf), V.scores(spark, sf), lag=6)


@query(
    "j5_label_feature_table",
    f"""SELECT l.loan_id, l."Customer_ID", l.label, a."Age", a."Occupation", {_FIN}
FROM label_rows AS l
LEFT JOIN (SELECT * FROM attrs WHERE snapshot_date < DATE '1998-06-01') AS a ON l."Customer_ID" = a."Customer_ID"
LEFT JOIN (SELECT * FROM fins WHERE snapshot_date < DATE '1998-06-01') AS f ON l."Customer_ID" = f."Customer_ID"
WHERE l.snapshot_date = DATE '1998-06-01'""",
    ["label_rows", "attrs", "fins"],
    _FIN_DOUBLES,
)
def _(spark, sf):
    return A.label_feature_table(
        V.labels_silver(spark, sf), V.attrs(spark, sf), V.fins(spark, sf), "1998-06-01"
    )


_CLICKS = ", ".join(f"click_{i}m" for i in range(1, 7))


@query(
    "j6_label_with_clicks",
    f"""SELECT l.*, {_CLICKS} FROM label_rows AS l LEFT JOIN (
  SELECT "Customer_ID", {_click_sql("month", "m", _AGO)} FROM clicks
  WHERE snapshot_date >= DATE '1996-12-01' AND snapshot_date < DATE '1997-06-01' GROUP BY 1) AS c
ON l."Customer_ID" = c."Customer_ID" WHERE l.snapshot_date = DATE '1997-06-01'""",
    ["label_rows", "clicks"],
)
def _(spark, sf):
    pivoted = E.clickstream_pivot(V.clicks(spark, sf), "1997-06-01", 6)
    return A.label_with_clicks(V.labels_silver(spark, sf), pivoted, "1997-06-01")


@query(
    "j7_aligned_shares",
    """SELECT COALESCE(b.bin, c.bin) AS bin, COALESCE(b.share, 0.00001) AS expected, COALESCE(c.share, 0.00001) AS actual
FROM (SELECT CAST(floor(util_rate * 20) AS INTEGER) AS bin, count(*) / sum(count(*)) OVER () AS share FROM monitored
    WHERE snapshot_date < DATE '1996-01-01' GROUP BY 1) AS b
FULL JOIN (SELECT CAST(floor(util_rate * 20) AS INTEGER) AS bin, count(*) / sum(count(*)) OVER () AS share FROM monitored
    WHERE snapshot_date >= DATE '1996-01-01' GROUP BY 1) AS c
ON b.bin = c.bin""",
    ["monitored"],
    ["expected", "actual"],
)
def _(spark, sf):
    # Later years reach bins that the baseline year does not have.
    rows = V.monitored(spark, sf).withColumn("bin", F.floor(F.col("util_rate") * 20).cast("int"))
    base = rows.where("snapshot_date < date'1996-01-01'")
    return D.aligned_shares(base, rows.where("snapshot_date >= date'1996-01-01'"), "bin", 1e-5)


@query(
    "j8_category_lookup",
    """WITH ref AS (SELECT branch AS category, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, branch) AS r
  FROM order_features WHERE snapshot_date < DATE '1996-01-01' GROUP BY branch),
kept AS (SELECT category, n FROM ref WHERE r <= 50 UNION ALL
  SELECT '__OTHER__', CAST(sum(n) AS BIGINT) FROM ref WHERE r > 50 HAVING sum(n) > 0),
cur AS (SELECT CASE WHEN branch IN (SELECT category FROM kept) THEN branch ELSE '__OTHER__' END AS category, count(*) AS n
  FROM order_features WHERE snapshot_date >= DATE '1996-01-01' GROUP BY 1)
SELECT k.category, k.n / (SELECT sum(n) FROM kept) AS p_ref, COALESCE(c.n, 0) / (SELECT sum(n) FROM cur) AS p_cur
FROM kept AS k LEFT JOIN cur AS c ON k.category = c.category""",
    ["order_features"],
    ["p_ref", "p_cur"],
)
def _(spark, sf):
    rows = V.order_features(spark, sf)
    base = rows.where("snapshot_date < date'1996-01-01'")
    return D.category_lookup(base, rows.where("snapshot_date >= date'1996-01-01'"), "branch")
