"""L1..L10: arrears, labels and vintage tables."""

from __future__ import annotations

from riskloom.operators import arrears as L
from riskloom.workload import views as V
from riskloom.workload.registry import query


@query("l1_month_on_book", "SELECT loan_id, installment_num AS mob, snapshot_date FROM ledger", ["ledger"])
def _(spark, sf):
    return V.ledger(spark, sf).select("loan_id", L.month_on_book().alias("mob"), "snapshot_date")


@query(
    "l2_installments_missed",
    """SELECT loan_id, installment_num, snapshot_date,
  COALESCE(CAST(ceil(overdue_amt / NULLIF(due_amt, 0)) AS INTEGER), 0) AS installments_missed FROM ledger""",
    ["ledger"],
)
def _(spark, sf):
    missed = L.installments_missed().alias("installments_missed")
    return V.ledger(spark, sf).select("loan_id", "installment_num", "snapshot_date", missed)


@query("l3_first_missed_date", "SELECT loan_id, mob, snapshot_date, first_missed_date FROM silver_ledger", ["silver_ledger"])
def _(spark, sf):
    return V.silver_ledger(spark, sf).select("loan_id", "mob", "snapshot_date", "first_missed_date")


@query("l4_days_past_due", "SELECT loan_id, mob, snapshot_date, dpd FROM silver_ledger", ["silver_ledger"])
def _(spark, sf):
    return V.silver_ledger(spark, sf).select("loan_id", "mob", "snapshot_date", "dpd")


@query("l5_silver_loan", "SELECT * FROM silver_ledger", ["silver_ledger"])
def _(spark, sf):
    return L.silver_loan(V.ledger(spark, sf))


@query("l6_label_store", "SELECT * FROM label_rows", ["label_rows"])
def _(spark, sf):
    return L.label_store(V.silver_ledger(spark, sf), dpd=30, mob=3)


@query(
    "l6_label_store_6mob",
    """SELECT loan_id, "Customer_ID", CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def, snapshot_date
FROM silver_ledger WHERE mob = 6""",
    ["silver_ledger"],
)
def _(spark, sf):
    return L.label_store(V.silver_ledger(spark, sf), dpd=30, mob=6)


@query(
    "l7_bad_rate_by_mob",
    """SELECT mob, avg(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS bad_rate
FROM silver_ledger WHERE loan_start_date < DATE '2000-01-01' GROUP BY mob""",
    ["silver_ledger"],
    ["bad_rate"],
)
def bad_rate_by_mob(spark, sf):
    return L.bad_rate_by_mob(V.silver_ledger(spark, sf), dpd=30, started_before="2000-01-01")


@query("l8_actual_bads", "SELECT * FROM silver_ledger WHERE installment_num = 7", ["silver_ledger"])
def _(spark, sf):
    return L.actual_bads(V.silver_ledger(spark, sf), final=7)


@query(
    "l9_default_rate_by_age_group",
    """SELECT age_group, avg(label) AS default_rate
FROM (SELECT label, CASE WHEN "Age" <= 20 THEN NULL WHEN "Age" <= 29 THEN '21-29' WHEN "Age" <= 34 THEN '30-34'
    WHEN "Age" <= 39 THEN '35-39' WHEN "Age" <= 44 THEN '40-44' WHEN "Age" <= 49 THEN '45-49'
    WHEN "Age" <= 54 THEN '50-54' WHEN "Age" > 54 THEN '55+' END AS age_group
  FROM label_rows LEFT JOIN attrs USING ("Customer_ID")) AS t
WHERE age_group IS NOT NULL GROUP BY age_group""",
    ["label_rows", "attrs"],
    ["default_rate"],
)
def _(spark, sf):
    return L.default_rate_by_age_group(V.labels_silver(spark, sf), V.attrs(spark, sf))


@query(
    "l10_ledger_date_range",
    "SELECT min(snapshot_date) AS min_date, max(snapshot_date) AS max_date FROM ledger",
    ["ledger"],
)
def _(spark, sf):
    return L.ledger_date_range(V.ledger(spark, sf))
