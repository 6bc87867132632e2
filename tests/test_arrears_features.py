from datetime import date

from pyspark.sql import functions as F

from riskloom.operators import arrears as L
from riskloom.operators import features as E
from riskloom.operators.assemble import training_feasible, training_windows
from riskloom.sources import tables

LEDGER = "loan_id string, Customer_ID string, loan_start_date date, tenure int, installment_num int, loan_amt double, due_amt double, paid_amt double, overdue_amt double, balance double, snapshot_date date"


def _loan(i, due, overdue):
    return (f"L{i}", "C1", date(2023, 1, 1), 10, 6, 10000.0, due, 0.0, overdue, 0.0, date(2023, 7, 1))


def test_arrears_catalogue(spark):
    rows = [_loan(0, 1000.0, 0.0), _loan(1, 1000.0, 1500.0), _loan(2, 0.0, 100.0), _loan(3, None, 100.0), _loan(4, 10.0, None)]
    out = L.add_arrears(spark.createDataFrame(rows, LEDGER)).orderBy("loan_id").collect()
    assert [r["installments_missed"] for r in out] == [0, 2, 0, 0, 0]
    assert [r["first_missed_date"] for r in out] == [None, date(2023, 5, 1), None, None, None]
    assert [r["dpd"] for r in out] == [0, 61, None, None, 0]
    assert out[3]["due_amt"] == 0.0
    assert [r["mob"] for r in out] == [6] * 5


def test_labels(spark):
    rows = spark.createDataFrame([(61,), (29,), (30,), (None,)], "dpd int").select(
        F.lit("L").alias("loan_id"), F.lit("C").alias("Customer_ID"), "dpd", F.lit(3).alias("mob"),
        F.lit(date(2023, 1, 1)).alias("snapshot_date"),
    )
    out = L.label_store(rows, 30, 3)
    assert [r["label"] for r in out.collect()] == [1, 0, 1, 0]
    assert out.first()["label_def"] == "30dpd_3mob"
    assert L.label_store(rows, 30, 6).count() == 0


def test_age_bands(spark):
    ages = [20, 21, 29, 30, 54, 55, None]
    rows = spark.createDataFrame([(a,) for a in ages], "a int").select(L.age_band(F.col("a")))
    assert [r[0] for r in rows.collect()] == [None, "21-29", "21-29", "30-34", "50-54", "55+", None]


CLICKS = [
    ("A", date(2023, 6, 1), 1), ("A", date(2023, 4, 1), 3), ("A", date(2022, 12, 1), 7),
    ("B", date(2023, 1, 1), 6), ("B", date(2023, 1, 1), 4), ("C", date(2023, 7, 1), 9),
]


def test_engagement_window(spark):
    clicks = spark.createDataFrame(CLICKS, "Customer_ID string, snapshot_date date, fe_1 int")
    out = {r["Customer_ID"]: r for r in E.engagement_features(clicks, "2023-07-01").collect()}
    assert set(out) == {"A", "B"}
    assert [out["A"][f"click_{i}m"] for i in range(1, 7)] == [1, None, 3, None, None, None]
    assert out["B"]["click_6m"] == 4
    assert out["A"]["snapshot_date"] == date(2023, 7, 1)


def test_engagement_of_all_months_equals_month_by_month(spark):
    clicks = spark.createDataFrame(CLICKS, "Customer_ID string, snapshot_date date, fe_1 int")
    together = E.engagement_features_all(clicks, "2023-01-01", "2023-12-01")
    cols = together.columns
    single = None
    for m in range(1, 13):
        one = E.engagement_features(clicks, date(2023, m, 1)).select(*cols)
        single = one if single is None else single.unionAll(one)
    assert sorted(map(str, together.collect())) == sorted(map(str, single.collect()))


def test_ratios_survive_zero(spark):
    rows = spark.createDataFrame([(-1.0, 5.0, 0.0)], "Monthly_Inhand_Salary double, Outstanding_Debt double, Annual_Income double")
    out = rows.select(E.debt_to_salary().alias("a"), E.debt_to_income().alias("b")).first()
    assert (out["a"], out["b"]) == (None, None)


def test_windows_and_feasibility(spark):
    months = tables.month_spine(spark, "2024-02-01", "2024-03-31")
    out = {r["train_date"]: r for r in training_windows(months).collect()}
    march = out[date(2024, 3, 1)]
    assert (march["train_start"], march["train_end"]) == (date(2023, 1, 1), date(2023, 12, 31))
    assert (march["oot_start"], march["oot_end"]) == (date(2024, 1, 1), date(2024, 2, 29))
    status = {r["train_date"]: r["status"] for r in training_feasible(training_windows(months)).collect()}
    assert status == {date(2024, 2, 1): "skipped_insufficient_data", date(2024, 3, 1): "feasible"}


def test_spine_and_gaps(spark):
    assert tables.month_spine(spark, "2023-01-15", "2023-03-01").count() == 3
    rows = spark.createDataFrame([(date(2023, 1, 1),), (date(2023, 4, 1),)], "snapshot_date date")
    assert sorted(r[0] for r in tables.missing_months(rows).collect()) == [date(2023, 2, 1), date(2023, 3, 1)]
