"""Dirty rows, null groups, hot keys, many levels, repeated cuts, and the chain of runs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions import cleaning as X
from riskloom.operators import arrears, assemble, decide, drift, preprocess, ranks
from riskloom.operators.joins import lookup_join
from riskloom.plans import monitoring, scoring, training
from riskloom.sources import feeds, tables
from riskloom.workload import views as V


# --- one dirty row does not end a job ---


def test_history_beyond_integers_is_null(spark):
    rows = spark.createDataFrame([("999999999 Years and 1 Months",), ("22 Years and 1 Months",)], "c string")
    assert [r[0] for r in rows.select(X.history_to_months("c")).collect()] == [None, 265]


def test_missed_installments_beyond_all_dates(spark):
    rows = spark.sql(
        "select date'2023-07-01' as snapshot_date, 2e9 as overdue_amt, 1.0 as due_amt, 1 as installment_num"
        " union all select date'2023-07-01', 1500.0, 1000.0, 1"
    )
    rows = rows.withColumn("installments_missed", arrears.installments_missed())
    got = rows.select("installments_missed", arrears.first_missed_date().cast("string")).collect()
    assert sorted(map(tuple, got), key=str) == [(2, "2023-05-01"), (2000000000, None)]


# --- no group vanishes ---


def _by_group(spark):
    return spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "a").alias("g"),
        (F.col("id") % 50).cast("double").alias("v"),
        (F.col("id") % 50 + F.col("id") % 3 > 25).cast("int").alias("y"),
    )


def test_null_groups_keep_their_statistics(spark):
    rows = _by_group(spark)
    assert {r["g"] for r in ranks.exact_quantiles(rows, ["g"], "v", [0.5]).collect()} == {"a", None}
    assert {r["g"] for r in ranks.auc(rows, "v", "y", ["g"]).collect()} == {"a", None}
    counts = ranks.value_counts(rows, ["g"], "v")
    assert ranks.running_totals(counts, ["g"], "v", ["n"], 10).count() == counts.count()


def test_null_class_is_split_like_others(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 4 > 0, (F.col("id") % 4 == 1).cast("int")).alias("y"))
    out = assemble.stratified_split(rows, ["id"], "y", 0.8).groupBy("y", "split").count().collect()
    sizes = {(r["y"], r["split"]): r["count"] for r in out}
    assert sizes[(None, "train")] == 200 and sizes[(None, "test")] == 50
    assert sum(n for (_, s), n in sizes.items() if s == "train") == 800


# --- nothing is capped ---


@pytest.mark.parametrize("values", [50, 5000])
def test_wide_brackets_are_ordered_by_ranges(spark, values):
    rows = spark.range(30_000).select(
        F.lit("x").alias("g"),
        F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e6).alias("v"),
    )
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = ranks.exact_quantiles(rows, ["g"], "v", probs, small=0, values=values).first()["quantiles"]
    assert np.allclose(got, np.quantile([r.v for r in rows.collect()], probs), rtol=0, atol=1e-12)


@pytest.mark.parametrize("equal, distinct", [(1984, 16), (9900, 100), (500, 9500)])
def test_quantiles_behind_a_frequent_value_end(spark, equal, distinct):
    zeros = spark.range(equal).select(F.lit(0.0).alias("v"))
    rows = zeros.unionAll(spark.range(1, distinct + 1).select(F.col("id").cast("double").alias("v")))
    probs = [0.005, 0.5, 0.99, 0.995, 1.0]
    got = ranks.exact_quantiles(rows, [], "v", probs, values=10).first()["quantiles"]
    assert np.allclose(got, np.quantile([0.0] * equal + list(range(1, distinct + 1)), probs), rtol=0, atol=1e-9)
    least = ranks.exact_percentiles(rows, [], "v", probs, values=10).first()["quantiles"]
    assert np.allclose(least, np.quantile([0.0] * equal + list(range(1, distinct + 1)), probs, method="inverted_cdf"))


def test_exact_percentiles(spark):
    rows = spark.range(1, 5001).select((F.col("id") * 3).cast("double").alias("v"))
    got = ranks.exact_percentiles(rows, [], "v", [0.1, 0.5, 0.9]).first()["quantiles"]
    assert got == [1500.0, 7500.0, 13500.0]


def test_slices_grow_with_the_rows(spark):
    rows = spark.range(3000).select(F.lit("g").alias("g"), F.col("id").alias("v"), F.lit(1).cast("long").alias("n"))
    out = ranks.running_totals(rows, ["g"], "v", ["n"], rows_per_slice=2)
    assert out.where("n_before <> v or n_group <> 3000").count() == 0


def test_many_levels_are_encoded(spark):
    rows = spark.range(20_000).select(F.format_string("level%05d", "id").alias("Occupation"))
    codes = preprocess.fit_ordinal(rows, "Occupation")
    coded = preprocess.apply_ordinal(rows.withColumn("old", F.col("Occupation")), "Occupation", codes)
    assert coded.where("cast(substring(old, 6) as int) <> Occupation").count() == 0
    assert codes.count() == 20_001


def test_key_with_a_third_of_the_rows(spark):
    rows = spark.range(90_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    lookup = spark.range(90_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    out = lookup_join(rows, lookup, "k", key_rows=1000)
    assert out.count() == 90_000 and out.where("w <> 2 * k or w is null").count() == 0


def test_all_common_columns_are_monitored(spark):
    names = [f"c{i}" for i in range(8)]
    df = spark.range(3).select(*[F.col("id").cast("double").alias(c) for c in names])
    assert drift.monitored_columns(df, df) == names
    assert drift.monitored_columns(df, df, 5) == names[:5]


# --- reruns, stored state ---


def test_a_month_that_becomes_empty_is_emptied(spark, scratch):
    path = scratch("table")
    rows = spark.sql("select 1 as x, date'2024-01-01' as snapshot_date union all select 2, date'2024-02-01'"
                     " union all select 3, date'2024-03-01'")  # fmt: skip
    tables.write_table(rows, path)
    tables.write_table(rows.where("x = 1"), path, months=["2024-01-01", "2024-02-01"])
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_predictions_are_listed_by_month(spark, scratch):
    root = scratch("predictions")
    one = spark.range(3)
    for place in ("date=2024-01", "snapshot_date=2024-01-01", "m/preds_2024_01.parquet", "preds_2024_01_v2.parquet", "date=2024-02"):
        one.write.parquet(f"{root}/{place}")
    found = feeds.predictions_for_month(spark, root, "2024-01")
    assert found.count() == 12 and not any("2024-02" in f for f in found.inputFiles())


def test_cooldown_state_is_used_by_the_next_run(spark):
    days = ["2024-01-01", "2024-01-10", "2024-02-01"]
    rows = spark.createDataFrame([("m", d, True) for d in days], "model_name string, d string, wants_retrain boolean")
    rows = rows.select("model_name", F.to_date("d").alias("decided_on"), "wants_retrain")
    first = decide.cooldown(rows.where("d = '2024-01-01'") if "d" in rows.columns else rows.where("decided_on = '2024-01-01'"))
    state = decide.cooldown_state(first)
    later = decide.cooldown(rows.where("decided_on > '2024-01-01'"), state=state)
    got = {str(r["decided_on"]): r["branch"] for r in later.collect()}
    assert got == {"2024-01-10": "skip_retrain", "2024-02-01": "retrain_model"}
    late = decide.cooldown(rows.where("decided_on = '2024-01-10'"), state=state, now="2024-03-01")
    assert late.first()["branch"] == "retrain_model"
    assert str(decide.cooldown_state(later, state=state).first()["cooldown_until"]) == "2024-02-15"


def test_last_snapshot_per_customer(spark):
    rows = spark.sql("select 'a' as Customer_ID, date'2024-01-01' as snapshot_date, 1 as x union all"
                     " select 'a', date'2024-03-01', 2 union all select 'b', date'2024-02-01', null")  # fmt: skip
    assert sorted(map(tuple, assemble.last_snapshot(rows).collect())) == [("a", 2), ("b", None)]


def test_features_come_from_the_baseline(spark):
    base = spark.range(500).select(F.col("id").cast("double").alias("n"), F.concat(F.lit("c"), F.col("id") % 3).alias("c"))
    cur = base.withColumn("snapshot_date", F.lit("2024-05-01").cast("date"))
    table = drift.psi_baseline(base, "m", "2024-01-01")
    got = {r["feature"]: r["psi"] for r in drift.feature_psi(cur, table, "m", "2024-01-01").collect()}
    assert set(got) == {"n", "c"} and max(map(abs, got.values())) < 1e-9


# --- training, scoring and monitoring as one chain ---


def test_monitoring_runs_on_what_training_and_scoring_wrote(spark, sf, scratch):
    labels, attributes, financials = V.labels_silver(spark, sf), V.attrs(spark, sf), V.fins(spark, sf)
    bank, path = scratch("bank"), scratch("predictions")
    space = {"n_estimators": [2], "max_depth": [2]}
    run = training.run_training(spark, labels, attributes, financials, "1999-03-01", bank, space, draws=1)
    scoring.run_scoring(spark, attributes, financials, bank, run.version, "1998-01-01", "2000-12-01", path)
    scores = spark.read.parquet(path).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    months = tables.month_spine(spark, "1997-10-01", "2000-12-01")
    out = monitoring.decide_months(run.baseline, scores, months, run.version, "1998-01-01").collect()
    status = pd.Series([r["status"] for r in out]).value_counts()
    assert len(out) == 39 and status["SKIPPED_NO_BASELINE"] == 3 and status["OK"] > 0
    assert all(set(r["psi"]) == {"prediction"} for r in out if r["status"] == "OK")


def test_months_without_common_columns_have_a_status(spark):
    base = spark.range(5).select(F.col("id").cast("double").alias("one"))
    cur = spark.range(5).select(F.col("id").cast("double").alias("two"), F.lit("2024-01-01").cast("date").alias("snapshot_date"))
    out = drift.monthly_psi(base, cur, cur.select("snapshot_date").distinct()).collect()
    assert [(r["status"], r["overall"]) for r in out] == [("NO_COLUMNS", None)]
