"""Physical plans, and the layers run end to end."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskloom.operators import assemble as A
from riskloom.operators import model as M
from riskloom.operators.registry import read_registry
from riskloom.plans import medallion, scoring, training
from riskloom.workload import views as V
from riskloom.workload.registry import QUERIES  # noqa: F401

HEAVY = [
    "l5_silver_loan", "l9_default_rate_by_age_group", "c18_clean_financials", "f8b_engagement_features_all",
    "j1_assemble_training", "j4_match_predictions_to_labels", "t5_stratified_split", "p1_fit_median_impute",
    "a3_describe_ledger", "a9_spearman_matrix", "a11_score_diagnostics", "d5_feature_psi", "d7_psi_scheduled",
    "d10_monthly_psi", "d11_psi_trend", "d17_cooldown", "m6_gini", "a13_top_k_categories",
]


@pytest.mark.parametrize("name", HEAVY)
def test_plan_has_no_unwanted_operator(spark, sf, name):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    # A window without partitioning is allowed over edges, classes and levels only.
    for ordered in re.findall(r"windowspecdefinition\((\S+) (?:ASC|DESC)", plan):
        assert re.match(r"(e|value|_w0|_slice)#", ordered), ordered


def test_scan_reads_only_needed_columns(spark, sf):
    plan = entry.queries()["l7_bad_rate_by_mob"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("l_tax" not in s and "o_orderpriority" not in s for s in schemas)


def test_engagement_shuffles_reduced_rows_only(spark, sf):
    plan = entry.queries()["f8b_engagement_features_all"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    # one exchange for the view, one for the reduction, one by customer; none for the copies
    assert plan.count("Exchange hashpartitioning") == 3


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 7 and all(0 <= r["bad_rate"] <= 1 for r in rows)


@pytest.fixture(scope="module")
def mart(spark, sf):
    from riskloom.session import scratch_dir

    root = scratch_dir(spark, "mart")
    feeds = {}
    for feed, view in (
        ("ledger", V.ledger_text), ("clickstream", V.clicks_text),
        ("attributes", V.attrs_text), ("financials", V.fins_text),
    ):
        from riskloom.sources.schemas import FEEDS

        feeds[feed] = f"{root}/raw/{feed}"
        view(spark, sf).select(*FEEDS[feed]).write.option("header", True).option("escape", '"').csv(feeds[feed])
    medallion.backfill(spark, feeds, root, "1995-01-01", "2001-12-01", dpd=30, mob=3)
    return root


def test_backfill_builds_every_layer(spark, sf, mart):
    ledger = spark.read.parquet(f"{mart}/silver/ledger")
    assert ledger.count() == V.ledger_text(spark, sf).count()
    labels = spark.read.parquet(f"{mart}/gold/label_store")
    assert labels.count() == ledger.where("mob = 3").count()
    assert {"label_def", "snapshot_date"} <= set(labels.columns)
    financials = spark.read.parquet(f"{mart}/silver/financials")
    expected = V.fins(spark, sf)
    keep = ["Customer_ID", "Credit_Mix", "Num_of_Loan", "Outstanding_Debt", "Credit_History_Age"]
    got = sorted(map(str, financials.select(*keep).collect()))
    assert got == sorted(map(str, expected.select(*keep).collect()))
    assert spark.read.parquet(f"{mart}/gold/customer_risk").count() == financials.count()
    assert spark.read.parquet(f"{mart}/gold/engagement").count() > 0


def test_backfill_again_changes_nothing(spark, mart):
    before = spark.read.parquet(f"{mart}/silver/attributes").count()
    medallion.build_silver(spark, ["attributes"], mart, "1995-06-01", "1996-06-01")
    assert spark.read.parquet(f"{mart}/silver/attributes").count() == before


def test_training_and_scoring_run(spark, sf, mart):
    labels = V.labels_silver(spark, sf)
    attributes, financials = V.attrs(spark, sf), V.fins(spark, sf)
    space = {"n_estimators": [2, 3], "max_depth": [2]}
    run = training.run_training(spark, labels, attributes, financials, "1999-03-01", f"{mart}/bank", space, draws=2)
    assert run.version == "credit_model_1999_03_01"
    row = read_registry(spark, f"{mart}/bank/registry").first()
    assert row["auc_train"] > 0.5 and row["gini_train"] == round(2 * row["auc_train"] - 1, 4)
    assert row["rows_train"] + row["rows_test"] + row["rows_oot"] > 0 and set(row["params"]) == set(space)
    assert set(run.baseline.columns) == {"Customer_ID", "snapshot_date", "model_name", "prediction"}

    path = f"{mart}/predictions"
    scoring.run_scoring(spark, attributes, financials, f"{mart}/bank", run.version, "1995-01-01", "2000-12-01", path)
    scored = spark.read.parquet(path)
    assert scored.count() == A.assemble_scoring(attributes, financials).count()
    assert scored.where("model_predictions < 0 or model_predictions > 1 or model_predictions is null").count() == 0


def test_search_draws_are_distinct_and_repeatable():
    one, two = M.draw_params(n=100), M.draw_params(n=100)
    assert one == two and len({tuple(p.items()) for p in one}) == 100
    assert len(M.draw_params({"max_depth": [1, 2]}, n=10)) == 2


def test_separable_classes_are_learned(spark):
    rows = spark.range(400).select(
        F.col("id").alias("Age"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("Occupation"),
        (F.col("id") >= 200).cast("int").alias("label"), F.lit("train").alias("split"),
    )
    model = M.train_classifier(rows, ["Age", "Occupation"], params={"n_estimators": 3, "max_depth": 2})
    assert M.evaluate(model, rows).first()["auc"] > 0.99
