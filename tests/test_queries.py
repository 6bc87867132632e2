"""Registered queries against their SQL twins on the smallest test data."""

import re

import pytest

import __spark_entry__ as entry
from riskloom.workload import load_queries
from tests.compare import compare, duck

# A cross-section; `python -m tests.compare` runs all of them at any scale.
CHECKED = [
    "s1_read_feed", "s7_read_lagged", "s16_snapshot_coverage", "c1_enforce_schema", "c17_clean_attributes",
    "c18_clean_financials", "c19_clean_clickstream", "l5_silver_loan", "l6_label_store", "l7_bad_rate_by_mob",
    "l9_default_rate_by_age_group", "f8b_engagement_features_all", "j1_assemble_training", "j4_match_predictions_to_labels",
    "j8_category_lookup", "t5_stratified_split", "p3_apply_ordinal", "p7_preprocess", "m5_auc", "m7_register_model",
    "m9_resolve_model", "a3_describe", "a7_histogram_by_label", "a9_spearman_matrix", "a13_top_k_categories",
    "d2_psi_baseline", "d5_feature_psi", "d6_psi_prediction", "d10_monthly_psi", "d11_psi_trend", "d17_cooldown",
]


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, sf, con, name):
    assert compare(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name]) == ""


def test_every_operator_of_the_survey_is_registered():
    groups = {"s": 17, "c": 23, "l": 10, "f": 11, "j": 8, "a": 16, "t": 6, "p": 8, "m": 11, "d": 23}
    names = load_queries()
    wanted = {f"{g}{i}" for g, n in groups.items() for i in range(1, n + 1)} | {"c3v", "f8b"}
    present = {re.match(r"[a-z]+\d+[a-z]?", n).group() for n in names}
    assert not wanted - present
    assert {n for n, q in names.items() if q.sql is None} == {
        "m1_train_classifier", "m2_random_search", "m3_score", "m4_baseline_scores", "m8_verify_reload"
    }
