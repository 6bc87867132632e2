"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.session import build_session  # noqa: E402
from riskloom.workload import load_queries  # noqa: E402

HEADLINE = [
    "l5_silver_loan",
    "l6_label_store",
    "l7_bad_rate_by_mob",
    "l9_default_rate_by_age_group",
    "c17_clean_attributes",
    "c18_clean_financials",
    "c19_clean_clickstream",
    "f8_engagement_features",
    "f8b_engagement_features_all",
    "j1_assemble_training",
    "j2_assemble_scoring",
    "j4_match_predictions_to_labels",
    "t5_hash_split",
    "t5_stratified_split",
    "p1_fit_median_impute",
    "m6_gini",
    "a2_distinct_counts",
    "a3_describe_ledger",
    "a9_spearman_matrix",
    "a11_score_diagnostics",
    "a13_top_k_categories",
    "d2_psi_baseline",
    "d5_feature_psi",
    "d7_psi_scheduled",
    "d9_prediction_drift",
    "d10_monthly_psi",
    "d11_psi_trend",
    "d16_retrain_decision",
    "d17_cooldown",
    "s15_backfill",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.sql.debug.maxToStringFields": "10",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = load_queries()
    names = [n for n in HEADLINE if not sys.argv[1:] or n in sys.argv[1:]]
    times = {}
    for name in names:
        # A cold run compiles the plan, the run after it is the one reported.
        run(catalogue[name], spark, sf_dir)
        times[name] = round(run(catalogue[name], spark, sf_dir), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
