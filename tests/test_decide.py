from datetime import date, timedelta

from pyspark.sql import functions as F

from riskloom.operators import decide as G
from riskloom.operators import registry as R

PAYLOAD = "month string, overall double, psi map<string,double>, status string"


def test_retrain_decision(spark):
    nan = float("nan")
    rows = [
        ("2024-01", 0.25, {"a": 0.25}, "OK"),
        ("2024-02", 0.20, {"a": 0.20, "b": 0.20}, "OK"),
        ("2024-03", 0.20, {"a": 0.20}, "OK"),
        ("2024-04", None, None, "SKIPPED_NO_BASELINE"),
        ("2024-05", nan, {"a": nan, "b": nan}, "OK"),
        ("2024-06", 0.9, {"a": 0.9, "b": 0.8}, "SKIPPED_NO_PREDICTION"),
    ]
    out = G.retrain_decision(spark.createDataFrame(rows, PAYLOAD)).orderBy("month").collect()
    assert [r["wants_retrain"] for r in out] == [True, True, False, False, False, False]


def test_cooldown_matches_a_loop(spark):
    start = date(2024, 1, 1)
    days = [0, 5, 13, 14, 15, 27, 28, 60, 73, 74]
    rows = [("m", start + timedelta(d), True) for d in days] + [("m", start + timedelta(30), False), ("n", start, True)]
    out = G.cooldown(spark.createDataFrame(rows, "model_name string, decided_on date, wants_retrain boolean")).collect()
    ran = sorted((r["decided_on"] - start).days for r in out if r["branch"] == "retrain_model" and r["model_name"] == "m")
    expected, until = [], -1
    for d in days:
        if d >= until:
            expected.append(d)
            until = d + 14
    assert ran == expected
    assert len(out) == len(rows)
    state = {r["model_name"]: r["cooldown_until"] for r in G.cooldown_state(G.cooldown(spark.createDataFrame(rows, "model_name string, decided_on date, wants_retrain boolean"))).collect()}
    assert state == {"m": start + timedelta(expected[-1] + 14), "n": start + timedelta(14)}


def test_alert_records(spark):
    rows = spark.createDataFrame([(0.05,), (0.1,), (0.5,), (float("inf"),)], "psi double")
    out = G.alert_records(rows).collect()
    assert [r["status"] for r in out] == ["PASS", "WARNING", "CRITICAL", "CRITICAL"]
    assert [r["action"] for r in out] == ["CONTINUE", "MONITOR", "RETRAIN", "RETRAIN"]
    assert [r["notify"] for r in out] == [False, True, True, True]
    assert out[0]["message"] == "Model is running normally. PSI=0.050000"
    assert "PSI=inf," in out[3]["message"]


def test_detailed_alerts_and_routes(spark):
    rows = spark.createDataFrame([(0.05,), (0.1,), (0.5,)], "psi double")
    out = G.route_status(G.alert_records_detailed(rows, ["t"], ["o"])).collect()
    assert [r["recipients"] for r in out] == [[], ["t"], ["t", "o"]]
    assert [r["channels"] for r in out] == [[], ["email"], ["email", "slack"]]
    assert [r["recommended_action"] for r in out] == ["CONTINUE", "MONITOR", "RETRAIN_NOW"]
    assert [r["branch"] for r in out] == ["continue", "send_alert", "trigger_retrain"]


def test_policy(spark):
    rows = spark.createDataFrame([(0.0,), (0.1,), (0.25,), (None,)], "psi double")
    assert [r["level"] for r in G.apply_policy(rows).collect()] == ["green", "yellow", "red", None]
    assert G.alert_policy(spark).count() == 3


def test_dashboard_tables(spark):
    rows = [("2024-04", 0.3, {"a": 0.3, "b": 0.1}, "OK"), ("2024-03", 0.2, {"a": 0.2}, "OK"), ("2024-05", None, None, "SKIPPED_NO_BASELINE")]
    df = spark.createDataFrame(rows, PAYLOAD)
    assert [r["month"] for r in G.psi_dashboard_trend(df).collect()] == ["2024-03", "2024-04"]
    assert [tuple(r) for r in G.feature_psi_latest(df).collect()] == [("a", 0.3), ("b", 0.1)]
    grid = {r["feature"]: (r["2024-03"], r["2024-04"]) for r in G.psi_matrix(df, ["2024-03", "2024-04"]).collect()}
    assert grid == {"a": (0.2, 0.3), "b": (None, 0.1)}


def _registry(spark):
    versions = spark.createDataFrame([("credit_model_2024_01_01",), ("credit_model_2024_02_01",)], "model_version string")
    baselines = spark.createDataFrame([("credit_model_2024_01_01", "b1")], "model_version string, baseline string")
    events = spark.createDataFrame(
        [("credit_model_2024_01_01", date(2024, 1, 2)), ("gone", date(2024, 3, 1))], "model_version string, activated_at date"
    )
    return versions, baselines, events


def test_model_resolution(spark):
    versions, baselines, events = _registry(spark)
    none = events.limit(0)
    assert tuple(R.resolve_model(versions, baselines, events).first()) == ("credit_model_2024_01_01", "active", "b1")
    assert tuple(R.resolve_model(versions, baselines, none).first()) == ("credit_model_2024_02_01", "latest", "b1")
    fresh = spark.createDataFrame([("credit_model_2024_03_01",)], "model_version string")
    assert R.resolve_model(versions, baselines, events, fresh).first()["source"] == "fresh"
    assert R.resolve_model(versions.limit(0), baselines, none).count() == 0


def test_activation(spark):
    versions, _, events = _registry(spark)
    assert R.needs_initial_training(events, versions).first()[0] is False
    assert R.needs_initial_training(events.where("model_version = 'gone'"), versions).first()[0] is True
    after = R.activate_model(events, versions, "credit_model_2024_02_01", "2024-04-01")
    assert R.active_model(after, versions).first()[0] == "credit_model_2024_02_01"
    assert R.activate_model(events, versions, "absent", "2024-04-01").count() == events.count()
    assert R.latest_version(versions).first()[0] == "credit_model_2024_02_01"


def test_params_are_kept(spark):
    versions, _, _ = _registry(spark)
    assert R.with_params(versions, {"maxDepth": 3}).select(F.col("params")["maxDepth"]).first()[0] == "3"
