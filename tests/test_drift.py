"""PSI definitions against small numpy versions written for these tests."""

from datetime import date

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.operators import decide as G
from riskloom.operators import drift as D
from riskloom.sources import tables


def _frame(spark, values, col="prediction"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{col} double")


def _shares_term(a, b):
    return float(np.sum((a - b) * np.log(a / b)))


def _scheduled(base, cur):
    cuts = np.unique(np.quantile(base, np.linspace(0, 1, 11)))
    counts = [np.histogram(x, bins=cuts)[0] for x in (base, cur)]
    b, c = [n / (n.sum() + 1e-9) + 1e-9 for n in counts]
    return _shares_term(c, b)


def _equal_width(base, cur):
    edges = np.linspace(min(base.min(), cur.min()), max(base.max(), cur.max()), 11)
    shares = []
    for x in (base, cur):
        n = np.histogram(x, bins=edges)[0]
        shares.append(np.where(n == 0, 1e-6, n / n.sum()))
    return _shares_term(shares[1], shares[0])


RNG = np.random.default_rng(11)
BASE = RNG.beta(2, 5, 700)
CUR = RNG.beta(2, 4, 400) * 1.1


def _one(df):
    return df.first()["psi"]


def test_scheduled_against_numpy(spark):
    assert _one(D.psi_scheduled(_frame(spark, BASE), _frame(spark, CUR))) == pytest.approx(_scheduled(BASE, CUR), abs=1e-12)


def test_equal_width_against_numpy(spark):
    got = _one(D.psi_equal_width(_frame(spark, BASE), _frame(spark, [*CUR, None])))
    assert got == pytest.approx(_equal_width(BASE, CUR), abs=1e-12)


def test_prediction_against_pandas(spark):
    _, bins = pd.qcut(pd.Series(BASE), 10, retbins=True, duplicates="drop")
    b, c = [
        pd.cut(pd.Series(x), bins=bins, include_lowest=True).value_counts(normalize=True, sort=False).to_numpy()
        for x in (BASE, CUR)
    ]
    got = _one(D.psi_prediction(_frame(spark, BASE), _frame(spark, CUR)))
    assert got == pytest.approx(_shares_term(c, b), abs=1e-12)


def test_identical_samples_have_no_drift(spark):
    base = _frame(spark, range(100))
    for one in (D.psi_scheduled, D.psi_prediction, D.psi_equal_width):
        assert _one(one(base, base)) == pytest.approx(0.0, abs=1e-12)


def test_half_range_is_infinite_or_floored(spark):
    base = _frame(spark, [i / 100 for i in range(100)])
    half = base.where("prediction < 0.5")
    assert _one(D.psi_prediction(base, half)) == float("inf")
    assert 0 < _one(D.psi_prediction(base, half, empty="floor")) < 10


def test_nothing_in_range_and_constants(spark):
    base, far = _frame(spark, range(100)), _frame(spark, [1000.0])
    expected = 10 * (1e-5 - 0.1) * np.log(1e-5 / 0.1)
    assert _one(D.psi_prediction(base, far)) == pytest.approx(expected, rel=1e-9)
    constant = _frame(spark, [3.0] * 20)
    assert _one(D.psi_scheduled(constant, base)) == 0.0
    assert _one(D.psi_prediction(constant, base)) == 0.0
    assert _one(D.psi_equal_width(constant, constant)) == 0.0
    assert _one(D.psi_equal_width(base, _frame(spark, [None]))) is None


def test_null_in_the_baseline_skips_the_scheduled_index(spark):
    assert D.psi_scheduled(_frame(spark, [*BASE, None]), _frame(spark, CUR)).count() == 0
    with_null = D.psi_scheduled(_frame(spark, BASE), _frame(spark, [*CUR, None]))
    assert _one(with_null) == pytest.approx(_scheduled(BASE, CUR), abs=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    base=st.lists(st.integers(0, 30), min_size=2, max_size=60),
    cur=st.lists(st.integers(-5, 40), min_size=1, max_size=60),
)
def test_scheduled_on_integers(spark, base, cur):
    expected = _scheduled(np.array(base, float), np.array(cur, float))
    got = _one(D.psi_scheduled(_frame(spark, base), _frame(spark, cur)))
    assert got == pytest.approx(expected, abs=1e-9) and got >= -1e-12


def test_trend_against_numpy(spark):
    months = {date(2024, m, 1): RNG.beta(2, 5 - m / 2, 120 + m) for m in (1, 2, 3)}
    months[date(2024, 4, 1)] = np.full(30, 0.1644)
    rows = [(m, float(v)) for m, values in months.items() for v in values]
    cur = spark.createDataFrame(rows, "snapshot_date date, model_predictions double")
    out = {r["snapshot_date"]: r for r in D.psi_trend(_frame(spark, BASE), cur).collect()}
    for m, values in months.items():
        assert out[m]["psi"] == pytest.approx(_equal_width(BASE, values), abs=1e-12)
        assert out[m]["count"] == len(values)
        assert out[m]["std"] == pytest.approx(values.std(), abs=1e-12)
    assert out[date(2024, 4, 1)]["status"] == "RED"


def test_feature_psi_with_nulls_and_new_categories(spark):
    base = spark.createDataFrame(
        [(float(i), "ab"[i % 2] if i % 10 else None) for i in range(1000)], "x double, c string"
    )
    cur = spark.createDataFrame(
        [(float(i) if i % 4 else None, "bz"[i % 2]) for i in range(1000)], "x double, c string"
    ).withColumn("snapshot_date", F.lit(date(2024, 5, 1)))
    table = D.psi_baseline(base, "m", "2024-01-01")
    out = {r["feature"]: r for r in D.feature_psi(cur, table, "m", "2024-01-01", ["x"], ["c"]).collect()}

    edges = [-np.inf, *np.quantile(np.arange(1000.0), np.arange(1, 10) / 10, method="inverted_cdf"), np.inf]
    x = np.array([i for i in range(1000) if i % 4], float)
    p = np.maximum([((x > a) & (x <= b)).sum() / 1000 for a, b in zip(edges, edges[1:])], 1e-12)
    r = np.array([((np.arange(1000) > a) & (np.arange(1000) <= b)).sum() / 1000 for a, b in zip(edges, edges[1:])])
    assert out["x"]["psi"] == pytest.approx(_shares_term(p, r), abs=1e-12)

    # Baseline: a 0.4, b 0.5, null 0.1; no pool, so the new category z is ignored.
    ref, now = np.array([0.4, 0.5, 0.1]), np.array([1e-12, 0.5, 1e-12])
    assert out["c"]["psi"] == pytest.approx(_shares_term(now, ref), abs=1e-9)
    assert out["c"]["psi_grade"] == "high"


def test_top_k_pools_the_rest(spark):
    rows = spark.createDataFrame([(c,) for c in "aaaabbbccd"] , "v string").unionAll(spark.sql("select cast(null as string)"))
    out = {r["category"]: r["n"] for r in D.top_k_categories(rows, ["v"], 2).collect()}
    assert out == {"a": 4, "b": 3, "__OTHER__": 4}
    everything = {r["category"] for r in D.top_k_categories(rows, ["v"], 50).collect()}
    assert everything == {"a", "b", "c", "d", "__NULL__"}


def test_monthly_payload_statuses(spark):
    base = _frame(spark, BASE)
    rows = [(date(2024, m, 1), float(v)) for m in (1, 3) for v in CUR]
    predictions = spark.createDataFrame(rows, "snapshot_date date, prediction double")
    months = tables.month_spine(spark, "2024-01-01", "2024-03-01")
    out = {r["month"]: r for r in D.monthly_psi(base, predictions, months, "2024-02-01").collect()}
    assert [out[m]["status"] for m in sorted(out)] == ["SKIPPED_NO_BASELINE", "SKIPPED_NO_PREDICTION", "OK"]
    assert out["2024-01"]["overall"] is None and out["2024-01"]["psi"] is None
    assert out["2024-03"]["overall"] == pytest.approx(_scheduled(BASE, CUR), abs=1e-12)
    assert out["2024-03"]["psi"] == {"prediction": out["2024-03"]["overall"]}


def test_monitored_columns(spark):
    a = spark.createDataFrame([(1.0, 2, "x", 3, 4, 5, 6, 7)], "score double, age int, c string, q int, r int, s int, t int, u int")
    assert D.monitored_columns(a, a) == ["score", "age"]
    b = a.drop("score", "age")
    assert D.monitored_columns(b, b) == ["q", "r", "s", "t", "u"]


def test_grades(spark):
    rows = spark.createDataFrame([(v,) for v in (0.0999, 0.10, 0.2499, 0.25, float("nan"), None)], "psi double")
    out = G.grade_psi(rows).collect()
    assert [r["alert_level"] for r in out] == ["GREEN", "YELLOW", "YELLOW", "RED", "RED", None]
    assert [r["psi_grade"] for r in out] == ["low", "medium", "medium", "high", "high", None]
