"""Stored monthly sketches against numpy and sets."""

import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import sketches as S

MONTHS = [date(2024, m, 1) for m in range(1, 5)]
PROBS = [0.1, 0.25, 0.5, 0.995]
WINDOWS = [("all", MONTHS[0], MONTHS[3]), ("first", MONTHS[0], MONTHS[0]), ("late", MONTHS[2], MONTHS[3])]


def _rows(n=4000):
    rng = random.Random(3)
    out = []
    for i in range(n):
        # "hot" is one value in 99 of 100 rows; "part" has nulls and NaN.
        part = None if i % 7 == 0 else float("nan") if i % 11 == 0 else rng.gauss(0, 1)
        out.append((rng.choice(MONTHS), rng.randrange(50) / 4, 0.0 if i % 100 else rng.random(), part, str(i % 90)))
    return out


@pytest.fixture(scope="module")
def table(spark):
    rows = _rows()
    schema = "snapshot_date date, few double, hot double, part double, name string"
    return spark.createDataFrame(rows, schema).repartition(6).cache(), rows


@pytest.fixture(scope="module")
def windows(spark):
    return spark.createDataFrame([*WINDOWS, ("none", date(2030, 1, 1), date(2030, 2, 1))], "window string, lo date, hi date")


def _expected(rows, k, lo, hi, method):
    values = [r[k] for r in rows if lo <= r[0] <= hi and r[k] is not None and r[k] == r[k]]
    return len(values), np.quantile(np.array(values), PROBS, method=method)


@pytest.mark.parametrize(
    "interpolate, size, margin, slice_rows",
    [(False, 4096, 0.005, 100_000), (True, 4096, 0.005, 100_000), (True, 64, 0.1, 50), (False, 8, 0.0, 50)],
)
def test_windows_are_exact(spark, scratch, table, windows, interpolate, size, margin, slice_rows):
    """The last case has brackets without any width around a rough sketch, so ranks fall into gaps."""
    df, rows = table
    cols = ["few", "hot", "part"]
    path = scratch("sketches")
    S.store_sketches(S.quantile_sketches(df, cols, size), path)
    known = spark.read.parquet(path)
    found = S.window_quantiles(df, known, windows, cols, PROBS, interpolate, margin, slice_rows).collect()
    assert len(found) == len(WINDOWS) * len(cols)
    bounds = {w: (lo, hi) for w, lo, hi in WINDOWS}
    method = "linear" if interpolate else "inverted_cdf"
    for r in found:
        n, want = _expected(rows, cols.index(r.feature) + 1, *bounds[r.window], method)
        assert r.n == n
        np.testing.assert_allclose(r.quantiles, want, rtol=0, atol=1e-12)


def test_all_equal_and_empty(spark, windows):
    schema = "snapshot_date date, v double"
    same = spark.createDataFrame([(MONTHS[0], 5.0)] * 3000 + [(MONTHS[0], float("inf"))], schema)
    found = S.window_quantiles(same, S.quantile_sketches(same, ["v"]), windows, ["v"], [0.0, 0.5, 1.0]).collect()
    assert {(r.window, tuple(r.quantiles)) for r in found} == {
        (w, (5.0, 5.0, float("inf"))) for w in ("all", "first")
    }
    for rows in ([], [(MONTHS[0], None)] * 3):
        none = spark.createDataFrame(rows, schema)
        assert S.window_quantiles(none, S.quantile_sketches(none, ["v"]), windows, ["v"], [0.5]).isEmpty()


def test_sketches_of_other_rows_are_an_error(spark, windows):
    schema = "snapshot_date date, v double"
    known = S.quantile_sketches(spark.createDataFrame([(MONTHS[0], float(i)) for i in range(100)], schema), ["v"])
    fewer = spark.createDataFrame([(MONTHS[0], 1.0)], schema)
    with pytest.raises(Exception, match="do not belong"):
        S.window_quantiles(fewer, known, windows, ["v"], [0.9]).collect()


def test_one_month_is_replaced(spark, scratch, table, windows):
    df, rows = table
    path = scratch("sketches")
    S.store_sketches(S.quantile_sketches(df, ["few"]), path)
    corrected = df.withColumn("few", F.when(F.col("snapshot_date") == F.lit(MONTHS[1]), F.col("few") * 3).otherwise(F.col("few")))
    one = corrected.where(F.col("snapshot_date") == F.lit(MONTHS[1]))
    S.store_sketches(S.quantile_sketches(one, ["few"]), path)
    known = spark.read.parquet(path)
    assert known.count() == len(MONTHS)
    found = S.window_quantiles(corrected, known, windows, ["few"], PROBS).where("window = 'all'").first()
    fixed = [(r[0], r[1] * (3 if r[0] == MONTHS[1] else 1)) for r in rows]
    assert found.quantiles == list(_expected(fixed, 1, MONTHS[0], MONTHS[3], "inverted_cdf")[1])
    # A covered month without rows loses its sketch.
    S.store_sketches(S.quantile_sketches(one.where("false"), ["few"]), path, months=[str(MONTHS[1])])
    assert spark.read.parquet(path).count() == len(MONTHS) - 1


def test_distinct_values_gained_and_lost(spark, windows):
    sets = {MONTHS[0]: range(0, 300), MONTHS[1]: range(100, 350), MONTHS[3]: range(0, 50)}
    rows = [(m, str(i) if i % 10 else None) for m, s in sets.items() for i in s for _ in range(2)]
    known = S.distinct_sketches(spark.createDataFrame(rows, "snapshot_date date, v string"), ["v"])
    real = {m: {i for i in s if i % 10} for m, s in sets.items()}
    before = set()
    for r in S.month_turnover(known).orderBy("snapshot_date").collect():
        now = real[r.snapshot_date]
        assert (r.distinct_values, r.gained, r.lost, r.kept) == (
            len(now), len(now - before), len(before - now), len(now & before)
        )
        before = now
    assert {r.window: r.distinct_values for r in S.window_distinct(known, windows).collect()} == {
        "all": len(real[MONTHS[0]] | real[MONTHS[1]]), "first": len(real[MONTHS[0]]), "late": len(real[MONTHS[3]]),
    }


def test_distinct_error_is_bounded(spark):
    df = spark.range(400_000).select(F.lit(MONTHS[0]).alias("snapshot_date"), F.col("id").alias("v"))
    found = S.month_turnover(S.distinct_sketches(df, ["v"])).first().distinct_values
    assert abs(found - 400_000) < 400_000 * 4 * 2 ** (-S.THETA_LOG / 2)
