"""Rank operators against brute force, including hot values and forced slicing."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import assemble as A
from riskloom.operators import ranks as R

PROBS = [i * 0.1 for i in range(10)] + [1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows; one value holds a third of them; some nulls."""
    rows = spark.range(20000).select(
        F.col("id"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"),
        F.when(F.col("id") % 3 == 0, 5.0)
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.pmod(F.hash("id"), F.lit(997)) / 10.0)
        .alias("v"),
        F.pmod(F.hash("id", F.lit(1)), F.lit(7)).cast("double").alias("w"),
    )
    rows = rows.withColumn("y", (F.coalesce("v", F.lit(0.0)) + F.pmod(F.hash("id", F.lit(2)), F.lit(60)) > 70).cast("int"))
    return rows, rows.toPandas()


@pytest.mark.parametrize("small", [10, 100_000])
def test_exact_quantiles(skewed, small):
    df, pdf = skewed
    for r in R.exact_quantiles(df, ["g"], "v", PROBS, small).collect():
        values = pdf[(pdf.g == r["g"]) & pdf.v.notna()].v
        assert r["n"] == len(values)
        assert np.allclose(r["quantiles"], np.quantile(values, PROBS), rtol=0, atol=1e-12)


def test_quantiles_of_one_value_and_one_row(spark):
    df = spark.createDataFrame([("a", 3.0)] * 5 + [("b", 1.0)], "g string, v double")
    out = {r["g"]: r["quantiles"] for r in R.exact_quantiles(df, ["g"], "v", [0.0, 0.3, 1.0], 2).collect()}
    assert out == {"a": [3.0] * 3, "b": [1.0] * 3}


@pytest.mark.parametrize("rows_per_slice", [7, 100_000])
def test_running_totals(skewed, rows_per_slice):
    df, pdf = skewed
    counts = R.value_counts(df, ["g"], "v")
    out = R.running_totals(counts, ["g"], "v", ["n"], rows_per_slice).toPandas()
    for g, part in out.groupby("g"):
        values = np.sort(pdf[(pdf.g == g) & pdf.v.notna()].v.to_numpy())
        assert (part.n_before.to_numpy() == np.searchsorted(values, part.v.to_numpy(), "left")).all()
        assert (part.n_group == len(values)).all()


def _auc(y, s):
    ranks = s.rank()
    p, n = (y == 1).sum(), (y == 0).sum()
    return (ranks[y == 1].sum() - p * (p + 1) / 2) / (p * n)


@pytest.mark.parametrize("rows_per_slice", [7, 100_000])
def test_auc(skewed, rows_per_slice):
    df, pdf = skewed
    known = pdf[pdf.v.notna()]
    for r in R.auc(df, "v", "y", ["g"], rows_per_slice).collect():
        part = known[known.g == r["g"]]
        assert r["auc"] == pytest.approx(_auc(part.y, part.v), abs=1e-12)
        assert r["gini"] == round(2 * r["auc"] - 1, 4)
    flipped = {r["g"]: r["auc"] for r in R.auc(df.withColumn("v", -F.col("v")), "v", "y", ["g"]).collect()}
    straight = {r["g"]: r["auc"] for r in R.auc(df, "v", "y", ["g"]).collect()}
    assert all(flipped[g] == pytest.approx(1 - straight[g], abs=1e-12) for g in straight)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 1, 0.7)], "g string, y int, s double")
    assert R.auc(df, "s", "y", ["g"]).first()["auc"] is None


def test_auc_agrees_with_evaluator(skewed):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df, _ = skewed
    rows = df.where("v is not null").withColumn("y", F.col("y").cast("double")).withColumn("g", F.concat(F.lit("x"), F.col("y") * 0))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="v", labelCol="y", numBins=0)
    assert R.auc(rows, "v", "y", ["g"]).first()["auc"] == pytest.approx(evaluator.evaluate(rows), abs=1e-9)


@pytest.mark.parametrize("rows_per_slice", [7, 100_000])
def test_spearman_with_nulls(skewed, rows_per_slice):
    df, pdf = skewed
    got = {(r["x_name"], r["y_name"]): r["rho"] for r in R.spearman(df, ["v", "w", "y"], rows_per_slice).collect()}
    for (a, b), rho in got.items():
        both = pdf[[a, b]].dropna().rank()
        assert rho == pytest.approx(both[a].corr(both[b]), abs=1e-9)


def test_spearman_of_many_columns(spark):
    """Null patterns shared by some columns only, a column without values, one without spread, a pair never together."""
    rng = np.random.default_rng(5)
    n = 500
    pdf = pd.DataFrame({f"c{i}": rng.integers(0, 30, n).astype(float) for i in range(6)})
    gaps = rng.random(n) < 0.3
    pdf.loc[gaps, ["c1", "c2"]] = np.nan
    pdf.loc[rng.random(n) < 0.5, "c3"] = np.nan
    pdf["even"], pdf["odd"] = pdf.c4.where(pdf.index % 2 == 0), pdf.c5.where(pdf.index % 2 == 1)
    pdf["flat"], pdf["none"] = 1.0, np.nan
    cols = list(pdf.columns)
    rows = [tuple(None if x != x else float(x) for x in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {(r.x_name, r.y_name): r for r in R.spearman(df, cols, 40).collect()}
    for i, a in enumerate(cols):
        for b in cols[i + 1 :]:
            both = pdf[[a, b]].dropna()
            if both.empty:
                assert (a, b) not in got
                continue
            assert got[a, b].n == len(both)
            want = None if "flat" in (a, b) else both.rank()[a].corr(both.rank()[b])
            assert got[a, b].rho == (None if want is None else pytest.approx(want, abs=1e-9))
    assert R.spearman(df.limit(0), cols).isEmpty()


@pytest.mark.parametrize("small", [10, 100_000])
def test_stratified_split_sizes(skewed, small):
    df, pdf = skewed
    out = A.stratified_split(df, ["id"], "y", 0.8, small=small).groupBy("split", "y").count().toPandas()
    sizes = pdf.y.value_counts()
    train = out[out.split == "train"].set_index("y")["count"]
    assert train.sum() == len(pdf) - int(np.ceil(round(0.2 * len(pdf), 6)))
    for label in sizes.index:
        assert abs(train[label] - 0.8 * sizes[label]) < 1
    assert out["count"].sum() == len(pdf)


def test_hash_split_is_disjoint_and_repeatable(skewed):
    df, pdf = skewed
    one = A.hash_split(df, ["id"]).select("id", "split").toPandas().set_index("id").split
    two = A.hash_split(df.repartition(13), ["id"]).select("id", "split").toPandas().set_index("id").split
    assert len(one) == len(pdf) and (one == two.loc[one.index]).all()
    assert abs((one == "train").mean() - 0.8) < 0.02


def test_partition_count_does_not_matter(spark, skewed):
    df, _ = skewed
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for n in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(str, R.exact_quantiles(df, ["g"], "v", PROBS, 10).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_quantiles_on_random_data(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 5000).astype(str), "v": np.round(rng.normal(size=5000), 2)})
    for r in R.exact_quantiles(spark.createDataFrame(pdf), ["g"], "v", PROBS, 100).collect():
        assert np.allclose(r["quantiles"], np.quantile(pdf[pdf.g == r["g"]].v, PROBS), atol=1e-12)


@pytest.mark.parametrize("lookup_values", [0, 100])
def test_spearman_whatever_way_ranks_are_fetched(skewed, lookup_values):
    """No column has few values, or one of three has many."""
    df, _ = skewed
    rows = lambda found: sorted((r.x_name, r.y_name, r.n, round(r.rho, 9)) for r in found.collect())
    assert rows(R.spearman(df, ["v", "w", "y"], lookup_values=lookup_values)) == rows(R.spearman(df, ["v", "w", "y"]))


def test_describe_works_out_its_columns_once(spark):
    from riskloom.operators.profile import describe

    df = spark.range(100).select((F.col("id") % 10).alias("a"), F.when(F.col("id") > 4, F.col("id")).alias("b"))
    found = describe(df, ["a", "b"])
    # Only what was stored is read: the source is in no later pass.
    assert "Range (" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r.column_name: (r["count"], r.min, r.p50, r.max) for r in describe(df, ["a", "b"]).collect()}
    assert got == {"a": (100, 0.0, 4.5, 9.0), "b": (95, 5.0, 52.0, 99.0)}
