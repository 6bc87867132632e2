"""The most frequent values by buckets, against a plain count."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift as D
from riskloom.operators.frequent import frequent_values


def plain(values, k):
    counts = Counter(v for v in values if v is not None)
    return sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]


def check(spark, columns, k, buckets):
    rows = [(name, v) for name, values in columns.items() for v in values]
    found = frequent_values(spark.createDataFrame(rows, "feature string, category string").repartition(5), k, buckets)
    got = {}
    for r in found.collect():
        got.setdefault(r["feature"], []).append((r["category"], r["n"]))
        assert r["all_rows"] == sum(v is not None for v in columns[r["feature"]])
    for name, values in columns.items():
        assert sorted(got.get(name, []), key=lambda c: (-c[1], c[0])) == plain(values, k), name


@pytest.mark.parametrize("buckets", [1, 7, 64, 16_384])
def test_equals_a_plain_count(spark, buckets):
    check(
        spark,
        {
            "unique": [f"u{i}" for i in range(500)],
            "skewed": ["hot"] * 400 + [f"s{i}" for i in range(300)] + ["warm"] * 30,
            "few": ["a", "b", "a", ""],
            # Many rare values fill buckets that outgrow those of frequent ones.
            "steps": [f"v{i}" for i in range(40) for _ in range(i)],
            "ties": [f"t{i % 50:02d}" for i in range(500)],
            "empty": [None, None],
        },
        5,
        buckets,
    )


def test_no_rows(spark):
    none = spark.createDataFrame([], "feature string, category string")
    assert frequent_values(none, 3).collect() == []


def test_pooled_categories_do_not_depend_on_buckets(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, (F.col("id") % 900).cast("string")).alias("wide"),
        (F.col("id") % 3).alias("few"), F.col("id").alias("key"),
    )
    rows = lambda out: sorted(tuple(r) for r in out.collect())
    direct = rows(D.top_k_categories(df, ["wide", "few", "key"], 10))
    assert rows(D.top_k_categories(df, ["wide", "few", "key"], 10, buckets=512)) == direct
    assert sum(1 for r in direct if r[1] == D.OTHER_TOKEN) == 2


def test_rare_values_of_a_skewed_column_are_not_counted(spark, monkeypatch):
    from riskloom.operators import frequent

    sizes = []
    real = frequent._top
    monkeypatch.setattr(frequent, "_top", lambda counts, k: sizes.append(counts.count()) or real(counts, k))
    n = F.col("id")
    category = F.when(n % 2 == 0, F.concat(F.lit("hot"), n % 6)).otherwise(F.concat(F.lit("rare"), n))
    rows = spark.range(40_000).select(F.lit("f").alias("feature"), category.alias("category"))
    assert {r["category"] for r in frequent_values(rows, 3).collect()} == {"hot0", "hot2", "hot4"}
    # 20,003 distinct values, of which only those in the fullest buckets are counted one by one.
    assert max(sizes) < 100
