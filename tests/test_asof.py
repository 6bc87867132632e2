"""As-of joins against a search through all lookup rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators.asof import asof_join

START = dt.datetime(2024, 1, 1)


def by_search(rows, lookup, strict):
    out = []
    for key, time, tag in rows:
        known = [r for r in lookup if None not in (key, time) and r[0] == key and r[1] is not None
                 and (r[1] < time or (r[1] == time and not strict))]
        none_first = lambda r: (r[1], *((v is not None, v or 0) for v in r[2:]))
        best = max(known, key=none_first, default=(None,) * 4)
        out.append((key, time, tag, *best[2:]))
    return out


def drawn(seed):
    draw = random.Random(seed)
    at = lambda: draw.choice([None, *[START + dt.timedelta(hours=draw.randrange(300))] * 20])
    # One key has a third of the rows, one of its times many of them.
    key = lambda: draw.choice([1, 1, 1, 2, 3, 4, None, *range(10, 15)])
    rows = [(key(), at(), i) for i in range(600)] + [(1, START + dt.timedelta(hours=150), 1000 + i) for i in range(150)]
    lookup = [(key(), at(), draw.choice([None, 1, 2, 3]), draw.choice([None, 0.5, 2.5])) for _ in range(400)]
    lookup += lookup[:20]
    return rows, lookup


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("key_rows", [40, 1_000_000])
def test_last_known_row(spark, strict, key_rows):
    rows, lookup = drawn(7)
    left = spark.createDataFrame(rows, "k long, t timestamp, tag long")
    right = spark.createDataFrame(lookup, "k long, t timestamp, x long, y double")
    other = right.where("x is not null").select("k", "t", F.col("x").alias("z"))
    got = asof_join(left, [right, other], "k", "t", strict, key_rows)
    assert got.columns == ["k", "t", "tag", "x", "y", "z"]
    found = sorted(map(tuple, got.collect()), key=lambda r: r[2])
    assert [r[:5] for r in found] == sorted(by_search(rows, lookup, strict), key=lambda r: r[2])
    some = [(*r[:3], None) for r in lookup if r[2] is not None]
    assert [(*r[:3], r[5]) for r in found] == sorted((r[:4] for r in by_search(rows, some, strict)), key=lambda r: r[2])


def test_a_frequent_key_is_ordered_in_several_tasks(spark):
    rows = spark.range(9000).select(
        F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("t"), F.col("id").alias("tag")
    )
    lookup = rows.where("tag % 100 = 0").select("k", "t", F.col("tag").alias("x"))
    got = asof_join(rows, lookup, "k", "t", key_rows=500)
    assert got.where("x <> tag - tag % 100 OR x is null").count() == 0 and got.count() == 9000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan and "CartesianProduct" not in plan


def test_empty_sides_and_clashing_names(spark):
    left = spark.createDataFrame([(1, START, 5)], "k long, t timestamp, tag long")
    right = spark.createDataFrame([], "k long, t timestamp, x long")
    assert [tuple(r) for r in asof_join(left, right, "k", "t").collect()] == [(1, START, 5, None)]
    assert asof_join(left.limit(0), right, "k", "t").count() == 0
    with pytest.raises(ValueError):
        asof_join(left, right.withColumnRenamed("x", "tag"), "k", "t")
