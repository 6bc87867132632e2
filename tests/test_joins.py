from pyspark.sql import functions as F

from riskloom.operators.joins import hot_keys, lookup_join


def _tables(spark):
    rows = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("int").alias("k")
    )
    # Key 7 has two lookup rows, odd keys above 400 have none.
    lookup = spark.range(500).where("id <= 400 or id % 2 = 0").select(F.col("id").cast("int").alias("k"), F.col("id").alias("a"))
    lookup = lookup.unionAll(spark.sql("select 7 as k, 1007L as a"))
    other = spark.range(500).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("b"))
    return rows, lookup, other


def test_hot_keys_are_found(spark):
    rows, _, _ = _tables(spark)
    assert [tuple(r) for r in hot_keys(rows, ["k"], 100).collect()] == [(0, 11)]
    assert hot_keys(rows, ["k"]).count() == 0


def test_salted_join_equals_plain_join(spark):
    rows, lookup, other = _tables(spark)
    for how in ("left", "inner"):
        plain = rows.join(lookup, "k", how).join(other, "k", how)
        salted = lookup_join(rows, [lookup, other], "k", how, key_rows=100)
        assert salted.columns == plain.columns
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_hot_rows_are_spread(spark):
    rows, lookup, _ = _tables(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(rows, lookup, "k", key_rows=100)
        places = joined.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(places) > 1
    assert sum(r["count"] for r in places) == rows.where("k = 0").count()
