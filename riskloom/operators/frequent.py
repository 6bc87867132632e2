"""The most frequent values of columns with any number of distinct values, without shuffling those that are rare.

A first pass counts rows per bucket of hashed values, a fixed number of buckets per column, so its shuffle does not depend
on how many values there are. A value has at most the rows of its bucket. The values in the fullest buckets are counted
exactly; the k-th count found is a lower bound of the k-th count of all, so a value that can still matter lies in a bucket
with at least as many rows. If such buckets are left, their values are counted in one more pass. Nothing is estimated: a
column with one value per row ends with all its values counted, any skewed column with few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import stored

BUCKETS = 16_384
# Bits of a bitmap word that are used; the sign is left alone.
BITS = 62


def _bitmaps(buckets: DataFrame, n: int) -> DataFrame:
    """(feature, _bits): one row per column, its chosen buckets as a bitmap of fixed length."""
    words = buckets.groupBy("feature", F.floor(F.col("bucket") / BITS).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(bucket % {BITS} AS int))")).alias("bits")
    )
    packed = words.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    every = F.sequence(F.lit(0), F.lit((n - 1) // BITS))
    bits = F.transform(every, lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long")))
    return packed.select("feature", bits.alias("_bits"))


def _chosen(bucket: Column) -> Column:
    word = F.get("_bits", F.floor(bucket / BITS).cast("int"))
    return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (bucket % BITS).cast("int"))) != 0


def frequent_values(rows: DataFrame, k: int, buckets: int = BUCKETS) -> DataFrame:
    """(feature, category, n, all_rows): the ``k`` most frequent values of every feature of ``rows`` (feature, category).

    Counts are exact; equal counts are ordered by value. Features without rows have none; null is no value.
    """
    bucket = F.pmod(F.xxhash64("category"), F.lit(buckets)).cast("int")
    keyed = rows.where(F.col("category").isNotNull()).select("feature", "category", bucket.alias("bucket"))
    # At most ``buckets`` rows per column.
    full = stored(keyed.groupBy("feature", "bucket").agg(F.count("*").alias("in_bucket")), "buckets")
    fullest = Window.partitionBy("feature").orderBy(F.col("in_bucket").desc(), "bucket")
    # Twice k, since buckets may hold many rare values instead of a frequent one.
    ranked = full.withColumn("first", F.row_number().over(fullest) <= 2 * k)

    def counted(which: DataFrame, label: str) -> DataFrame:
        # One bitmap per column.
        inside = keyed.join(F.broadcast(_bitmaps(which, buckets)), "feature").where(_chosen(F.col("bucket")))
        counts = inside.groupBy("feature", "category").agg(F.count("*").alias("n"))
        return stored(_top(counts, k), label)

    top = counted(ranked.where("first"), "frequent")
    # With fewer than k values so far, every bucket may matter.
    least = top.groupBy("feature").agg(F.when(F.count("*") >= k, F.min("n")).otherwise(F.lit(1)).alias("least"))
    left = stored(
        ranked.where(~F.col("first")).join(F.broadcast(least), "feature").where(F.col("in_bucket") >= F.col("least")), "left"
    )
    if not left.isEmpty():
        top = _top(top.unionByName(counted(left, "frequent")), k)
    totals = full.groupBy("feature").agg(F.sum("in_bucket").alias("all_rows"))
    return top.join(F.broadcast(totals), "feature").select("feature", "category", "n", "all_rows")


def _top(counts: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("feature").orderBy(F.col("n").desc(), "category")
    return counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k).drop("_rank")
