"""Which months of a feed differ from what was processed last.

A month's digest is its number of rows and two sums over hashes of its rows, so neither the order of rows nor their files
matter, and repeated rows count as often as they stand there. Digests are stored after everything that depends on the month
is written: a run that dies before repeats its months.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.tables import MONTH, write_table

DIGEST = "snapshot_date date, row_count bigint, digest string"


def _hashed(cols: Sequence[str], salt: int) -> Column:
    """Hash of a row; nulls count, since a hash passes over them otherwise."""
    parts = [p for c in cols for p in (F.col(c).isNull(), F.col(c))]
    return F.sum(F.xxhash64(F.lit(salt), *parts).cast("decimal(38,0)")).cast("string")


def month_digests(df: DataFrame) -> DataFrame:
    """(snapshot_date, row_count, digest): one row per month, in one pass with partial sums."""
    cols = [c for c in df.columns if c != MONTH]
    return df.groupBy(F.col(MONTH).cast("date").alias(MONTH)).agg(
        F.count("*").alias("row_count"), F.concat_ws(":", _hashed(cols, 1), _hashed(cols, 2)).alias("digest")
    )


def stored_digests(spark: SparkSession, path: str) -> DataFrame:
    """Digests of the last complete run; none before the first."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], DIGEST)
    return spark.read.schema(DIGEST).parquet(path)


def store_digests(digests: DataFrame, path: str, months: Sequence[date]) -> None:
    """Replace the digests of ``months``; those without rows are removed."""
    write_table(digests.where(F.col(MONTH).isin(list(months))), path, rebalance=False, months=months)


def changed_months(now: DataFrame, before: DataFrame) -> list[date]:
    """Months that are new, differ or are gone, in order: one row per month reaches the driver."""
    old = before.select(F.col(MONTH).alias("_month"), F.col("row_count").alias("_rows"), F.col("digest").alias("_digest"))
    both = now.join(old, F.col(MONTH) == F.col("_month"), "full")
    same = F.col("row_count").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest"))
    found = both.where(~same).select(F.coalesce(MONTH, "_month").alias(MONTH)).where(F.col(MONTH).isNotNull())
    return sorted(r[0] for r in found.collect())
