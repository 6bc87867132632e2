"""Monthly tables: one table per layer, partitioned by ``snapshot_date``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.months import as_date, month_start

MONTH = "snapshot_date"
# Files that a task writes side by side; with more months its rows are sorted.
OPEN_FILES = 16


def snapshot(df: DataFrame, month: str | date | Column) -> DataFrame:
    return df.where(F.col(MONTH) == as_date(month))


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (MONTH,),
    fmt: str = "parquet",
    rebalance: bool = True,
    months: Sequence[str | date] | None = None,
    within: Mapping[str, str] | None = None,
) -> None:
    """Overwrite the partitions present in ``df``; with ``months`` those of them without rows are emptied as well.

    ``months`` are the months that a run covers, so that a rerun replaces all of them. ``within`` names the values of the
    other partition columns that the run is about; partitions with other values are never emptied.

    The rebalance hint sizes the output files by volume: a month with a third of all rows
    is split over many tasks, small months share one. It costs a shuffle, which input that
    is already clustered by month can do without (``rebalance=False``): a task then keeps a file open for each of the few
    months it meets, up to ``OPEN_FILES``, instead of sorting its rows.
    """
    rows = df.hint("rebalance", *partition_by) if rebalance else df
    spark = df.sparkSession
    before = {} if months is None else _covered(spark, path, partition_by, months, within or {})
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if fmt == "parquet":
        # Monthly tables are kept, so they are packed tighter than scratch files.
        writer = writer.option("compression", "zstd")
    side_by_side = "spark.sql.maxConcurrentOutputFileWriters"
    earlier = spark.conf.get(side_by_side)
    spark.conf.set(side_by_side, earlier if rebalance else str(OPEN_FILES))
    try:
        writer.format(fmt).save(path)
    finally:
        spark.conf.set(side_by_side, earlier)
    if before:
        # A partition that was written holds files with new names; the same files as before mean no rows now.
        after = _covered(spark, path, partition_by, months, within or {})
        for folder in before:
            if after.get(folder) == before[folder]:
                place = spark._jvm.org.apache.hadoop.fs.Path(folder)
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _covered(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    months: Sequence[str | date],
    within: Mapping[str, str],
) -> dict[str, frozenset[str]]:
    """File names in every partition folder of the covered months."""
    covered = {str(m)[:10] if len(str(m)) > 7 else f"{m}-01" for m in months}
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    pattern = "/".join([path, *[f"{c}={within.get(c, '*')}" for c in partition_by]])
    out = {}
    for found in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(pattern)) or []:
        folder = found.getPath().toString().rstrip("/")
        values = dict(p.split("=", 1) for p in folder.split("/")[-len(partition_by) :])
        if values.get(MONTH) in covered:
            out[folder] = frozenset(f.getPath().getName() for f in fs.listStatus(found.getPath()))
    return out


def ingest_bronze(df: DataFrame, path: str, months: Sequence[str | date] | None = None) -> None:
    """Persist the raw rows unchanged, one partition per month."""
    write_table(df, path, months=months)


def read_snapshot(spark: SparkSession, path: str, month: str | date) -> DataFrame:
    """Exactly one month of a table; an absent month is an error."""
    df = snapshot(spark.read.parquet(path), month)
    if df.isEmpty():
        raise FileNotFoundError(f"{path} has no rows for {month}")
    return df


def read_snapshots(spark: SparkSession, path: str, lo: str | date, hi: str | date) -> DataFrame:
    """All months from ``lo`` to ``hi``, both included; other partitions are not listed."""
    return between_months(spark.read.parquet(path), lo, hi)


def between_months(df: DataFrame, lo: str | date | Column, hi: str | date | Column) -> DataFrame:
    return df.where(F.col(MONTH).between(as_date(lo), as_date(hi)))


def read_lagged(df: DataFrame, as_of: str | date, months: int = 6) -> DataFrame:
    """The ``months`` snapshots before ``as_of`` that exist, tagged with ``months_ago``."""
    day = as_date(as_of)
    lagged = df.where(
        (F.col(MONTH) >= F.add_months(day, -months)) & (F.col(MONTH) <= F.add_months(day, -1))
    )
    return lagged.withColumn("months_ago", F.months_between(day, F.col(MONTH)).cast("int"))


def select_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select([c for c in cols if c in df.columns])


def month_spine(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """First-of-month dates from the month of ``start`` through ``end`` inclusive."""
    months = F.sequence(month_start(as_date(start)), as_date(end), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias(MONTH))


def spine_of(df: DataFrame) -> DataFrame:
    """Every month from the first to the last one in ``df``, gaps included."""
    ends = df.agg(F.min(MONTH).alias("lo"), F.max(MONTH).alias("hi"))
    months = F.sequence(month_start(F.col("lo")), F.col("hi"), F.expr("interval 1 month"))
    return ends.select(F.explode(months).alias(MONTH))


def row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(MONTH).agg(F.count("*").alias("row_count"))


def snapshot_coverage(tables: Mapping[str, DataFrame], root: str | date) -> DataFrame:
    """Per table: first and last month, number of months, months before and from ``root``,
    months missing in between and the recommended start of monitoring."""
    months = None
    for name, df in tables.items():
        one = df.select(F.lit(name).alias("table_name"), MONTH).distinct()
        months = one if months is None else months.unionAll(one)
    day = as_date(root)
    before = F.col(MONTH) < day
    out = months.groupBy("table_name").agg(
        F.min(MONTH).alias("earliest"),
        F.max(MONTH).alias("latest"),
        F.count("*").alias("months"),
        F.count_if(before).alias("months_before_root"),
        F.count_if(~before).alias("months_from_root"),
    )
    span = F.months_between(F.col("latest"), F.col("earliest")).cast("bigint") + 1
    return out.select(
        "*",
        (span - F.col("months")).alias("months_missing"),
        F.when(F.col("months_before_root") > 0, F.col("earliest")).otherwise(day).alias(
            "recommended_start"
        ),
    )


def missing_months(df: DataFrame) -> DataFrame:
    """Months between the first and the last snapshot that hold no rows."""
    return spine_of(df).join(df.select(MONTH).distinct(), MONTH, "left_anti")


def latest_per(df: DataFrame, key: Sequence[str], order: Column) -> DataFrame:
    """One row per key: the one that is last by ``order`` (history stores, small)."""
    window = Window.partitionBy(*key).orderBy(order.desc())
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
