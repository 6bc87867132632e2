"""Reading raw feeds and foreign prediction layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.sources.schemas import raw_schema

# Levels below a root at which a month's predictions are looked for.
MAX_DEPTH = 4


def read_feed(spark: SparkSession, feed: str, path: str) -> DataFrame:
    """Header CSV scan of one feed, every column as text.

    The header is checked against the schema, so a file with other columns fails.
    """
    return (
        spark.read.schema(raw_schema(feed))
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def predictions_for_month(spark: SparkSession, root: str, month: str) -> DataFrame:
    """All predictions of ``month`` (``YYYY-MM``) below ``root``, each file once.

    Known layouts: ``date=YYYY-MM/``, ``snapshot_date=YYYY-MM-01/`` and names that hold
    ``preds_YYYY_MM`` or ``preds_YYYY_MM_...``, at any of the first levels below ``root``. Only
    paths of the month are listed and only their schemas are read.
    """
    name = month.replace("-", "_")
    ends = [
        f"date={month}/*.parquet",
        f"snapshot_date={month}-01/*.parquet",
        f"*preds_{name}.parquet",
        f"*preds_{name}_*.parquet",
    ]
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    found = set()
    for depth in range(MAX_DEPTH):
        for end in ends:
            for status in fs.globStatus(path("/".join([root, *["*"] * depth, end]))) or []:
                found.add(status.getPath().toString())
    if not found:
        raise FileNotFoundError(f"{root} has no predictions of {month}")
    return spark.read.option("mergeSchema", True).parquet(*sorted(found))
