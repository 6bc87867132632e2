"""Session helpers: a ready-made session and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; all of them are plain Spark SQL options.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Capturing the Python call site of every column expression costs more than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "riskloom", **options: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a fresh temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors.

    A file holds ``file_rows`` at most (0: as they come). Later passes share out whole files, so rows that take long to
    work on but few bytes to store need that to reach all cores.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
