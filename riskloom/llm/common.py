"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField

from riskloom.session import stored

__all__ = ["BLANKS", "BROADCAST_BYTES", "BROADCAST_ROWS", "lookup_join", "read_table", "stored"]

# Word characters are everything but the space and the ASCII controls tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"

# A lookup may be broadcast up to this many rows, and up to this many bytes for rows that are not narrow.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64_000_000


def _size(field: StructField) -> Column:
    """About the bytes of a column in one row."""
    kind, c = field.dataType, F.col(f"`{field.name}`")
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(kind, ArrayType):
        return F.greatest(F.size(c), F.lit(0)) * 8 + 8
    return F.lit(8)


def lookup_join(rows: DataFrame, lookup: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """Join a stored lookup: broadcast if its counted rows and bytes stay below the bounds, else left to the skew-aware shuffled join."""
    size = sum((_size(f) for f in lookup.schema.fields), F.lit(0))
    n, held = lookup.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    small = n <= BROADCAST_ROWS and held <= BROADCAST_BYTES
    return rows.join(F.broadcast(lookup) if small else lookup, on, how)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
