"""Joining a counted table back to its rows, with frequent keys spread over tasks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored

# Rows of one key that one task joins at least, and the bytes that the list of more frequent keys may take.
KEY_ROWS = 1_000
LIST_BYTES = 32 << 20


def join_counted(rows: DataFrame, table: DataFrame, key: str, key_rows: int = KEY_ROWS) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per ``key`` (never null) and in ``n`` how many rows have it.

    A key with more rows than a limit is spread over as many salts as it needs, its row in ``table`` repeated for each. The
    limit grows with all rows such that the keys above it, which are broadcast, always fit ``LIST_BYTES``.
    """
    width = F.max(F.octet_length(F.col(key).cast("string")))
    total, widest = table.agg(F.sum("n"), width).first()
    if not total:
        return rows.join(table, key)
    limit = max(key_rows, math.ceil(total * (widest + 32) / LIST_BYTES))
    hot = table.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int").alias("_salts"))
    hot = stored(hot, "hot-keys")
    if hot.isEmpty():
        return rows.join(table, key)
    hot, salts = F.broadcast(hot), F.coalesce("_salts", F.lit(1))
    spread = rows.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), salts).cast("int"))
    copies = table.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return spread.drop("_salts").join(copies.drop("_salts"), [key, "_salt"]).drop("_salt")
