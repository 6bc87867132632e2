"""Equi-joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import stored

# Rows of one key that one task should join; a key with more is spread over as many salts as it needs.
KEY_ROWS = 1_000_000
# Hot keys are broadcast up to this many, else joined by shuffle.
BROADCAST_KEYS = 50_000


def hot_keys(rows: DataFrame, on: Sequence[str], key_rows: int = KEY_ROWS) -> DataFrame:
    """Keys with more than ``key_rows`` rows and the ``_salts`` they need: an exact count with map-side partial sums."""
    counts = rows.select(*on).groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > key_rows)
    return counts.select(*on, F.ceil(F.col("_n") / key_rows).cast("int").alias("_salts"))


def lookup_join(
    rows: DataFrame,
    lookups: DataFrame | Sequence[DataFrame],
    on: str | Sequence[str],
    how: str = "left",
    key_rows: int = KEY_ROWS,
) -> DataFrame:
    """Join ``rows`` with one or more lookup tables on the same key (left or inner).

    Rows of a hot key are spread over salted partitions, each with about ``key_rows`` of them, and the lookup rows of
    that key are repeated for each salt, so every match is kept. All lookups use the same salted key: ``rows`` is
    shuffled once, however many lookups there are.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    on = [on] if isinstance(on, str) else list(on)
    tables = [lookups] if isinstance(lookups, DataFrame) else list(lookups)
    hot = stored(hot_keys(rows, on, key_rows), "hot-keys")
    found = hot.count()
    if not found:
        out = rows
        for table in tables:
            out = out.join(table, on, how)
        return out
    hot = F.broadcast(hot) if found <= BROADCAST_KEYS else hot
    # The salt depends on the row's content only, so a retried task repeats it.
    spread = F.pmod(F.xxhash64(*rows.columns), F.coalesce("_salts", F.lit(1))).cast("int")
    out = rows.join(hot, on, "left").withColumn("_salt", spread).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    for table in tables:
        salted = table.join(hot, on, "left").withColumn("_salt", copies).drop("_salts")
        out = out.join(salted, [*on, "_salt"], how)
    return out.drop("_salt")
