"""As-of joins: every row gets the values last known for its key at its own time.

Both sides collapse to one row per key and time before anything is ordered. The union of all sides is ordered by time
within a key, and the last known row of each lookup is carried forward. A key with more rows than one task should order
is cut into ranges of time at the quantiles of its own times; what is known when a range starts is handed on from the
ranges before it. The result goes back to the rows by key and time, salted where one key and time has many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.joins import BROADCAST_KEYS, KEY_ROWS, hot_keys, lookup_join
from riskloom.session import stored

# Quantiles that are kept of the times of a frequent key: the ranges it can have at most.
RANGES = 1_000


def asof_join(
    rows: DataFrame,
    lookups: DataFrame | Sequence[DataFrame],
    on: str | Sequence[str],
    time: str,
    strict: bool = False,
    key_rows: int = KEY_ROWS,
) -> DataFrame:
    """``rows`` with the columns of each lookup's last row of the same key at or before (``strict``: before) ``time``.

    All tables share the columns ``on`` and ``time``, a date or a timestamp. Every row of ``rows`` is returned once. Of
    several lookup rows with equal key and time the largest, compared column by column, counts; columns are null where
    nothing is known, or where a key column or the time is null. Lookup rows with a null key or time are never found.
    """
    on = [on] if isinstance(on, str) else list(on)
    tables = [lookups] if isinstance(lookups, DataFrame) else list(lookups)
    columns = [[c for c in t.columns if c not in (*on, time)] for t in tables]
    names = [c for cols in columns for c in cols]
    if len({*rows.columns, *names}) < len(rows.columns) + len(names):
        raise ValueError("value columns need names of their own")
    complete = F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in (*on, time)))
    # One row per key and time of each side; what a side says stands in a column of its own.
    said = [f"_said_{i}" for i in range(len(tables))]
    kinds = [f"struct<{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in t.select(*c).schema)}>"
             for t, c in zip(tables, columns)]
    asked = rows.where(complete).select(*on, time).distinct().select(
        *on, time, F.lit(True).alias("_asked"), *[F.lit(None).cast(k).alias(s) for s, k in zip(said, kinds)]
    )
    union = asked
    for i, (table, cols) in enumerate(zip(tables, columns)):
        known = table.where(complete).groupBy(*on, time).agg(F.max(F.struct(*cols)).alias("_row"))
        filled = [F.col("_row").alias(s) if j == i else F.lit(None).cast(kinds[j]).alias(s) for j, s in enumerate(said)]
        union = union.unionAll(known.select(*on, time, F.lit(False).alias("_asked"), *filled))
    # Lookups of the same time come before the rows that ask, or after them.
    order = [F.col(time), F.col("_asked").asc() if not strict else F.col("_asked").desc()]
    hot = stored(hot_keys(union, on, key_rows), "asof-hot")
    n_hot = hot.count()
    if n_hot:
        union = stored(_in_ranges(union, hot, on, time, n_hot), "asof-ranges")
        within = Window.partitionBy(*on, "_range").orderBy(*order)
        last = _carried(union, within, said)
        starts = _handed_on(union, on, time, said)
        same = [*on, "_range"]
        last = last.where("_asked").join(starts, same, "left")
        # What the range itself has not said yet was said before it.
        last = last.select(*on, time, *[F.coalesce(f"_last{s}", f"_before{s}").alias(s) for s in said])
    else:
        within = Window.partitionBy(*on).orderBy(*order)
        last = _carried(union, within, said).where("_asked").select(*on, time, *[F.col(f"_last{s}").alias(s) for s in said])
    values = [F.col(s)[c].alias(c) for s, cols in zip(said, columns) for c in cols]
    found = lookup_join(rows, last.select(*on, time, *values), [*on, time], key_rows=key_rows)
    return found.select(*rows.columns, *names)


def _carried(union: DataFrame, within, said: Sequence[str]) -> DataFrame:
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return union.withColumns({f"_last{s}": F.last(s, ignorenulls=True).over(so_far) for s in said})


def _in_ranges(union: DataFrame, hot: DataFrame, on: Sequence[str], time: str, n_hot: int) -> DataFrame:
    """``union`` with ``_range``: the number of its key's cuts up to its time, null for a key that is not frequent."""
    hot = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
    place: Column = F.unix_micros(F.col(time).cast("timestamp"))
    grid = [i / RANGES for i in range(1, RANGES)]
    sketch = union.join(hot, list(on)).groupBy(*on, "_salts").agg(F.percentile_approx(place, grid, 10 * RANGES).alias("_grid"))
    # A cut at every so many quantiles, as many as the key has salts; equal cuts are one.
    every = F.greatest(F.lit(1), F.floor(F.lit(RANGES) / F.col("_salts")).cast("int"))
    cuts = F.array_distinct(F.filter("_grid", lambda _, i: (i + 1) % every == 0))
    cuts = stored(sketch.select(*on, cuts.alias("_cuts")), "asof-cuts")
    cuts = F.broadcast(cuts) if n_hot <= BROADCAST_KEYS // RANGES else cuts
    reached = F.size(F.filter("_cuts", lambda c: c <= place))
    return union.join(cuts, list(on), "left").withColumn("_range", F.when(F.col("_cuts").isNotNull(), reached)).drop("_cuts")


def _handed_on(union: DataFrame, on: Sequence[str], time: str, said: Sequence[str]) -> DataFrame:
    """Per key and range: what each lookup said last in the ranges before it. One row per range of a frequent key."""
    ends = union.where("_range > 0 OR _range = 0 AND NOT _asked").groupBy(*on, "_range").agg(
        *[F.max_by(s, F.when(F.col(s).isNotNull(), F.col(time))).alias(s) for s in said]
    )
    earlier = Window.partitionBy(*on).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(*on, "_range", *[F.last(s, ignorenulls=True).over(earlier).alias(f"_before{s}") for s in said])
    return handed.where("_range > 0")
