"""Monthly sketches that are stored once and merged for any window of months.

Quantiles: each month keeps one bounded quantile sketch per column. A window's sketches are merged without reading rows;
the merged sketch brackets each wanted rank, and one pass over the window's rows makes the result exact: values inside a
bracket are counted one by one, rows outside all of them only per gap between brackets. All windows share that pass. A rank
that falls into a gap after all is looked for again with the whole range as its bracket, so results never depend on the
sketch's luck.

Distinct values: each month keeps one theta sketch per column. Unions, months gained and months lost come from the sketches
alone; up to ``2 ** THETA_LOG`` distinct values they are exact, beyond that the relative standard error is about
``2 ** (-THETA_LOG / 2)``.

A null or NaN value counts as a row only. Months without rows have no sketch, windows without values no result.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ranks import running_totals
from riskloom.session import stored
from riskloom.sources.tables import MONTH, write_table

#: Size of a quantile sketch: about 100 KB a column and month, and a rank error near 0.13 %.
QUANTILE_SIZE = 4096
#: Half the width of a bracket, as a share of the rows: four times that error.
MARGIN = 0.005
OTHER_ROWS = "the sketches do not belong to these rows"
#: Log of the values that a distinct sketch keeps.
THETA_LOG = 16


def _stacked(wide: DataFrame, cols: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """One row per month and feature from columns ``<part>_<i>``."""
    rows = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{p}_{i}").alias(p) for p in parts]) for i, c in enumerate(cols)
    ]
    return wide.select(MONTH, "rows", F.inline(F.array(*rows)))


def _number(c: str) -> Column:
    return F.nullif(F.col(c).try_cast("double"), F.lit(float("nan")))


def quantile_sketches(df: DataFrame, cols: Sequence[str], size: int = QUANTILE_SIZE) -> DataFrame:
    """(snapshot_date, rows, feature, n, low, high, sketch): one pass, one row per month and column."""
    aggregates = [
        a
        for i, c in enumerate(cols)
        for a in (
            F.count(_number(c)).alias(f"n_{i}"),
            F.min(_number(c)).alias(f"low_{i}"),
            F.max(_number(c)).alias(f"high_{i}"),
            F.kll_sketch_agg_double(_number(c), F.lit(size)).alias(f"sketch_{i}"),
        )
    ]
    wide = df.groupBy(MONTH).agg(F.count("*").alias("rows"), *aggregates)
    return _stacked(wide, cols, ["n", "low", "high", "sketch"])


def distinct_sketches(df: DataFrame, cols: Sequence[str], log_size: int = THETA_LOG) -> DataFrame:
    """(snapshot_date, rows, feature, sketch) of the distinct non-null values of every month and column."""
    aggregates = [
        F.theta_sketch_agg(F.col(c).cast("string"), F.lit(log_size)).alias(f"sketch_{i}") for i, c in enumerate(cols)
    ]
    return _stacked(df.groupBy(MONTH).agg(F.count("*").alias("rows"), *aggregates), cols, ["sketch"])


def store_sketches(sketches: DataFrame, path: str, months: Sequence[str | date] | None = None) -> None:
    """Replace the months present in ``sketches``; of ``months``, those without rows are emptied."""
    write_table(sketches, path, rebalance=False, months=months)


def merged_sketches(sketches: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, feature, n, low, high, sketch) of each window; ``windows`` has the columns window, lo and hi."""
    held = sketches.where("n > 0").join(F.broadcast(windows), F.col(MONTH).between(F.col("lo"), F.col("hi")))
    return held.groupBy("window", "feature").agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def _brackets(merged: DataFrame, probs: Sequence[float], margin: float) -> DataFrame:
    """Ends of the bracket of every wanted rank; where the margin is less than some rows, the whole range."""

    def end(i: int, side: int) -> Column:
        share = min(max(probs[i] + side * margin, 0.0), 1.0)
        whole = F.col("low") if side < 0 else F.col("high")
        if share in (0.0, 1.0):
            return whole
        found = F.kll_sketch_get_quantile_double("sketch", F.lit(share))
        return F.when(F.col("n") * margin < 4, whole).otherwise(found) if margin else found

    ends = [F.array(*[end(i, side) for i in range(len(probs))]) for side in (-1, 1)]
    return merged.select("window", "feature", "n", "low", "high", ends[0].alias("_los"), ends[1].alias("_his"))


def _cells(rows: DataFrame, brackets: DataFrame, n: int) -> DataFrame:
    """Row counts per value inside a bracket, and per gap: a gap is named by the bracket's end before it.

    ``place`` orders them: a gap follows the value that names it.
    """
    known = F.broadcast(brackets.select(F.col("window").alias("_w"), F.col("feature").alias("_f"), "_los", "_his"))
    held = rows.join(known, (F.col("window") == F.col("_w")) & (F.col("feature") == F.col("_f")))
    inside = F.expr(" OR ".join(f"value BETWEEN _los[{i}] AND _his[{i}]" for i in range(n)))
    ended = F.greatest(F.lit(float("-inf")), *[F.expr(f"if(_his[{i}] < value, _his[{i}], null)") for i in range(n)])
    place = F.struct(F.when(inside, F.col("value")).otherwise(ended).alias("value"), (~inside).alias("gap"))
    return held.groupBy("window", "feature", place.alias("place")).agg(F.count("*").alias("copies"))


def _found(
    rows: DataFrame, brackets: DataFrame, probs: Sequence[float], interpolate: bool, slice_rows: int
) -> DataFrame:
    """(window, feature, n, quantiles): ``quantiles`` is null where a rank fell into a gap."""
    by = ["window", "feature"]
    totals = running_totals(_cells(rows, brackets, len(probs)), by, "place", ["copies"], slice_rows)
    n, p = F.col("n"), F.get(F.lit(list(probs)), F.col("i"))
    position = p * (n - 1) if interpolate else F.greatest(F.ceil(F.round(p * n, 6)), F.lit(1)) - 1
    wanted = (
        brackets.select(*by, "n", F.explode(F.lit(list(range(len(probs))))).alias("i"))
        .withColumn("_p", position.cast("double"))
        .select(F.col("window").alias("_w"), F.col("feature").alias("_f"), "n", "i", "_p")
    )
    # One row per window, column and wanted rank; only the cells around a rank pass the join.
    first, last = F.floor("_p"), F.ceil("_p")
    past = F.col("copies_before") + F.col("copies")
    own = (F.col("window") == F.col("_w")) & (F.col("feature") == F.col("_f"))
    near = totals.join(F.broadcast(wanted), own & (F.col("copies_before") <= last) & (past > first))

    def at(rank: Column) -> Column:
        held = (F.col("copies_before") <= rank) & (rank < past) & ~F.col("place.gap")
        return F.max(F.when(held, F.col("place.value")))

    picked = near.groupBy(*by, "n", "i", "_p").agg(
        at(first).alias("_lo"), at(last).alias("_hi"), F.max("copies_group").alias("_rows")
    )
    mixed = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
        F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_p") - first)
    )
    entries = F.sort_array(F.collect_list(F.struct("i", mixed.alias("q"))))
    out = picked.groupBy(*by).agg(entries.alias("_e"), F.max("_rows").alias("_rows"))
    strange = F.raise_error(F.lit(OTHER_ROWS)).cast("array<double>")
    whole = ~F.exists("_e", lambda e: e["q"].isNull()) & (F.size("_e") == len(probs))
    checked = F.when(F.col("_rows") != n, strange).when(whole, F.col("_e.q"))
    return brackets.select(*by, "n").join(out, by, "left").select(*by, "n", checked.alias("quantiles"))


def window_quantiles(
    df: DataFrame,
    sketches: DataFrame,
    windows: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    interpolate: bool = False,
    margin: float = MARGIN,
    slice_rows: int = 100_000,
) -> DataFrame:
    """Exact (window, feature, n, quantiles) of several windows of months from their stored sketches.

    The smallest value that has at least the wanted share of the rows or, with ``interpolate``, the linear mean of the two
    values around the rank. ``sketches`` must be those of ``df``; a window's rows that its sketches do not count are an
    error.
    """
    brackets = stored(_brackets(merged_sketches(sketches, windows), probs, margin), "sketch-brackets")
    numbers = df.select(MONTH, *[_number(c).alias(c) for c in cols]).unpivot([MONTH], list(cols), "feature", "value")
    rows = (
        numbers.where(F.col("value").isNotNull())
        .join(F.broadcast(windows), F.col(MONTH).between(F.col("lo"), F.col("hi")))
        .select("window", "feature", "value")
    )
    done = stored(_found(rows, brackets, probs, interpolate, slice_rows), "sketch-quantiles")
    missed = done.where(F.col("quantiles").isNull())
    if missed.isEmpty():
        return done
    # The whole range leaves no gap, so the second search ends it.
    ends = [F.array(*[F.col(c)] * len(probs)).alias(a) for c, a in (("low", "_los"), ("high", "_his"))]
    whole = brackets.join(missed.select("window", "feature"), ["window", "feature"], "left_semi").select(
        "window", "feature", "n", "low", "high", *ends
    )
    again = _found(rows, whole, probs, interpolate, slice_rows)
    complete = F.coalesce("quantiles", F.raise_error(F.lit(OTHER_ROWS)).cast("array<double>"))
    return done.where(F.col("quantiles").isNotNull()).unionByName(again.withColumn("quantiles", complete))


def window_distinct(sketches: DataFrame, windows: DataFrame) -> DataFrame:
    """(window, feature, distinct_values) of each window of months, from the stored sketches alone."""
    held = sketches.join(F.broadcast(windows), F.col(MONTH).between(F.col("lo"), F.col("hi")))
    return held.groupBy("window", "feature").agg(
        F.theta_sketch_estimate(F.theta_union_agg("sketch", F.lit(THETA_LOG))).alias("distinct_values")
    )


def month_turnover(sketches: DataFrame) -> DataFrame:
    """(snapshot_date, feature, distinct_values, gained, lost, kept) against the month before that has a sketch.

    The first month gains all its values.
    """
    # One row per month and feature.
    earlier = F.lag("sketch").over(Window.partitionBy("feature").orderBy(MONTH))
    rows = sketches.select(MONTH, "feature", "sketch", earlier.alias("before"))
    size = lambda s: F.theta_sketch_estimate(s)
    now, before = F.col("sketch"), F.col("before")
    return rows.select(
        MONTH,
        "feature",
        size(now).alias("distinct_values"),
        F.coalesce(size(F.theta_difference(now, before)), size(now)).alias("gained"),
        F.coalesce(size(F.theta_difference(before, now)), F.lit(0)).cast("bigint").alias("lost"),
        F.coalesce(size(F.theta_intersection(now, before)), F.lit(0)).cast("bigint").alias("kept"),
    )
