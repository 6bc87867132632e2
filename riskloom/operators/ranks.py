"""Order statistics over whole columns without a single-task sort.

Quantiles: a bounded sketch brackets each wanted rank, a second pass counts the rows below and inside each bracket. Only
rows inside a bracket are ever shuffled, one per distinct value; where a bracket has more rows than one task should
order, its values are dealt to ranges of values and totalled range by range, in a fixed number of passes however they are
distributed.

Ranks of every value: rows collapse to one per distinct value with a row count, so a value that holds a third of all rows
is one row here. Those rows are dealt to ranges of values, as many as their number asks for, summed per range, and ordered
inside a range only.

What later steps rely on (brackets, ranges) is written to the shared folder once, so all of them see the same boundaries
whatever is recomputed. A null group is a group like others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import stored

ROWS_PER_SLICE = 100_000
# Rank error of the sketch is 1 / ACCURACY; a bracket is MARGIN wide on either side.
ACCURACY = 10_000
MARGIN = 4 / ACCURACY
# Where the margin is less than one row a bracket is the whole range of its group.
SMALL_GROUP = int(1 / MARGIN)
# Rows of a bracket whose values one task orders.
BRACKET_VALUES = 200_000
# Columns with up to so many distinct values get their ranks by broadcast, others by shuffle.
LOOKUP_VALUES = 10_000
# Groups with brackets are broadcast up to this many, else joined by shuffle.
BROADCAST_GROUPS = 20_000


def _same(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe join on ``by``, whose columns are kept once; without them, with the one row of ``right``."""
    names = {c: f"_by_{i}" for i, c in enumerate(by)}
    right = right.withColumnsRenamed(names)
    on = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()] or [F.lit(True)]
    return left.join(right, on, how).drop(*names.values())


def _sent(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_GROUPS else table


def value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row per group and distinct value with ``n`` rows; nulls are left out."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))


def rank_candidates(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    small: int = SMALL_GROUP,
    values: int = BRACKET_VALUES,
) -> DataFrame:
    """Rows that can hold the ranks around ``probs``: (by..., i, value, copies, before, n).

    ``i`` is the position in ``probs``, ``copies`` the rows with that value, ``before`` the
    rows of the group with a smaller value and ``n`` the rows of the group.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    ends = [(max(p - MARGIN, 0.0), min(p + MARGIN, 1.0)) for p in probs]
    inner = sorted({p for pair in ends for p in pair})
    sketch = rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", inner, ACCURACY).alias("_s"),
    )
    # Positions of the bracket ends in the sketch; an end at 0 or 1 is the smallest or
    # largest value, and so are both ends of a small group.
    places = range(len(probs))

    def bounds(side: int, end: str) -> Column:
        picks = [
            "_min" if pair[side] == 0.0 else "_max" if pair[side] == 1.0
            else f"if(n <= {small}, {end}, _s[{inner.index(pair[side])}])"
            for pair in ends
        ]
        return F.expr(f"array({', '.join(picks)})")

    brackets = sketch.select(*by, "n", bounds(0, "_min").alias("_los"), bounds(1, "_max").alias("_his"))
    known = _counted(rows, stored(brackets, "brackets"), by, len(probs))
    # Nearly all rows lie outside every bracket; this compiled test drops them first.
    near = F.expr(" OR ".join(f"_v BETWEEN _los[{i}] AND _his[{i}]" for i in places))
    inside = F.filter(
        F.lit(list(places)),
        lambda i: (F.col("_v") >= F.get("_los", i)) & (F.col("_v") <= F.get("_his", i)),
    )
    held = _same(rows, _sent(known), by).where(near).select(
        *by, "_v", "n", "_below", F.explode(inside).alias("i")
    )
    counted = held.groupBy(*by, "i", "_v", "n", F.get("_below", "i").alias("_start")).agg(
        F.count("*").alias("copies")
    )
    if known.where(F.array_max("_inside") > values).isEmpty():
        earlier = Window.partitionBy(*by, "i").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
        placed = counted.withColumn("copies_before", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
    else:
        placed = running_totals(counted, [*by, "i"], "_v", ["copies"], values)
    before = F.col("_start") + F.col("copies_before")
    return placed.select(*by, "i", F.col("_v").alias(value), "copies", before.alias("before"), "n")


def _counted(rows: DataFrame, brackets: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """Brackets with the rows below and inside each; stored."""
    below = F.expr(f"array({', '.join(f'count_if(_v < _los[{i}])' for i in range(n))})")
    own = [f"_v BETWEEN _los[{i}] AND _his[{i}]" for i in range(n)]
    inside = F.expr(f"array({', '.join(f'count_if({x})' for x in own)})")
    counts = _same(rows, _sent(brackets), by).groupBy(*by, "n", "_los", "_his").agg(
        below.alias("_below"), inside.alias("_inside")
    )
    return stored(counts, "brackets")


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    small: int = SMALL_GROUP,
    values: int = BRACKET_VALUES,
) -> DataFrame:
    """Exact linearly interpolated quantiles: one row per group with ``quantiles`` (array
    in the order of ``probs``) and ``n`` (non-null rows)."""
    by = list(by)
    position = F.get(F.lit(list(probs)), F.col("i")) * (F.col("n") - 1)
    placed = rank_candidates(df, by, value, probs, small, values).withColumn("_p", position)
    past = F.col("before") + F.col("copies")

    def at(rank: Column) -> Column:
        """Value at a rank; a rank that no candidate covers is an error."""
        held = (rank >= F.col("before")) & (rank < past)
        found = F.max(F.when(held, F.col(value).cast("double")))
        return F.coalesce(found, F.raise_error(F.lit("rank outside its bracket")).cast("double"))

    ends = placed.groupBy(*by, "n", "i", "_p").agg(
        at(F.floor("_p")).alias("_lo"), at(F.ceil("_p")).alias("_hi")
    )
    mixed = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_p") - F.floor("_p"))
    # One entry per wanted quantile.
    ordered = F.sort_array(F.collect_list(F.struct("i", mixed.alias("q"))))
    return ends.groupBy(*by, "n").agg(ordered.alias("_o")).select(*by, F.col("_o.q").alias("quantiles"), "n")


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], **options) -> DataFrame:
    """(by..., quantiles): for each probability the smallest value that has at least that share of the rows."""
    by = list(by)
    placed = rank_candidates(df, by, value, probs, **options)
    wanted = F.greatest(F.ceil(F.round(F.get(F.lit(list(probs)), F.col("i")) * F.col("n"), 6)), F.lit(1))
    own = placed.where((F.col("before") < wanted) & (wanted <= F.col("before") + F.col("copies")))
    ordered = F.sort_array(F.collect_list(F.struct("i", F.col(value).alias("q"))))
    found = own.groupBy(*by).agg(ordered.alias("_o"))
    complete = F.when(F.size("_o") == len(probs), F.col("_o.q"))
    return found.select(*by, F.coalesce(complete, F.raise_error(F.lit("rank outside its bracket"))).alias("quantiles"))


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``<s>_before`` (total over smaller values of ``order``) and ``<s>_group`` (total
    over the group) for each column in ``sums``. ``df`` holds one row per (by, order)."""
    by = list(by)
    cells = stored(df, "cells")
    slices = max(1, math.ceil(cells.count() / rows_per_slice))
    ranged = cells.repartitionByRange(slices, *by, order).withColumn("_slice", F.spark_partition_id())
    ranged = stored(ranged, "slices")
    # One row per group and slice.
    per_slice = ranged.groupBy(*by, "_slice").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select(
        *by,
        "_slice",
        *[F.coalesce(F.sum(f"_{s}").over(earlier), F.lit(0)).alias(f"_{s}_start") for s in sums],
        *[F.sum(f"_{s}").over(group).alias(f"{s}_group") for s in sums],
    )
    placed = _same(ranged, starts, [*by, "_slice"])
    inside = Window.partitionBy(*by, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = [
        (F.col(f"_{s}_start") + F.coalesce(F.sum(s).over(inside), F.lit(0))).alias(f"{s}_before")
        for s in sums
    ]
    return placed.select(*df.columns, *before, *[f"{s}_group" for s in sums])


def average_ranks(counts: DataFrame, by: Sequence[str], value: str, **options) -> DataFrame:
    """Rank of each distinct value, ties sharing their mean rank (1-based)."""
    ranked = running_totals(counts, by, value, ["n"], **options)
    return ranked.select(*by, value, (F.col("n_before") + (F.col("n") + 1) / 2).alias("rank"))


def long_numeric(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot columns to (keep..., feature, value double); NaN becomes null."""
    as_double = [
        F.nullif(F.col(c).try_cast("double"), F.lit(float("nan"))).alias(c) for c in cols
    ]
    return df.select(*keep, *as_double).unpivot(list(keep), list(cols), "feature", "value")


def auc(
    df: DataFrame, score: str, label: str, by: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Tie-aware ROC AUC and Gini per group; null when only one class is present.

    Rows collapse to distinct scores before anything is ordered.
    """
    by = list(by)
    cells = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, score)
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) != 1).alias("neg"),
        )
    )
    placed = running_totals(cells, by, score, ["neg"], rows_per_slice)
    # Positives ranked above negatives, counted in half pairs to stay exact.
    wins = F.sum(
        (F.col("pos") * (2 * F.col("neg_before") + F.col("neg"))).cast("decimal(38,0)")
    )
    out = placed.groupBy(*by).agg(
        wins.alias("_wins"), F.sum("pos").alias("positives"), F.max("neg_group").alias("negatives")
    )
    area = F.try_divide(
        F.col("_wins").cast("double"),
        F.col("positives").cast("double") * F.col("negatives").cast("double") * 2,
    )
    return out.select(*by, "positives", "negatives", area.alias("auc")).withColumn(
        "gini", F.round(F.col("auc") * 2 - 1, 4)
    )


def _presence_classes(rows: DataFrame, k: int) -> list[int]:
    """For each column ``c0``, ``c1``, ... the first one that is null in exactly the same rows."""
    nulls = rows.agg(F.lit(0), *[F.count_if(F.col(f"c{i}").isNull()).alias(f"n{i}") for i in range(k)]).first()
    # Only columns with equally many nulls can share them, and those without any do.
    pairs = [(i, j) for j in range(k) for i in range(j) if nulls[f"n{i}"] == nulls[f"n{j}"]]
    unsure = [(i, j) for i, j in pairs if nulls[f"n{i}"]]
    same = set(pairs)
    if unsure:
        differ = [F.expr(f"count_if((c{i} IS NULL) <> (c{j} IS NULL)) AS d{i}_{j}") for i, j in unsure]
        found = rows.agg(*differ).first()
        same -= {(i, j) for i, j in unsure if found[f"d{i}_{j}"]}
    return [next((i for i in range(j) if (i, j) in same), j) for j in range(k)]


def spearman(
    df: DataFrame, cols: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE, lookup_values: int = LOOKUP_VALUES
) -> DataFrame:
    """Rank correlation of every column pair (x before y in ``cols``), nulls dropped per pair.

    Each pair is ranked on the rows where both columns are present. A value's rank among them needs only the rows before
    it in which the partner is present, so every column is ordered once, with one running count for each class of partners
    that are null in the same rows. Rows are dealt once per column with more than ``lookup_values`` distinct values, not once
    per pair, to fetch their ranks, and come back together with their other values to be multiplied. The ranks of columns
    with fewer distinct values are broadcast.
    """
    k = len(cols)
    numbers = [F.nullif(F.col(c).try_cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(cols)]
    # The row number is stored, so that retries cannot number rows anew.
    rows = stored(df.select(*numbers).withColumn("_row", F.monotonically_increasing_id()), "rank-rows")
    first = _presence_classes(rows, k)
    classes = sorted(set(first))
    held = [F.col(f"c{p}").isNotNull().cast("bigint").alias(f"n{p}") for p in classes]
    # A column is unpivoted together with what is present beside it.
    entries = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v")) for i in range(k)])
    long = rows.select("_row", *held, F.inline(entries)).where(F.col("v").isNotNull())
    cells = long.groupBy("i", "v").agg(*[F.sum(f"n{p}").alias(f"n{p}") for p in classes])
    totals = running_totals(cells, ["i"], "v", [f"n{p}" for p in classes], rows_per_slice)
    ranks = [(F.col(f"n{p}_before") + (F.col(f"n{p}") + 1) / 2).alias(f"r{p}") for p in classes]
    ranked = stored(totals.select("i", "v", *[f"n{p}" for p in classes], *ranks), "ranks")

    # Sizes and spreads of both margins come from the distinct values alone.
    def margin(p: int) -> Column:
        n, r = F.col(f"n{p}").cast("double"), F.col(f"r{p}")
        return F.struct(F.lit(p).alias("p"), F.sum(n).alias("n"), F.sum(n * r * r).alias("sq"))

    margins = ranked.groupBy("i").agg(F.array(*[margin(p) for p in classes]).alias("m")).select("i", F.inline("m"))
    # One number per column.
    sizes = {r.i: r.n for r in ranked.groupBy("i").agg(F.count("*").alias("n")).collect()}
    few = [i for i in range(k) if sizes.get(i, 0) <= lookup_values]
    many = [i for i in range(k) if i not in few]
    # An array: as fields, the ranks of all columns would be too many for compiled code.
    entry = F.array(*[f"r{p}" for p in classes])
    at = {i: classes.index(first[i]) for i in range(k)}
    if many:
        # One entry per column with many values of a row, and one with all its other values.
        own = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v")) for i in many])
        asked = rows.select("_row", F.inline(own)).where(F.col("v").isNotNull())
        fetched = asked.join(ranked.select("i", "v", entry.alias("e")), ["i", "v"]).select(
            "_row", F.struct("i", "e").alias("e"), *[F.lit(None).cast("double").alias(f"c{i}") for i in few]
        )
        others = rows.select("_row", F.lit(None).cast(fetched.schema["e"].dataType).alias("e"), *[f"c{i}" for i in few])
        together = fetched.unionAll(others).groupBy("_row").agg(
            F.map_from_entries(F.collect_list("e")).alias("by"), *[F.max(f"c{i}").alias(f"c{i}") for i in few]
        )
        wide = together.select(
            *[f"c{i}" for i in few], *[F.try_element_at("by", F.lit(i)).alias(f"e{i}") for i in many]
        )
    else:
        wide = rows
    for i in few:
        looked = ranked.where(F.col("i") == i).select(F.col("v").alias(f"c{i}"), entry.alias(f"e{i}"))
        wide = wide.join(F.broadcast(looked), f"c{i}", "left")
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
    products = [F.expr(f"sum(get(e{i}, {at[j]}) * get(e{j}, {at[i]})) AS xy{i}_{j}") for i, j in pairs]
    listed = ", ".join(
        f"named_struct('i', {i}, 'j', {j}, 'pi', {first[i]}, 'pj', {first[j]}, 'xy', xy{i}_{j})" for i, j in pairs
    )
    sums = wide.agg(F.lit(0).alias("_"), *products).select(F.expr(f"inline(array({listed}))"))
    sums = sums.where(F.col("xy").isNotNull())
    # One row per pair on the left, one per column and class on the right.
    x = F.broadcast(margins.select(F.col("i"), F.col("p").alias("pj"), "n", F.col("sq").alias("xx")))
    y = F.broadcast(margins.select(F.col("i").alias("j"), F.col("p").alias("pi"), F.col("sq").alias("yy")))
    moments = sums.join(x, ["i", "pj"]).join(y, ["j", "pi"])
    # Mean rank is (n + 1) / 2 on both sides, whatever the ties.
    centre = F.col("n") * (F.col("n") + 1) * (F.col("n") + 1) / 4
    rho = F.try_divide(
        F.col("xy") - centre, F.sqrt((F.col("xx") - centre) * (F.col("yy") - centre))
    )
    x_name, y_name = (F.get(F.lit(list(cols)), F.col(c)).alias(f"{n}_name") for c, n in (("i", "x"), ("j", "y")))
    return moments.select(x_name, y_name, F.col("n").cast("bigint").alias("n"), rho.alias("rho"))
