"""Population stability in its five definitions, for all features and months at once.

Columns are unpivoted, so the number of jobs does not grow with features or months. Each
side of a comparison becomes one row with an array of bin counts (see functions.psi).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import psi as X
from riskloom.functions.months import as_date
from riskloom.operators.cleaning import harmonise_score_name, strip_column_names
from riskloom.operators.frequent import frequent_values
from riskloom.operators.profile import classify_columns, score_stats
from riskloom.operators.ranks import exact_percentiles, exact_quantiles, long_numeric
from riskloom.session import stored
from riskloom.sources.tables import MONTH

# Bins, categories kept, pooled tokens, and the monitored key columns.
BINS = 10
TOP_CATEGORIES = 50
NULL_TOKEN = "__NULL__"
OTHER_TOKEN = "__OTHER__"
KEY_COLUMNS = ["score", "util_rate", "dti", "age"]
SCORE_NAMES = ["prediction", "model_predictions", "score"]

INFINITY = float("inf")


def _tenths(bins: int) -> list[float]:
    """0, 1/bins, ... 1 as the same doubles an evenly spaced grid has."""
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def _nan_to_null(c: str) -> Column:
    return F.nullif(F.col(c).try_cast("double"), F.lit(float("nan")))


# --- quantile edges and bin shares -------------------------------------------------------


def psi_edges_quantile(
    df: DataFrame, cols: Sequence[str], bins: int = BINS, accuracy: int | None = None
) -> DataFrame:
    """(feature, edges): inner quantiles with infinite ends, duplicates kept; stored, so that all uses see the same.

    Exact by default. With ``accuracy`` a bounded sketch per column whose rank error is at most ``1 / accuracy``.
    """
    probs = [i / bins for i in range(1, bins)]
    rows = long_numeric(df, cols)
    if accuracy is None:
        found = exact_percentiles(rows, ["feature"], "value", probs)
    else:
        found = rows.groupBy("feature").agg(F.percentile_approx("value", probs, accuracy).alias("quantiles"))
    empty = rows.select("feature").distinct().select("feature", F.lit(None).cast("array<double>").alias("_none"))
    found = empty.join(found, "feature", "left").select("feature", "quantiles")
    ends = F.concat(F.array(F.lit(-INFINITY)), F.col("quantiles"), F.array(F.lit(INFINITY)))
    return stored(found.select("feature", ends.alias("edges")), "edges")


def bin_frequency(df: DataFrame, cols: Sequence[str], edges: DataFrame, bins: int = BINS) -> DataFrame:
    """(feature, bin_id, n, share) per non-empty bin; shares are over all rows, so null
    rows lower their sum. One pass for all columns."""
    counted = _feature_counts(df, cols, edges, bins)
    return (
        counted.select("feature", "all_rows", F.posexplode("counts").alias("bin_id", "n"))
        .where(F.col("n") > 0)
        .select("feature", "bin_id", "n", (F.col("n") / F.col("all_rows")).alias("share"))
    )


def _feature_counts(
    df: DataFrame, cols: Sequence[str], edges: DataFrame, bins: int, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., feature, counts, all_rows) with (lo, hi] bins."""
    rows = long_numeric(df, cols, by)
    # One edge list per column: bounded by the number of columns.
    return (
        rows.join(F.broadcast(edges.select("feature", "edges")), "feature")
        .groupBy(*by, "feature")
        .agg(
            X.count_bins("value", "edges", bins, "right").alias("counts"),
            F.count("*").alias("all_rows"),
        )
    )


def top_k_categories(
    df: DataFrame, cols: Sequence[str], k: int = TOP_CATEGORIES, buckets: int | None = None
) -> DataFrame:
    """(feature, category, n, share): the k most frequent values per column, the rest pooled.

    Null counts as its own category. Equal frequencies are ordered by value. All distinct values are counted in one pass;
    with ``buckets`` only those that may be frequent are, in two or three passes (see ``operators/frequent.py``), for
    columns with about as many values as rows. The result is the same.
    """
    if buckets is None:
        counts = _category_counts(df, cols)
        order = Window.partitionBy("feature").orderBy(F.col("n").desc(), "category")
        kept = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
        kept = kept.select("feature", "category", "n")
        rows = counts.groupBy("feature").agg(F.sum("n").alias("all_rows"))
    else:
        found = stored(frequent_values(_categories(df, cols), k, buckets), "top")
        kept = found.select("feature", "category", "n")
        rows = found.groupBy("feature").agg(F.max("all_rows").alias("all_rows"))
    pooled = (
        rows.join(kept.groupBy("feature").agg(F.sum("n").alias("kept")), "feature")
        .where(F.col("all_rows") > F.col("kept"))
        .select("feature", F.lit(OTHER_TOKEN).alias("category"), (F.col("all_rows") - F.col("kept")).alias("n"))
    )
    return (
        kept.unionAll(pooled)
        .join(rows, "feature")
        .select("feature", "category", "n", (F.col("n") / F.col("all_rows")).alias("share"))
    )


def _categories(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    text = df.select(*by, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)).alias(c) for c in cols])
    return text.unpivot(list(by), list(cols), "feature", "category")


def _category_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return _categories(df, cols, by).groupBy(*by, "feature", "category").agg(F.count("*").alias("n"))


# --- feature baseline and feature PSI (definitions A and B) ------------------------------


def psi_baseline(
    df: DataFrame,
    model_name: str,
    snapshot: str | date,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    bins: int = BINS,
    accuracy: int | None = None,
    k: int = TOP_CATEGORIES,
) -> DataFrame:
    """Long baseline table: one row per numeric bin or kept category with its share.

    Edges and shares of a feature come from one row, so they always fit each other.
    """
    kinds = classify_columns(df, drop)
    numeric = kinds["numeric"] if numeric is None else list(numeric)
    categorical = kinds["categorical"] if categorical is None else list(categorical)
    head = [F.lit(model_name).alias("model_name"), as_date(snapshot).alias("baseline_snapshot"), "feature"]
    parts = []
    if numeric:
        edges = psi_edges_quantile(df, numeric, bins, accuracy)
        counted = _feature_counts(df, numeric, edges, bins).join(edges, "feature")
        share = X.shares(F.col("counts"), F.col("all_rows"))
        bin_rows = counted.select("feature", "edges", F.posexplode(share).alias("bin_id", "p_ref"))
        parts.append(
            bin_rows.select(
                *head,
                F.lit("numeric").alias("value_type"),
                "bin_id",
                F.get("edges", F.col("bin_id")).alias("lo"),
                F.get("edges", F.col("bin_id") + 1).alias("hi"),
                F.lit(None).cast("string").alias("category"),
                "p_ref",
            )
        )
    if categorical:
        parts.append(
            top_k_categories(df, categorical, k).select(
                *head,
                F.lit("categorical").alias("value_type"),
                F.lit(None).cast("int").alias("bin_id"),
                F.lit(None).cast("double").alias("lo"),
                F.lit(None).cast("double").alias("hi"),
                "category",
                F.col("share").alias("p_ref"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _baseline_arrays(baseline: DataFrame) -> DataFrame:
    """(feature, edges, p_ref) from the numeric rows of a baseline table."""
    ordered = F.sort_array(F.collect_list(F.struct("bin_id", "lo", "hi", "p_ref")))
    rows = baseline.where(F.col("value_type") == "numeric").groupBy("feature").agg(ordered.alias("b"))
    edges = F.concat(F.col("b.lo"), F.array(F.element_at(F.col("b.hi"), -1)))
    return rows.select("feature", edges.alias("edges"), F.col("b.p_ref").alias("p_ref"))


def psi_numeric(
    cur: DataFrame, baseline: DataFrame, cols: Sequence[str], by: Sequence[str] = (), bins: int = BINS
) -> DataFrame:
    """Definition A: (lo, hi] bins, shares over all rows, both shares floored at 1e-12."""
    reference = _baseline_arrays(baseline)
    counted = _feature_counts(cur, cols, reference, bins, by)
    share = X.shares(F.col("counts"), F.col("all_rows"))
    one = lambda c, r: X.term(X.floored(c, X.FLOOR_FEATURE), X.floored(r, X.FLOOR_FEATURE))
    return counted.join(F.broadcast(reference.select("feature", "p_ref")), "feature").select(
        *by, "feature", X.index(F.col("p_ref"), share, one).alias("psi")
    )


def psi_categorical(
    cur: DataFrame, baseline: DataFrame, cols: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Definition B: categories of the baseline only; values unknown to it are pooled, and
    the pool counts only where the baseline has one. Both shares are floored at 1e-12."""
    # At most k + 1 categories per column.
    known = F.broadcast(
        baseline.where(F.col("value_type") == "categorical").select(
            "feature", "category", "p_ref", F.lit(True).alias("_known")
        )
    )
    counts = _category_counts(cur, cols, by)
    named = counts.join(known, ["feature", "category"], "left")
    pooled = (
        named.withColumn("category", F.when(F.col("_known"), F.col("category")).otherwise(OTHER_TOKEN))
        .groupBy(*by, "feature", "category")
        .agg(F.sum("n").alias("n"))
    )
    # One row per category now; a group is a list of at most k + 1 of them.
    cells = pooled.groupBy(*by, "feature").agg(
        F.sum("n").alias("all_rows"),
        F.map_from_entries(F.collect_list(F.struct("category", "n"))).alias("counts"),
    )
    reference = (
        baseline.where(F.col("value_type") == "categorical")
        .groupBy("feature")
        .agg(F.sort_array(F.collect_list(F.struct("category", "p_ref"))).alias("ref"))
    )
    share = F.transform(
        "ref",
        lambda r: F.coalesce(F.try_element_at("counts", r["category"]), F.lit(0)) / F.col("all_rows"),
    )
    one = lambda c, r: X.term(X.floored(c, X.FLOOR_FEATURE), X.floored(r, X.FLOOR_FEATURE))
    return cells.join(F.broadcast(reference), "feature").select(
        *by, "feature", X.index(F.col("ref.p_ref"), share, one).alias("psi")
    )


def feature_psi(
    cur: DataFrame,
    baseline: DataFrame,
    model_name: str,
    baseline_snapshot: str | date,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    month: str = MONTH,
    bins: int = BINS,
) -> DataFrame:
    """Graded PSI rows of every baseline feature present in ``cur``, for all its months.

    Without lists the features and their kinds are those of the baseline table.
    """
    if numeric is None or categorical is None:
        # One row per monitored feature.
        kinds = baseline.select("feature", "value_type").distinct().collect()
        of = lambda kind: sorted(r["feature"] for r in kinds if r["value_type"] == kind)
        numeric = of("numeric") if numeric is None else numeric
        categorical = of("categorical") if categorical is None else categorical
    parts = []
    for kind, cols, one in (("numeric", numeric, psi_numeric), ("categorical", categorical, psi_categorical)):
        present = [c for c in cols if c in cur.columns]
        if present:
            options = {"bins": bins} if kind == "numeric" else {}
            rows = one(cur, baseline, present, [month], **options)
            parts.append(rows.withColumn("value_type", F.lit(kind)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        F.lit(model_name).alias("model_name"),
        F.date_format(as_date(baseline_snapshot), "yyyy-MM-dd").alias("baseline_snapshot"),
        F.date_format(month, "yyyy-MM-dd").alias("current_snapshot"),
        "feature",
        "value_type",
        "psi",
        X.grade(F.col("psi")).alias("psi_grade"),
    )


# --- score PSI on exact quantile bins (definitions C and D) -------------------------------


def _quantile_comparison(
    base: DataFrame, cur: DataFrame, cols: Sequence[str], by: Sequence[str], bins: int, closed: str
) -> DataFrame:
    """(by..., feature, edges, ref_counts, cur_counts, nulls) on the baseline's exact quantiles."""
    base_rows = long_numeric(base, cols)
    edges = exact_quantiles(base_rows, ["feature"], "value", _tenths(bins)).select(
        "feature", F.array_distinct("quantiles").alias("edges")
    )
    edges = stored(edges, "edges")
    # One edge list per compared column: bounded by the number of columns.
    small = F.broadcast(edges)

    def counted(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        return (
            rows.join(small, "feature")
            .groupBy(*keys, "feature")
            .agg(
                X.count_bins("value", "edges", bins, closed).alias(f"{name}_counts"),
                F.count_if(F.col("value").isNull()).alias(f"{name}_nulls"),
            )
        )

    reference = counted(base_rows, [], "ref").join(small, "feature")
    return counted(long_numeric(cur, cols, by), by, "cur").join(F.broadcast(reference), "feature")


def psi_prediction(
    base: DataFrame,
    cur: DataFrame,
    cols: Sequence[str] = ("prediction",),
    by: Sequence[str] = (),
    bins: int = BINS,
    empty: str = "inf",
) -> DataFrame:
    """Definition C: exact deciles without duplicates, (lo, hi] with the lowest included,
    rows outside or null left out of the shares.

    A bin that is empty on one side makes the index infinite (``empty='inf'``); with
    ``empty='floor'`` such a share becomes 1e-5. A constant baseline has no bins
    and the index 0. Without any current row in range, all its shares are 1e-5.
    """
    compared = _quantile_comparison(base, cur, cols, by, bins, "lowest")
    used = F.size("edges") - 1

    def share(counts: Column) -> Column:
        inside = F.slice(counts, 1, F.greatest(used, F.lit(0)))
        rows = X.total(counts)
        missing = F.lit(X.MISSING_PREDICTION_SHARE)
        part = F.transform(inside, lambda n: F.coalesce(F.try_divide(n, rows), missing))
        if empty == "inf":
            return part
        return F.transform(part, lambda p: F.when(p == 0, missing).otherwise(p))

    one = X.term_or_infinity if empty == "inf" else X.term
    value = X.index(share(F.col("ref_counts")), share(F.col("cur_counts")), one)
    return compared.select(*by, "feature", value.alias("psi"))


def psi_scheduled(
    base: DataFrame,
    cur: DataFrame,
    cols: Sequence[str] = ("prediction",),
    by: Sequence[str] = (),
    bins: int = BINS,
) -> DataFrame:
    """Definition D: exact deciles including both ends, duplicates dropped, [lo, hi) with
    the last bin closed, rows outside dropped, 1e-9 added to the total and to each share.

    A feature with nulls in the baseline has no index and no row; a constant baseline has
    no bins and the index 0.
    """
    compared = _quantile_comparison(base, cur, cols, by, bins, "left")
    used = F.greatest(F.size("edges") - 1, F.lit(0))

    def share(counts: Column) -> Column:
        rows = X.total(counts) + F.lit(X.ADDED_SCHEDULED)
        inside = F.slice(counts, 1, used)
        return F.transform(inside, lambda n: n / rows + F.lit(X.ADDED_SCHEDULED))

    value = X.index(share(F.col("ref_counts")), share(F.col("cur_counts")))
    return compared.where(F.col("ref_nulls") == 0).select(*by, "feature", value.alias("psi"))


# --- score PSI on equal-width bins (definition E) -----------------------------------------


def equal_width_edges(lo: Column, hi: Column, bins: int = BINS) -> Column:
    step = (hi - lo) / bins
    inner = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: i * step + lo)
    return F.concat(inner, F.array(hi))


def _equal_width_share(counts: Column) -> Column:
    rows = X.total(counts)
    return F.transform(
        counts, lambda n: F.when(n == 0, F.lit(X.FLOOR_EQUAL_WIDTH)).otherwise(n / rows)
    )


def _equal_width_index(ref: Column, cur: Column) -> Column:
    value = X.index(_equal_width_share(ref), _equal_width_share(cur))
    return F.when((X.total(ref) > 0) & (X.total(cur) > 0), value)


def psi_equal_width(
    base: DataFrame, cur: DataFrame, cols: Sequence[str] = ("prediction",), bins: int = BINS
) -> DataFrame:
    """Definition E: equal-width bins over the joint range, nulls dropped, empty shares 1e-6.

    Null when either side has no values.
    """
    rows = long_numeric(base, cols).withColumn("_base", F.lit(True)).unionAll(
        long_numeric(cur, cols).withColumn("_base", F.lit(False))
    )
    span = rows.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    # One range per compared column: bounded by the number of columns.
    edges = F.broadcast(
        span.select("feature", equal_width_edges(F.col("lo"), F.col("hi"), bins).alias("edges"))
    )
    sides = rows.join(edges, "feature").withColumns(
        {
            "ref_value": F.when(F.col("_base"), F.col("value")),
            "cur_value": F.when(~F.col("_base"), F.col("value")),
        }
    )
    counted = sides.groupBy("feature").agg(
        X.count_bins("ref_value", "edges", bins, "equal").alias("ref"),
        X.count_bins("cur_value", "edges", bins, "equal").alias("cur"),
    )
    return counted.select("feature", _equal_width_index(F.col("ref"), F.col("cur")).alias("psi"))


def psi_trend(
    base: DataFrame,
    cur: DataFrame,
    base_col: str = "prediction",
    cur_col: str = "model_predictions",
    month: str = MONTH,
    bins: int = BINS,
) -> DataFrame:
    """Definition E of every month against one baseline, with level, count, mean and std.

    Each month has its own joint range and therefore its own edges. The baseline is read
    once: its rows are counted between the sorted edges of all months, and a month's bins
    are differences of those counts. What is kept per month is 11 edges.
    """
    scores = cur.select(month, _nan_to_null(cur_col).alias("v")).where(F.col("v").isNotNull())
    reference = base.select(_nan_to_null(base_col).alias("v")).where(F.col("v").isNotNull())
    ends = reference.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    ranges = scores.groupBy(month).agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    joint = ranges.select(
        month,
        F.least("_lo", ends.getField("lo")).alias("lo"),
        F.greatest("_hi", ends.getField("hi")).alias("hi"),
    )
    edges = joint.select(month, equal_width_edges(F.col("lo"), F.col("hi"), bins).alias("edges"))
    points = edges.select(month, F.posexplode("edges").alias("i", "e"))
    grid = points.agg(F.sort_array(F.collect_set("e")).alias("grid")).scalar()
    # Baseline rows per largest edge that is not above them; rows below all edges drop out
    # here and come back through the total.
    cells = (
        reference.select(grid.alias("grid"), "v")
        .select(F.array_max(F.filter("grid", lambda e: e <= F.col("v"))).alias("e"))
        .groupBy("e")
        .agg(F.count("*").alias("n"))
    )
    # One row per distinct edge (at most 11 per month), so this ordering is small.
    marks = points.select("e", F.lit(0).cast("bigint").alias("n")).distinct().unionAll(cells)
    smaller = Window.orderBy(F.col("e").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ladder = (
        marks.groupBy("e")
        .agg(F.sum("n").alias("n"))
        .select("e", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("below"))
    )
    all_rows = reference.agg(F.count("*")).scalar()
    cuts = points.join(ladder, "e").groupBy(month).agg(
        F.sort_array(F.collect_list(F.struct("i", "below"))).alias("cuts"),
        F.sort_array(F.collect_list(F.struct("i", "e"))).alias("points"),
    )
    starts = F.slice("cuts", 1, bins)["below"]
    ends_at = F.concat(F.slice("cuts", 2, bins - 1)["below"], F.array(F.col("all_rows")))
    # One row per month on this side.
    per_month = F.broadcast(
        cuts.withColumn("all_rows", all_rows).select(
            month,
            F.col("points.e").alias("edges"),
            F.zip_with(ends_at, starts, lambda hi, lo: hi - lo).alias("ref"),
        )
    )
    counted = (
        scores.join(per_month, month)
        .groupBy(month, "edges", "ref")
        .agg(
            X.count_bins("v", "edges", bins, "equal").alias("cur"),
            F.count("v").alias("count"),
            F.avg("v").alias("mean"),
            F.stddev_pop("v").alias("std"),
        )
    )
    index = _equal_width_index(F.col("ref"), F.col("cur")).alias("psi")
    return counted.select(month, index, "count", "mean", "std").withColumn(
        "status", X.alert_level(F.col("psi"))
    )


# --- records built on the indices ---------------------------------------------------------


def prediction_drift(
    base: DataFrame,
    cur: DataFrame,
    model_name: str,
    base_col: str = "prediction",
    cur_col: str = "model_predictions",
    by: Sequence[str] = (),
    empty: str = "inf",
) -> DataFrame:
    """Definition C with the score statistics of both sides and the alert level."""
    renamed = harmonise_score_name(cur, cur_col, base_col)
    index = psi_prediction(base, renamed, [base_col], by, empty=empty)
    names = ["mean", "std", "min", "max", "count"]
    now = score_stats(long_numeric(renamed, [base_col], by), "value", [*by, "feature"])
    now = now.select(*by, "feature", *[F.col(n).alias(f"current_{n}") for n in names])
    then = score_stats(base, base_col).select(F.struct(*names)).scalar()
    return index.join(now, [*by, "feature"]).select(
        F.lit(model_name).alias("model_name"),
        *by,
        "psi",
        X.alert_level(F.col("psi")).alias("alert_level"),
        *[then.getField(n).alias(f"baseline_{n}") for n in names],
        *[f"current_{n}" for n in names],
    )


def monitored_columns(base: DataFrame, cur: DataFrame, at_most: int | None = None) -> list[str]:
    """Key columns present on both sides, else the common numeric columns by name, ``at_most`` that many."""
    keys = [c for c in KEY_COLUMNS if c in base.columns and c in cur.columns]
    if keys:
        return keys
    kinds = [set(_numeric_names(df)) for df in (base, cur)]
    return sorted(kinds[0] & kinds[1])[:at_most]


def with_score_name(df: DataFrame) -> DataFrame:
    """Trimmed column names, and the score under the name ``prediction``."""
    out = strip_column_names(df)
    for name in SCORE_NAMES[1:]:
        out = harmonise_score_name(out, name)
    return out


def _numeric_names(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind in NUMERIC_KINDS or kind.startswith("decimal")]


NUMERIC_KINDS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def monthly_psi(
    base: DataFrame,
    predictions: DataFrame,
    months: DataFrame,
    baseline_from: str | date | None = None,
    cols: Sequence[str] | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Payload of every month in ``months``: definition D per column, the largest as overall.

    Column names are trimmed on both sides, and where no key column is common the scores are compared under the name
    ``prediction``. ``baseline_from`` is the first month that has a baseline. Months before it and months without
    predictions get a status row without an index, months in which no column can be compared the status ``NO_COLUMNS``.
    A column that cannot be compared in a month is left out of it.
    """
    base, predictions = strip_column_names(base), strip_column_names(predictions)
    if cols is None and not any(c in base.columns and c in predictions.columns for c in KEY_COLUMNS):
        base, predictions = with_score_name(base), with_score_name(predictions)
    cols = list(cols) if cols is not None else monitored_columns(base, predictions, at_most)
    cols = [c for c in cols if c in base.columns and c in predictions.columns]
    empty = predictions.limit(0).select(MONTH, F.lit("").alias("feature"), F.lit(0.0).alias("psi"))
    index = psi_scheduled(base, predictions, cols, [MONTH]) if cols else empty
    # One entry per monitored column and month.
    details = index.where(F.col("psi").isNotNull()).groupBy(MONTH).agg(
        F.max(F.nullif("psi", F.lit(float("nan")))).alias("overall"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", "psi")))).alias("psi"),
    )
    seen = predictions.select(MONTH, F.lit(True).alias("_seen")).distinct()
    has_base = F.lit(True) if baseline_from is None else F.col(MONTH) >= as_date(baseline_from)
    status = (
        F.when(~has_base, "SKIPPED_NO_BASELINE")
        .when(F.col("_seen").isNull(), "SKIPPED_NO_PREDICTION")
        .when(F.col("psi").isNull(), "NO_COLUMNS")
        .otherwise("OK")
    )
    rows = months.join(seen, MONTH, "left").join(details, MONTH, "left").withColumn("status", status)
    ok = F.col("status") == "OK"
    return rows.select(
        F.date_format(MONTH, "yyyy-MM").alias("month"),
        F.when(ok, F.col("overall")).alias("overall"),
        F.when(ok, F.col("psi")).alias("psi"),
        "status",
    )


def generic_column_psi(base: DataFrame, cur: DataFrame, key: str = "Customer_ID") -> DataFrame:
    """PSI of every common column but the key: equal width for numbers, categories otherwise."""
    common = [c for c in base.columns if c in cur.columns and c != key]
    numeric = [c for c in common if c in _numeric_names(base)]
    other = [c for c in common if c not in numeric]
    parts = []
    if numeric:
        parts.append(psi_equal_width(base, cur, numeric).withColumn("type", F.lit("numeric")))
    if other:
        reference = top_k_categories(base, other).select(
            "feature",
            F.lit("categorical").alias("value_type"),
            "category",
            F.col("share").alias("p_ref"),
        )
        parts.append(psi_categorical(cur, reference, other).withColumn("type", F.lit("categorical")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("status", X.alert_level(F.col("psi")))


def aligned_shares(base: DataFrame, cur: DataFrame, bin_col: str, missing: float) -> DataFrame:
    """Full outer join of two binned samples' shares; a bin absent on one side gets ``missing``."""

    def share(df: DataFrame, name: str) -> DataFrame:
        counts = df.where(F.col(bin_col).isNotNull()).groupBy(bin_col).agg(F.count("*").alias("n"))
        all_rows = counts.agg(F.sum("n")).scalar()
        return counts.select(bin_col, (F.col("n") / all_rows).alias(name))

    joined = share(base, "expected").join(share(cur, "actual"), bin_col, "full")
    return joined.select(
        bin_col,
        F.coalesce("expected", F.lit(missing)).alias("expected"),
        F.coalesce("actual", F.lit(missing)).alias("actual"),
    )


def category_lookup(base: DataFrame, cur: DataFrame, col: str, k: int = TOP_CATEGORIES) -> DataFrame:
    """Every baseline category with its share in both samples; current-only values pooled."""
    reference = top_k_categories(base, [col], k).select("category", F.col("share").alias("p_ref"))
    counts = _category_counts(cur, [col]).select("category", "n")
    all_rows = counts.agg(F.sum("n")).scalar()
    # At most k + 1 baseline categories.
    known = F.broadcast(reference.select(F.col("category").alias("known")))
    named = counts.join(known, F.col("category") == F.col("known"), "left")
    pooled = named.groupBy(F.coalesce("known", F.lit(OTHER_TOKEN)).alias("category")).agg(
        F.sum("n").alias("n")
    )
    return reference.join(pooled, "category", "left").select(
        "category", "p_ref", (F.coalesce("n", F.lit(0)) / all_rows).alias("p_cur")
    )
