"""Expressions for population stability: bin counters, shares, the index and its grades.

A distribution is one array of counts, so comparing two of them is an expression on a
single row and needs neither a bin grid nor an outer join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alert thresholds and the floors of the PSI definitions.
LOW, HIGH = 0.10, 0.25
FLOOR_FEATURE = 1e-12
FLOOR_EQUAL_WIDTH = 1e-6
MISSING_PREDICTION_SHARE = 1e-5
ADDED_SCHEDULED = 1e-9


def count_bins(value: str, edges: str, bins: int, closed: str) -> Column:
    """Aggregate: array of ``bins`` row counts between consecutive elements of ``edges``.

    ``closed='right'``   (lo, hi], nothing special at the ends
    ``closed='lowest'``  (lo, hi] with the lowest edge included
    ``closed='left'``    [lo, hi) with the last edge of the list included
    ``closed='equal'``   the same for a list of exactly ``bins + 1`` edges, which may be
                         equal: the last bin then holds everything
    Positions beyond the last edge count 0. The counters are plain longs, so the
    aggregation stays a hash aggregate with map-side partial sums.
    """
    counters = []
    for i in range(bins):
        lo, hi = f"get({edges}, {i})", f"get({edges}, {i + 1})"
        if closed == "right":
            inside = f"{value} > {lo} AND {value} <= {hi}"
        elif closed == "lowest":
            inside = f"{value} {'>=' if i == 0 else '>'} {lo} AND {value} <= {hi}"
        elif closed == "left":
            inside = f"{value} >= {lo} AND ({value} < {hi} OR (size({edges}) = {i + 2} AND {value} = {hi}))"
        elif closed == "equal":
            inside = f"{value} >= {lo} AND {value} {'<=' if i == bins - 1 else '<'} {hi}"
        else:
            raise ValueError(f"unknown closed={closed!r}")
        counters.append(f"count_if({inside})")
    return F.expr(f"array({', '.join(counters)})")


def total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda acc, n: acc + n)


def shares(counts: Column, denominator: Column) -> Column:
    return F.transform(counts, lambda n: n / denominator)


def floored(share: Column, floor: float) -> Column:
    return F.when(share < floor, F.lit(floor)).otherwise(share)


def term(cur: Column, ref: Column) -> Column:
    return (cur - ref) * F.ln(cur / ref)


def index(ref: Column, cur: Column, one: Callable[[Column, Column], Column] = term) -> Column:
    """Sum of ``one(cur, ref)`` over two equally long arrays of shares."""
    return F.aggregate(
        F.zip_with(cur, ref, one), F.lit(0.0), lambda acc, t: acc + t
    )


def term_or_infinity(cur: Column, ref: Column) -> Column:
    """PSI term without a floor: 0 when both shares are 0, infinite when one of them is."""
    return (
        F.when((cur == 0) & (ref == 0), F.lit(0.0))
        .when((cur == 0) | (ref == 0), F.lit(float("inf")))
        .otherwise((cur - ref) * F.ln(F.try_divide(cur, ref)))
    )


def grade(psi: Column) -> Column:
    """low / medium / high. NaN is 'high' (below no threshold); null stays null."""
    return _graded(psi, "low", "medium", "high")


def alert_level(psi: Column) -> Column:
    return _graded(psi, "GREEN", "YELLOW", "RED")


def _graded(psi: Column, low: str, medium: str, high: str) -> Column:
    return F.when(psi < LOW, low).when(psi < HIGH, medium).when(psi.isNotNull(), high)
