"""Registration of the checkable queries: a Spark callable and, where possible, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 6


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(
    name: str, sql: str | None = None, views: Sequence[str] = (), doubles: Sequence[str] = ()
):
    """Register a query. ``views`` are prepended to the SQL as common table expressions;
    the columns in ``doubles`` are rounded to six digits on both sides."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir).withColumns({c: F.round(F.col(c), DIGITS) for c in doubles})

        QUERIES[name] = Query(run, None if sql is None else _full_sql(sql, views, doubles))
        return fn

    return add


def _full_sql(sql: str, views: Sequence[str], doubles: Sequence[str]) -> str:
    from riskloom.workload.views import with_views

    body = sql.strip()
    if doubles:
        rounded = ", ".join(f'ROUND("{c}", {DIGITS}) AS "{c}"' for c in doubles)
        body = f"SELECT * REPLACE ({rounded}) FROM (\n{body}\n) AS rounded"
    return with_views(body, views)
