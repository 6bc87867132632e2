"""The monthly data mart: raw feeds to bronze, silver and gold, all months in one pass.

Every table is written once per call whatever the number of months; a rerun replaces the
months it covers, those that have no rows any more included. :func:`refresh` finds the months of each feed that differ from
what was processed last and rewrites those and what depends on them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.months import as_date, later_months, listed_months
from riskloom.operators.arrears import label_store, silver_loan
from riskloom.operators.cleaning import clean_attributes, clean_clickstream, clean_financials
from riskloom.operators.features import customer_risk_features, engagement_features_all
from riskloom.session import stored
from riskloom.sources.changes import changed_months, month_digests, store_digests, stored_digests
from riskloom.sources.feeds import read_feed
from riskloom.sources.schemas import raw_schema
from riskloom.sources.tables import MONTH, between_months, ingest_bronze, read_snapshots, write_table

#: Months of clicks that an engagement row looks back on.
ENGAGEMENT_MONTHS = 6

SILVER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "ledger": silver_loan,
    "clickstream": clean_clickstream,
    "attributes": clean_attributes,
    "financials": clean_financials,
}


def build_bronze(
    spark: SparkSession, feeds: Mapping[str, str], root: str, lo: str | date, hi: str | date
) -> None:
    """Raw snapshots of ``lo``..``hi`` of every feed (name to CSV path)."""
    for feed, path in feeds.items():
        raw = read_feed(spark, feed, path)
        month = F.col(MONTH).try_cast("date")
        ingest_bronze(raw.where(month.between(as_date(lo), as_date(hi))), f"{root}/bronze/{feed}", listed_months(lo, hi))


def build_silver(spark: SparkSession, feeds: list[str], root: str, lo: str | date, hi: str | date) -> None:
    for feed in feeds:
        raw = read_snapshots(spark, f"{root}/bronze/{feed}", lo, hi)
        write_table(SILVER[feed](raw), f"{root}/silver/{feed}", rebalance=False, months=listed_months(lo, hi))


def build_gold(
    spark: SparkSession, root: str, lo: str | date, hi: str | date, dpd: int, mob: int
) -> None:
    """Label store, customer risk features and click engagement for ``lo``..``hi``."""
    months = listed_months(lo, hi)
    write_labels(read_snapshots(spark, f"{root}/silver/ledger", lo, hi), root, dpd, mob, months)
    financials = read_snapshots(spark, f"{root}/silver/financials", lo, hi)
    write_table(customer_risk_features(financials), f"{root}/gold/customer_risk", rebalance=False, months=months)
    clicks = spark.read.parquet(f"{root}/silver/clickstream")
    write_table(engagement_features_all(clicks, lo, hi), f"{root}/gold/engagement", months=months)


def write_labels(ledger: DataFrame, root: str, dpd: int, mob: int, months: Sequence[date]) -> None:
    """Replace one definition of the label in ``months``; other definitions stay."""
    own = {"label_def": f"{dpd}dpd_{mob}mob"}
    write_table(
        label_store(ledger, dpd, mob),
        f"{root}/gold/label_store",
        ["label_def", MONTH],
        rebalance=False,
        months=months,
        within=own,
    )


def backfill(
    spark: SparkSession,
    feeds: Mapping[str, str],
    root: str,
    lo: str | date,
    hi: str | date,
    dpd: int,
    mob: int,
) -> None:
    """Bronze, silver and gold for all months from ``lo`` to ``hi``."""
    build_bronze(spark, feeds, root, lo, hi)
    build_silver(spark, list(feeds), root, lo, hi)
    build_gold(spark, root, lo, hi, dpd, mob)


def refresh(
    spark: SparkSession,
    feeds: Mapping[str, str],
    root: str,
    lo: str | date,
    hi: str | date,
    dpd: int,
    mob: int,
) -> dict[str, list[date]]:
    """Rewrite the months that changed between ``lo`` and ``hi``, and return them per table.

    A month of bronze and silver depends on the same month of its feed, labels on the ledger's, risk features on the
    financials', engagement on the six months of clicks before it. A month that left the feed is emptied everywhere. Digests
    are kept per feed and, for labels, per definition; the first run with a definition builds all its months. Digests are
    stored last, so a run that dies is done again. Without changes nothing is written. Snapshots are dated on the first of
    a month; rows of other days are left out.
    """
    span = listed_months(lo, hi)
    done: dict[str, list[date]] = {}
    known: list[tuple[DataFrame, str, list[date]]] = []
    for feed, path in feeds.items():
        raw = read_feed(spark, feed, path)
        raw = raw.where(F.col(MONTH).try_cast("date").isin(span))
        now = stored(month_digests(raw), "digests")

        def differing(kept: str, now: DataFrame = now) -> list[date]:
            before = stored_digests(spark, f"{root}/digests/{kept}").where(F.col(MONTH).isin(span))
            months = changed_months(now, before)
            if months:
                known.append((now, f"{root}/digests/{kept}", months))
            return months

        months = differing(feed)
        if months:
            done[f"bronze/{feed}"] = done[f"silver/{feed}"] = months
            bronze = f"{root}/bronze/{feed}"
            ingest_bronze(raw.where(F.col(MONTH).try_cast("date").isin(months)), bronze, months)
            # The schema is given, since a table may have lost all its months.
            rows = spark.read.schema(T.StructType([*raw.drop(MONTH).schema, T.StructField(MONTH, T.DateType())]))
            own = rows.parquet(bronze).where(F.col(MONTH).isin(months))
            # Bronze files hold one month each, so neither silver nor what is made of it row by row is dealt anew.
            write_table(SILVER[feed](own), f"{root}/silver/{feed}", rebalance=False, months=months)
        if feed == "ledger":
            _refresh_own(spark, root, feed, differing(f"labels_{dpd}dpd_{mob}mob"), done, "gold/label_store",
                         lambda rows, m: write_labels(rows, root, dpd, mob, m))
        elif feed == "financials":
            _refresh_own(spark, root, feed, months, done, "gold/customer_risk",
                         lambda rows, m: write_table(
                             customer_risk_features(rows), f"{root}/gold/customer_risk", rebalance=False, months=m))
        elif feed == "clickstream":
            targets = sorted(later_months(months, range(1, ENGAGEMENT_MONTHS + 1)) & set(span))
            _refresh_own(spark, root, feed, targets, done, "gold/engagement",
                         lambda rows, m: write_table(
                             engagement_features_all(rows, m[0], m[-1], ENGAGEMENT_MONTHS).where(F.col(MONTH).isin(m)),
                             f"{root}/gold/engagement", months=m), whole=True)
    for now, path, months in known:
        store_digests(now, path, months)
    return done


def _refresh_own(
    spark: SparkSession,
    root: str,
    feed: str,
    months: list[date],
    done: dict[str, list[date]],
    table: str,
    write: Callable[[DataFrame, list[date]], None],
    whole: bool = False,
) -> None:
    """Rewrite ``months`` of a gold table from a silver one: from the same months, or from the ``whole`` of it."""
    if not months:
        return
    silver = f"{root}/silver/{feed}"
    # The types of an empty table come from the cleaning step itself.
    raw = T.StructType([*raw_schema(feed)])
    empty = spark.createDataFrame([], raw).withColumn(MONTH, F.col(MONTH).cast("date"))
    rows = spark.read.schema(SILVER[feed](empty).schema).parquet(silver)
    write(rows if whole else rows.where(F.col(MONTH).isin(months)), months)
    done[table] = months


def backfill_layer(
    table: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    path: str,
    lo: str | date,
    hi: str | date,
) -> None:
    """One layer of one table for a range of months; months without rows are emptied."""
    write_table(step(between_months(table, lo, hi)), path, months=listed_months(lo, hi))
