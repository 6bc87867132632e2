"""Backfill driven by what changed in the feeds."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskloom.functions.months import later_months, listed_months
from riskloom.plans import medallion
from riskloom.sources import changes, tables
from riskloom.sources.schemas import FEEDS
from riskloom.workload import views as V

LO, HI = "1996-01-01", "1996-12-01"
VIEWS = {"ledger": V.ledger_text, "clickstream": V.clicks_text, "attributes": V.attrs_text, "financials": V.fins_text}


def _write(rows, feed, path):
    rows.select(*FEEDS[feed]).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def _files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root.removeprefix("file:")) for f in names if f.endswith("parquet")}


@pytest.fixture(scope="module")
def mart(spark, sf):
    from riskloom.session import scratch_dir

    root = scratch_dir(spark, "changing")
    feeds, rows = {}, {}
    for feed, view in VIEWS.items():
        rows[feed] = view(spark, sf).where(F.col("snapshot_date").cast("date").between(LO, HI)).cache()
        feeds[feed] = f"{root}/raw/{feed}"
        _write(rows[feed], feed, feeds[feed])
    return root, feeds, rows


def test_correction_rewrites_its_dependants_only(spark, mart):
    root, feeds, rows = mart
    run = lambda: medallion.refresh(spark, feeds, f"{root}/mart", LO, HI, dpd=30, mob=3)
    first = run()
    assert set(first) == {
        *(f"{layer}/{f}" for layer in ("bronze", "silver") for f in feeds),
        "gold/label_store", "gold/customer_risk", "gold/engagement",
    }
    held = _files(f"{root}/mart")
    assert run() == {} and _files(f"{root}/mart") == held

    # April loses its clicks, and one ledger row of June changes.
    april, june = date(1996, 4, 1), date(1996, 6, 1)
    clicks = rows["clickstream"].where(F.col("snapshot_date").cast("date") != F.lit(april))
    _write(clicks, "clickstream", feeds["clickstream"])
    odd = (F.col("snapshot_date").cast("date") == F.lit(june)) & (F.col("loan_id") == F.lit(
        rows["ledger"].where(F.col("snapshot_date").cast("date") == F.lit(june)).agg(F.max("loan_id")).first()[0]))
    ledger = rows["ledger"].withColumn("balance", F.when(odd, F.lit("1.5")).otherwise(F.col("balance")))
    _write(ledger, "ledger", feeds["ledger"])
    assert run() == {
        "bronze/clickstream": [april], "silver/clickstream": [april],
        "gold/engagement": [date(1996, m, 1) for m in range(5, 11)],
        "bronze/ledger": [june], "silver/ledger": [june], "gold/label_store": [june],
    }
    # Partitions of other months kept their files.
    gone = held - _files(f"{root}/mart")
    touched = {p.split("snapshot_date=")[1][:10] for p in gone if "digests" not in p}
    assert touched <= {f"1996-{m:02}-01" for m in range(4, 11)}
    assert not any("attributes" in p or "financials" in p or "customer_risk" in p for p in gone)

    # The result is that of a full run over the corrected feeds.
    medallion.backfill(spark, feeds, f"{root}/fresh", LO, HI, dpd=30, mob=3)
    for table in [*first]:
        mine, theirs = (spark.read.parquet(f"{root}/{r}/{table}") for r in ("mart", "fresh"))
        assert mine.exceptAll(theirs.select(mine.columns)).isEmpty(), table
        assert theirs.select(mine.columns).exceptAll(mine).isEmpty(), table
    assert run() == {}

    # Another label definition is built once and leaves the first one as it is.
    labels = spark.read.parquet(f"{root}/mart/gold/label_store").count()
    other = medallion.refresh(spark, feeds, f"{root}/mart", LO, HI, dpd=60, mob=2)
    assert set(other) == {"gold/label_store"}
    assert spark.read.parquet(f"{root}/mart/gold/label_store").where("label_def = '30dpd_3mob'").count() == labels


def test_digests_see_rows_not_their_order(spark):
    schema = "snapshot_date date, a string, b string"
    day, other = date(2024, 1, 1), date(2024, 2, 1)
    rows = [(day, "x", None), (day, "y", "z"), (day, "y", "z"), (other, "x", "y")]
    of = lambda r: changes.month_digests(spark.createDataFrame(r, schema))
    base = of(rows)
    assert changes.changed_months(of(rows[::-1]).repartition(3), base) == []
    assert changes.changed_months(of([(day, None, "x"), *rows[1:]]), base) == [day]
    assert changes.changed_months(of(rows[:2] + rows[3:]), base) == [day]
    assert changes.changed_months(of(rows[:3]), base) == [other]
    assert changes.changed_months(of([]), base) == [day, other]
    assert changes.changed_months(base, of([])) == [day, other]


def test_rerun_empties_months_of_its_own_definition_only(spark, scratch):
    path = scratch("labels")
    schema = "label_def string, snapshot_date date, x int"
    a, b = date(2024, 1, 1), date(2024, 2, 1)
    rows = spark.createDataFrame([("p", a, 1), ("p", b, 2), ("q", a, 3), ("q", b, 4)], schema)
    tables.write_table(rows, path, ["label_def", "snapshot_date"])
    again = rows.where("x = 2")
    tables.write_table(again, path, ["label_def", "snapshot_date"], months=[a, b], within={"label_def": "p"})
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [2, 3, 4]
    tables.write_table(rows.where("false"), path, ["label_def", "snapshot_date"], months=[b])
    assert [r.x for r in spark.read.parquet(path).collect()] == [3]


def test_months():
    assert listed_months("2023-11-15", "2024-02-01") == [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1)]
    assert later_months([date(2023, 12, 1)], [0, 1, 13]) == {date(2023, 12, 1), date(2024, 1, 1), date(2025, 1, 1)}


def test_monthly_input_is_not_dealt_anew(spark, sf, scratch, monkeypatch):
    """Silver and labels are written month by month from what is already clustered, with few files open and no sort."""
    root, seen = scratch("clustered"), {}
    write = medallion.write_table

    def watched(df, path, *args, rebalance=True, **more):
        seen[path.removeprefix(f"{root}/mart/")] = rebalance
        write(df, path, *args, rebalance=rebalance, **more)

    monkeypatch.setattr(medallion, "write_table", watched)
    _write(V.ledger(spark, sf), "ledger", f"{root}/raw")
    medallion.refresh(spark, {"ledger": f"{root}/raw"}, f"{root}/mart", LO, HI, dpd=30, mob=3)
    assert seen == {"silver/ledger": False, "gold/label_store": False}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    months = spark.read.parquet(f"{root}/mart/silver/ledger")
    assert months.count() == spark.read.parquet(f"{root}/mart/bronze/ledger").count() > 0
