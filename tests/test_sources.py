import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskloom.sources import feeds, payloads, tables
from riskloom.sources.schemas import raw_schema
from riskloom.streaming.catchup import catch_up
from riskloom.workload import views as V


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)


HEADER = "Customer_ID,Name,Age,SSN,Occupation,snapshot_date\n"


def test_feed_keeps_quotes_and_text(spark, scratch):
    path = scratch("feed")
    _write(path, "a.csv", HEADER + 'C1,"""Ann, B",41_,123-45-6789,Lawyer,2023-01-01\nC2,,,x,_______,2023-02-01\n')
    rows = feeds.read_feed(spark, "attributes", path).orderBy("Customer_ID").collect()
    assert rows[0]["Name"] == '"Ann, B' and rows[0]["Age"] == "41_"
    assert rows[1]["Name"] is None


def test_feed_with_other_columns_fails(spark, scratch):
    path = scratch("feed")
    _write(path, "a.csv", "a,b,c,d,e,f\n1,2,3,4,5,6\n")
    with pytest.raises(Exception, match="header"):
        feeds.read_feed(spark, "attributes", path).collect()


def test_rewriting_a_month_leaves_the_others(spark, scratch):
    path = scratch("table")
    rows = spark.createDataFrame([("a", date(2023, 1, 1)), ("b", date(2023, 2, 1))], "x string, snapshot_date date")
    tables.write_table(rows, path)
    tables.write_table(rows.where("x = 'a'").withColumn("x", F.lit("c")), path)
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == ["b", "c"]
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, path, "2024-01-01")


def test_month_filter_reaches_the_partitions(spark, scratch):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    path = scratch("table")
    tables.write_table(spark.createDataFrame([("a", date(2023, 1, 1))], "x string, snapshot_date date"), path)
    plan = tables.read_snapshots(spark, path, "2023-01-01", "2023-06-01")._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert ">= 2023-01-01" in filters and "<= 202" in filters


def test_payload_documents_of_either_shape(spark, scratch):
    path = scratch("payload")
    # Published monthly results: a computed month, pretty-printed, and a skipped one.
    _write(path, "psi_2024-03.json", json.dumps(
        {"month": "2024-03", "overall": 0.016966227083140648, "psi": {"prediction": 0.016966227083140648}, "status": "OK"}, indent=2))
    _write(path, "psi_2023-01.json", '{"month": "2023-01", "status": "SKIPPED_NO_BASELINE"}')
    read = payloads.read_psi_payload(spark, path)
    assert read.count() == 2
    row = payloads.ok_payloads(read).collect()
    assert len(row) == 1 and row[0]["psi"] == 0.016966227083140648 and row[0]["month_dt"] == date(2024, 3, 1)


def test_history_is_replaced_per_month(spark, scratch):
    path = scratch("history")
    schema = "month string, overall double, psi map<string,double>, status string"
    payloads.append_history(spark.createDataFrame([("2024-01", 0.1, {"a": 0.1}, "OK"), ("2024-02", None, None, "SKIPPED_NO_BASELINE")], schema), path)
    payloads.append_history(spark.createDataFrame([("2024-01", 0.2, {"a": 0.2}, "OK")], schema), path)
    rows = payloads.read_history(spark, path).collect()
    assert [(r["month"], r["overall"], json.loads(r["detail_json"])) for r in rows] == [("2024-01", 0.2, {"a": 0.2})]


def test_baseline_document_with_infinite_edges(spark, scratch):
    path = scratch("baseline")
    _write(path, "baseline.json", json.dumps({
        "numeric": {"x": {"edges": [float("-inf"), 1.5, float("inf")], "p_ref": [0.25, 0.75]}},
        "categorical": {"c": {"p_ref": {"a": 0.9, "__OTHER__": 0.1}}}}, indent=2))
    rows = payloads.import_baseline_json(spark, path).collect()
    numeric = sorted((r["bin_id"], r["lo"], r["hi"], r["p_ref"]) for r in rows if r["value_type"] == "numeric")
    assert numeric == [(0, float("-inf"), 1.5, 0.25), (1, 1.5, float("inf"), 0.75)]
    assert {r["category"]: r["p_ref"] for r in rows if r["value_type"] == "categorical"} == {"a": 0.9, "__OTHER__": 0.1}


def test_catch_up_reads_each_file_once(spark, scratch):
    source, table, progress = scratch("source"), scratch("bronze"), scratch("progress")
    line = "C{0},Ann,41,x,Lawyer,{1}\n".format
    _write(source, "1.csv", HEADER + line(1, "2023-01-01") + line(2, "2023-02-01"))
    catch_up(spark, "attributes", source, table, progress)
    _write(source, "2.csv", HEADER + line(3, "2023-01-01"))
    catch_up(spark, "attributes", source, table, progress)
    catch_up(spark, "attributes", source, table, progress)
    got = sorted((r["Customer_ID"], str(r["snapshot_date"])) for r in spark.read.parquet(table).collect())
    assert got == [("C1", "2023-01-01"), ("C2", "2023-02-01"), ("C3", "2023-01-01")]


def test_raw_schemas_are_text():
    assert {f.dataType.simpleString() for f in raw_schema("financials").fields} == {"string"}


def test_views_cover_the_feeds(spark, sf):
    for feed, view in (("ledger", V.ledger_text), ("clickstream", V.clicks_text), ("attributes", V.attrs_text), ("financials", V.fins_text)):
        assert set(raw_schema(feed).names) <= set(view(spark, sf).columns)
