"""S1..S17: feeds, monthly tables, payload stores and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import drift as D
from riskloom.plans.medallion import backfill_layer, refresh
from riskloom.operators.arrears import add_arrears
from riskloom.session import scratch_dir
from riskloom.sources import feeds, payloads, tables
from riskloom.sources.schemas import FEEDS
from riskloom.workload import drift as W
from riskloom.workload import views as V
from riskloom.workload.registry import query

RAW_ATTRIBUTES = '"Customer_ID", "Name", "Age", "SSN", "Occupation", strftime(snapshot_date, \'%Y-%m-%d\') AS snapshot_date'


@query(
    "s1_read_feed",
    f"""SELECT "Customer_ID", "Name", NULLIF("Age", '') AS "Age", "SSN", "Occupation",
  strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date FROM attrs_text""",
    ["attrs_text"],
)
def _(spark, sf):
    path = scratch_dir(spark, "feed")
    # Quotes inside values are doubled, as in the feed's own files.
    rows = V.attrs_text(spark, sf)
    rows.write.option("header", True).option("escape", '"').option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return feeds.read_feed(spark, "attributes", path)


@query("s2_snapshot", "SELECT * FROM clicks WHERE snapshot_date = DATE '1998-03-01'", ["clicks"])
def _(spark, sf):
    return tables.snapshot(V.clicks(spark, sf), "1998-03-01")


@query(
    "s3_ingest_bronze",
    f"SELECT {RAW_ATTRIBUTES} FROM attrs_text".replace("strftime(snapshot_date, '%Y-%m-%d') AS ", ""),
    ["attrs_text"],
)
def _(spark, sf):
    path = scratch_dir(spark, "bronze")
    rows = V.attrs_text(spark, sf)
    tables.ingest_bronze(rows, path)
    tables.ingest_bronze(rows.where(F.col("snapshot_date") < F.lit("1997-01-01").cast("date")), path)
    return spark.read.parquet(path)


@query("s4_write_table", "SELECT * FROM silver_clicks", ["silver_clicks"])
def _(spark, sf):
    path = scratch_dir(spark, "silver")
    rows = V.silver_clicks(spark, sf)
    tables.write_table(rows, path)
    tables.write_table(tables.snapshot(rows, "1999-05-01"), path)
    return spark.read.parquet(path)


@query("s5_read_snapshot", "SELECT * FROM silver_clicks WHERE snapshot_date = DATE '1999-05-01'", ["silver_clicks"])
def _(spark, sf):
    path = scratch_dir(spark, "silver")
    tables.write_table(V.silver_clicks(spark, sf), path)
    return tables.read_snapshot(spark, path, "1999-05-01")


@query(
    "s6_read_snapshots",
    "SELECT * FROM silver_clicks WHERE snapshot_date BETWEEN DATE '1997-02-01' AND DATE '1998-01-01'",
    ["silver_clicks"],
)
def _(spark, sf):
    path = scratch_dir(spark, "silver")
    tables.write_table(V.silver_clicks(spark, sf), path)
    return tables.read_snapshots(spark, path, "1997-02-01", "1998-01-01")


@query(
    "s7_read_lagged",
    """SELECT "Customer_ID", fe_1, snapshot_date,
  CAST(datediff('month', snapshot_date, DATE '1995-04-01') AS INTEGER) AS months_ago
FROM clicks WHERE snapshot_date BETWEEN DATE '1994-10-01' AND DATE '1995-03-01'""",
    ["clicks"],
)
def _(spark, sf):
    # Only three of the six months before April 1995 exist.
    rows = V.clicks(spark, sf).select("Customer_ID", "fe_1", "snapshot_date")
    return tables.read_lagged(rows, "1995-04-01", 6)


@query(
    "s8_predictions_for_month",
    """SELECT "Customer_ID", model_predictions FROM scores WHERE snapshot_date = DATE '1998-04-01'""",
    ["scores"],
)
def _(spark, sf):
    # Three scoring jobs, told apart by order priority, each with its own layout.
    root = scratch_dir(spark, "predictions")
    orders = V.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        (F.col("o_totalprice") / 500000).alias("model_predictions"),
        V.month_of("o_orderdate").alias("snapshot_date"),
        F.substring("o_orderpriority", 1, 1).alias("job"),
    )
    by_date = orders.where("job in ('1', '2')").withColumn("date", F.date_format("snapshot_date", "yyyy-MM"))
    by_date.drop("snapshot_date", "job").write.partitionBy("date").parquet(f"{root}/a")
    orders.where("job = '3'").drop("job").write.partitionBy("snapshot_date").parquet(f"{root}/b")
    for day in ("1998-03-01", "1998-04-01"):
        one = tables.snapshot(orders.where("job in ('4', '5')"), day).drop("snapshot_date", "job")
        one.write.parquet(f"{root}/credit_model_preds_{day.replace('-', '_')}.parquet")
    return feeds.predictions_for_month(spark, root, "1998-04")


@query(
    "s9_psi_payload",
    f"""WITH {W.PAYLOAD_CTE}, {W.PAYLOAD_LONG}
SELECT month, strptime(month, '%Y-%m')::DATE AS month_dt, overall AS overall_psi, feature, psi FROM payload_long""",
    ["monitored"],
    ["overall_psi", "psi"],
)
def _(spark, sf):
    path = scratch_dir(spark, "payload")
    payloads.write_psi_payload(W.payloads(spark, sf), path)
    return payloads.ok_payloads(payloads.read_psi_payload(spark, path)).orderBy("month")


@query(
    "s9_psi_payload_status",
    f"WITH {W.PAYLOAD_CTE} SELECT month, overall, status FROM payload",
    ["monitored"],
    ["overall"],
)
def _(spark, sf):
    path = scratch_dir(spark, "payload")
    rows = W.payloads(spark, sf)
    payloads.write_psi_payload(rows, path)
    # A second run of some months replaces their documents.
    payloads.write_psi_payload(rows.where("month >= '2000-01'"), path)
    return payloads.read_psi_payload(spark, path).select("month", "overall", "status")


@query(
    "s10_append_history",
    f"""WITH {W.PAYLOAD_CTE}, {W.PAYLOAD_LONG}
SELECT month, max(overall) AS overall, max(psi) FILTER (feature = 'util_rate') AS util_rate FROM payload_long GROUP BY month""",
    ["monitored"],
    ["overall", "util_rate"],
)
def _(spark, sf):
    path = scratch_dir(spark, "history")
    rows = W.payloads(spark, sf)
    payloads.append_history(rows, path)
    payloads.append_history(rows.where("month >= '2000-01'"), path)
    history = payloads.read_history(spark, path)
    detail = F.from_json("detail_json", "map<string, double>")
    return history.select("month", "overall", F.try_element_at(detail, F.lit("util_rate")).alias("util_rate"))


@query("s11_write_feature_psi", W.FEATURE_PSI, ["order_features"], ["psi"])
def _(spark, sf):
    path = scratch_dir(spark, "feature-psi")
    base = W.baseline(spark, sf)
    cur = V.order_features(spark, sf).where("snapshot_date >= date'1996-01-01'")
    found = D.feature_psi(cur, base, "credit_model", "1995-12-01", ["amount", "tier"], W.CATEGORIES)
    payloads.write_feature_psi(found, path)
    return payloads.read_feature_psi(spark, path)


@query(
    "s12_baseline_table",
    f"""WITH {W.NUMERIC_A}, {W.CATEGORICAL_B}
SELECT feature, value_type, bin_id, lo, hi, category, p_ref FROM (
  SELECT feature, 'numeric' AS value_type, CAST(i - 1 AS INTEGER) AS bin_id, lo, hi, CAST(NULL AS VARCHAR) AS category, n / a AS p_ref
  FROM ref_n JOIN bins USING (feature, i)
  UNION ALL SELECT feature, 'categorical', NULL, NULL, NULL, category, share FROM cat_ref) AS u""",
    ["order_features"],
    ["p_ref"],
)
def _(spark, sf):
    path = scratch_dir(spark, "baseline")
    payloads.write_baseline(W.baseline(spark, sf), path)
    return payloads.read_baseline(spark, path, "credit_model", "1995-12-01").drop("model_name", "baseline_snapshot")


@query(
    "s13_select_present",
    """SELECT "Customer_ID", snapshot_date, "Age", "Occupation" FROM attrs""",
    ["attrs"],
)
def _(spark, sf):
    return tables.select_present(
        V.attrs(spark, sf), ["Customer_ID", "snapshot_date", "Gender", "Age", "Occupation"]
    )


@query(
    "s14_month_spine",
    """SELECT CAST(m AS DATE) AS snapshot_date
FROM (SELECT unnest(generate_series(date_trunc('month', min(loan_start_date)), max(snapshot_date), INTERVAL 1 MONTH)) AS m
  FROM ledger) AS s""",
    ["ledger"],
)
def _(spark, sf):
    rows = V.ledger(spark, sf)
    ends = rows.select(F.least("loan_start_date", "snapshot_date").alias("snapshot_date"))
    return tables.spine_of(ends.unionAll(rows.select("snapshot_date")))


@query("s15_backfill", "SELECT * FROM silver_ledger WHERE snapshot_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-01'",
       ["silver_ledger"])
def _(spark, sf):
    path = scratch_dir(spark, "backfill")
    backfill_layer(V.ledger(spark, sf), add_arrears, path, "1996-01-01", "1999-12-01")
    return spark.read.parquet(path)


@query(
    "s15_refresh_changed",
    """WITH kept AS (SELECT * FROM silver_clicks WHERE snapshot_date <> DATE '1998-03-01'),
engaged AS (SELECT CAST(snapshot_date + to_months(i) AS DATE) AS snapshot_date, min(fe_1) FILTER (i = 1) AS click_1m
  FROM kept, (SELECT unnest([1, 2, 3, 4, 5, 6]) AS i) AS steps
  WHERE CAST(snapshot_date + to_months(i) AS DATE) <= DATE '2001-12-01' GROUP BY "Customer_ID", 1)
SELECT 'silver/clickstream' AS table_name, snapshot_date, count(*) AS row_count, CAST(sum(fe_1) AS BIGINT) AS total FROM kept GROUP BY 2
UNION ALL SELECT 'gold/engagement', snapshot_date, count(*), CAST(sum(click_1m) AS BIGINT) FROM engaged GROUP BY 2
UNION ALL SELECT 'silver/ledger', snapshot_date, count(*), CAST(sum(installment_num) AS BIGINT) FROM silver_ledger GROUP BY 2
UNION ALL SELECT 'gold/label_store', snapshot_date, count(*), CAST(sum(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS BIGINT)
  FROM silver_ledger WHERE mob = 3 GROUP BY 2""",
    ["silver_clicks", "silver_ledger"],
)
def _(spark, sf):
    """Both feeds are built, a month of clicks is withdrawn, and a second run follows the change."""
    root = scratch_dir(spark, "refreshed")
    paths = {feed: f"{root}/raw/{feed}" for feed in ("clickstream", "ledger")}
    clicks = V.clicks_text(spark, sf)

    def deliver(rows, feed):
        # Packed text is read file by file, so files are kept small.
        writer = rows.select(*FEEDS[feed]).write.mode("overwrite").option("header", True).option("escape", '"')
        writer.option("maxRecordsPerFile", 1_000_000).csv(paths[feed], compression="gzip")

    deliver(V.ledger(spark, sf), "ledger")
    for rows in (clicks, clicks.where(F.col("snapshot_date").cast("date") != F.lit("1998-03-01").cast("date"))):
        deliver(rows, "clickstream")
        refresh(spark, paths, f"{root}/mart", "1992-01-01", "2001-12-01", dpd=30, mob=3)
    measures = {
        "silver/clickstream": "fe_1", "gold/engagement": "click_1m",
        "silver/ledger": "installment_num", "gold/label_store": "label",
    }
    out = None
    for name, measure in measures.items():
        one = spark.read.parquet(f"{root}/mart/{name}").groupBy(F.lit(name).alias("table_name"), "snapshot_date").agg(
            F.count("*").alias("row_count"), F.sum(measure).cast("bigint").alias("total")
        )
        out = one if out is None else out.unionAll(one)
    return out


@query(
    "s16_snapshot_coverage",
    """SELECT table_name, min(snapshot_date) AS earliest, max(snapshot_date) AS latest,
  count(*) AS months, count(*) FILTER (snapshot_date < DATE '1996-01-01') AS months_before_root,
  count(*) FILTER (snapshot_date >= DATE '1996-01-01') AS months_from_root,
  datediff('month', min(snapshot_date), max(snapshot_date)) + 1 - count(*) AS months_missing,
  CASE WHEN count(*) FILTER (snapshot_date < DATE '1996-01-01') > 0 THEN min(snapshot_date)
    ELSE DATE '1996-01-01' END AS recommended_start
FROM (SELECT DISTINCT 'ledger' AS table_name, snapshot_date FROM ledger
  UNION ALL SELECT DISTINCT 'attributes', snapshot_date FROM attrs_text
  UNION ALL SELECT DISTINCT 'late scores', snapshot_date FROM scores
    WHERE snapshot_date >= DATE '1997-01-01' AND month(snapshot_date) <> 6) AS t
GROUP BY table_name""",
    ["ledger", "attrs_text", "scores"],
)
def _(spark, sf):
    late = V.scores(spark, sf).where("snapshot_date >= date'1997-01-01' and month(snapshot_date) <> 6")
    found = {"ledger": V.ledger(spark, sf), "attributes": V.attrs_text(spark, sf), "late scores": late}
    return tables.snapshot_coverage(found, "1996-01-01")


@query(
    "s16_missing_months",
    """SELECT CAST(m AS DATE) AS snapshot_date
FROM (SELECT unnest(generate_series(min(snapshot_date), max(snapshot_date), INTERVAL 1 MONTH)) AS m
  FROM scores WHERE month(snapshot_date) <> 6) AS s
WHERE CAST(m AS DATE) NOT IN (SELECT snapshot_date FROM scores WHERE month(snapshot_date) <> 6)""",
    ["scores"],
)
def _(spark, sf):
    return tables.missing_months(V.scores(spark, sf).where("month(snapshot_date) <> 6"))


@query("s17_row_counts", "SELECT snapshot_date, count(*) AS row_count FROM ledger GROUP BY 1", ["ledger"])
def _(spark, sf):
    return tables.row_counts(V.ledger(spark, sf))
