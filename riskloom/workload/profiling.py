"""A1..A16: profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import drift as D
from riskloom.operators import profile as P
from riskloom.operators import sketches as S
from riskloom.operators.frequent import BUCKETS
from riskloom.session import scratch_dir
from riskloom.workload import views as V
from riskloom.workload.registry import query

_FIN_COLUMNS = ["Annual_Income", "Monthly_Inhand_Salary", "Num_of_Loan", "Credit_History_Age", "Outstanding_Debt"]


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


_ATTR = ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"]


@query(
    "a1_null_counts",
    _union(f"""SELECT '{c}' AS column_name, count(*) FILTER ("{c}" IS NULL) AS nulls FROM attrs""" for c in _ATTR),
    ["attrs"],
)
def _(spark, sf):
    return P.null_counts(V.attrs(spark, sf))


_CLICK_COLUMNS = ["Customer_ID", "snapshot_date", *[f"fe_{i}" for i in range(1, 21)]]


@query(
    "a2_distinct_counts",
    _union(f"""SELECT '{c}' AS column_name, count(DISTINCT "{c}") AS distinct_values FROM clicks""" for c in _CLICK_COLUMNS),
    ["clicks"],
)
def _(spark, sf):
    return P.distinct_counts(V.clicks(spark, sf), _CLICK_COLUMNS)


@query(
    "a2_month_turnover",
    """WITH months AS (SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS earlier
  FROM (SELECT DISTINCT snapshot_date FROM clicks) AS m),
seen AS (SELECT DISTINCT snapshot_date, "Customer_ID" AS c FROM clicks)
SELECT k.snapshot_date, 'Customer_ID' AS feature, CAST(count(a.c) AS BIGINT) AS distinct_values,
  CAST(count(a.c) - count(b.c) FILTER (a.c IS NOT NULL) AS BIGINT) AS gained,
  CAST(count(b.c) FILTER (a.c IS NULL) AS BIGINT) AS lost, CAST(count(b.c) FILTER (a.c IS NOT NULL) AS BIGINT) AS kept
FROM (SELECT months.snapshot_date, months.earlier, u.c FROM months
    JOIN (SELECT snapshot_date AS d, c FROM seen) AS u ON u.d = months.snapshot_date OR u.d = months.earlier GROUP BY ALL) AS k
  LEFT JOIN seen AS a ON a.snapshot_date = k.snapshot_date AND a.c = k.c
  LEFT JOIN seen AS b ON b.snapshot_date = k.earlier AND b.c = k.c
GROUP BY k.snapshot_date""",
    ["clicks"],
)
def _(spark, sf):
    path = scratch_dir(spark, "distinct-sketches")
    S.store_sketches(S.distinct_sketches(V.clicks(spark, sf), ["Customer_ID"]), path)
    return S.month_turnover(spark.read.parquet(path))


def _describe_sql(source: str, cols) -> str:
    return _union(
        f"""SELECT '{c}' AS column_name, count("{c}") AS "count", avg("{c}") AS mean, stddev_samp("{c}") AS std,
  CAST(min("{c}") AS DOUBLE) AS min, quantile_cont(CAST("{c}" AS DOUBLE), 0.25) AS p25, quantile_cont(CAST("{c}" AS DOUBLE), 0.5) AS p50,
  quantile_cont(CAST("{c}" AS DOUBLE), 0.75) AS p75, CAST(max("{c}") AS DOUBLE) AS max FROM {source}"""
        for c in cols
    )


_DESCRIBED = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@query("a3_describe", _describe_sql("fins", _FIN_COLUMNS), ["fins"], _DESCRIBED)
def _(spark, sf):
    return P.describe(V.fins(spark, sf), _FIN_COLUMNS)


@query(
    "a3_describe_ledger",
    _describe_sql("ledger", ["due_amt", "overdue_amt", "balance"]),
    ["ledger"],
    _DESCRIBED,
)
def _(spark, sf):
    return P.describe(V.ledger(spark, sf), ["due_amt", "overdue_amt", "balance"])


@query(
    "a4_distinct_values",
    """SELECT DISTINCT 'Age' AS source, "Age" AS value FROM attrs_text
UNION ALL SELECT DISTINCT 'Occupation', "Occupation" FROM attrs_text
UNION ALL SELECT DISTINCT 'Num_of_Loan', "Num_of_Loan" FROM fins_text WHERE "Type_of_Loan" IS NULL""",
    ["attrs_text", "fins_text"],
)
def _(spark, sf):
    people, money = V.attrs_text(spark, sf), V.fins_text(spark, sf)
    parts = [
        ("Age", P.distinct_values(people, "Age")),
        ("Occupation", P.distinct_values(people, "Occupation")),
        ("Num_of_Loan", P.distinct_values(money.where(F.col("Type_of_Loan").isNull()), "Num_of_Loan")),
    ]
    out = None
    for name, rows in parts:
        one = rows.select(F.lit(name).alias("source"), F.col(name).alias("value"))
        out = one if out is None else out.unionAll(one)
    return out


@query(
    "a5_value_share",
    """SELECT "Occupation", count(*) AS row_count, count(*) * 100.0 / sum(count(*)) OVER () AS percentage
FROM attrs GROUP BY "Occupation" """,
    ["attrs"],
    ["percentage"],
)
def _(spark, sf):
    return P.value_share(V.attrs(spark, sf), "Occupation")


@query(
    "a6_records_per_customer",
    _describe_sql('(SELECT count(*) AS records FROM ledger GROUP BY "Customer_ID") AS r', ["records"]),
    ["ledger"],
    _DESCRIBED,
)
def _(spark, sf):
    return P.records_per_customer(V.ledger(spark, sf))


def _histogram_sql(source: str, cols, bins: int, hue: str = "", log: bool = False) -> str:
    keep = f"{hue}, " if hue else ""
    parts = []
    for c in cols:
        value = f'log10(CAST("{c}" AS DOUBLE))' if log else f'CAST("{c}" AS DOUBLE)'
        where = f'"{c}" > 0' if log else f'"{c}" IS NOT NULL'
        parts.append(
            f"""SELECT '{c}' AS feature, {keep}bin, count(*) AS row_count, lo + bin * ((hi - lo) / {bins}) AS bin_start
FROM (SELECT {keep}lo, hi, CAST(least(COALESCE(floor((v - lo) / NULLIF((hi - lo) / {bins}, 0)), 0), {bins - 1}) AS INTEGER) AS bin
  FROM (SELECT {keep}v, min(v) OVER () AS lo, max(v) OVER () AS hi
    FROM (SELECT {keep}{value} AS v FROM {source} WHERE {where}) AS x) AS y) AS z
GROUP BY {keep}bin, lo, hi"""
        )
    return _union(parts)


@query("a7_histogram", _histogram_sql("clicks", ["fe_1", "fe_2", "fe_7"], 30), ["clicks"], ["bin_start"])
def _(spark, sf):
    return P.histogram(V.clicks(spark, sf), ["fe_1", "fe_2", "fe_7"], 30)


_LABELLED = """(SELECT label, "Age", "Annual_Income", "Interest_Rate" FROM label_rows
  LEFT JOIN attrs USING ("Customer_ID") LEFT JOIN (SELECT "Customer_ID", "Annual_Income", "Interest_Rate" FROM fins) AS f
  USING ("Customer_ID")) AS labelled"""
_HISTOGRAM_COLUMNS = ["Age", "Annual_Income", "Interest_Rate"]


def _labelled(spark, sf):
    from riskloom.operators.joins import lookup_join

    tables = [
        V.attrs(spark, sf).select("Customer_ID", "Age", "Occupation"),
        V.fins(spark, sf).select("Customer_ID", "Annual_Income", "Interest_Rate", "Credit_Mix", "Payment_Behaviour"),
    ]
    return lookup_join(V.labels_silver(spark, sf), tables, "Customer_ID")


@query(
    "a7_histogram_by_label",
    _histogram_sql(_LABELLED, _HISTOGRAM_COLUMNS, 40, "label"),
    ["label_rows", "attrs", "fins"],
    ["bin_start"],
)
def _(spark, sf):
    return P.histogram(_labelled(spark, sf), _HISTOGRAM_COLUMNS, 40, ["label"])


@query(
    "a7_histogram_log_scale",
    _histogram_sql(_LABELLED, _HISTOGRAM_COLUMNS, 40, "label", log=True),
    ["label_rows", "attrs", "fins"],
    ["bin_start"],
)
def _(spark, sf):
    return P.histogram(_labelled(spark, sf), _HISTOGRAM_COLUMNS, 40, ["label"], log_scale=True)


_CATEGORIES = ["Occupation", "Credit_Mix", "Payment_Behaviour"]


@query(
    "a8_category_by_label",
    _union(
        f"""SELECT '{c}' AS feature, CAST("{c}" AS VARCHAR) AS category, label, count(*) AS row_count
FROM label_rows JOIN (SELECT "Customer_ID", "{c}" FROM {t}) AS t USING ("Customer_ID") WHERE "{c}" IS NOT NULL GROUP BY 2, 3"""
        for c, t in zip(_CATEGORIES, ["attrs", "fins", "fins"])
    ),
    ["label_rows", "attrs", "fins"],
)
def _(spark, sf):
    return P.category_by_label(_labelled(spark, sf), _CATEGORIES)


_RANKED = [
    "Age", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
    "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries",
    "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age", "Total_EMI_per_month", "Monthly_Balance", "label",
]
_RANKED_FINANCIALS = [c for c in _RANKED if c not in ("Age", "label")]


def _spearman_sql(source: str, cols) -> str:
    parts = []
    for a in cols:
        cells = []
        for b in cols:
            if a == b:
                cells.append(f'1.0::DOUBLE AS "{b}"')
                continue
            cells.append(
                f"""(SELECT CASE WHEN NOT isnan(corr(rx, ry)) THEN corr(rx, ry) END FROM (SELECT
    rank() OVER (ORDER BY "{a}") + (count(*) OVER (PARTITION BY "{a}") - 1) / 2.0::DOUBLE AS rx,
    rank() OVER (ORDER BY "{b}") + (count(*) OVER (PARTITION BY "{b}") - 1) / 2.0::DOUBLE AS ry
    FROM {source} WHERE "{a}" IS NOT NULL AND "{b}" IS NOT NULL) AS r) AS "{b}" """
            )
        parts.append(f"SELECT '{a}' AS feature, {', '.join(cells)}")
    return _union(parts)


@query(
    "a9_spearman_matrix",
    """WITH ranked AS MATERIALIZED (SELECT label, "Age", f.* EXCLUDE ("Customer_ID") FROM label_rows
  LEFT JOIN attrs USING ("Customer_ID") LEFT JOIN (SELECT "Customer_ID", """
    + ", ".join(f'"{c}"' for c in _RANKED_FINANCIALS)
    + ' FROM fins) AS f USING ("Customer_ID"))\n'
    + _spearman_sql("ranked", _RANKED),
    ["label_rows", "attrs", "fins"],
    _RANKED,
)
def _(spark, sf):
    from riskloom.operators.joins import lookup_join

    tables = [
        V.attrs(spark, sf).select("Customer_ID", "Age"),
        V.fins(spark, sf).select("Customer_ID", *_RANKED_FINANCIALS),
    ]
    return P.spearman_matrix(lookup_join(V.labels_silver(spark, sf), tables, "Customer_ID"), _RANKED)


_CLICK_MONTHS = range(1, 7)
_CLICK_RANKED = [*[f"click_{i}m" for i in _CLICK_MONTHS], "label"]


@query(
    "a9_spearman_clicks",
    _spearman_sql("labelled", _CLICK_RANKED).replace("SELECT 'click_1m'", """WITH labelled AS MATERIALIZED (
  SELECT label, click_1m, click_2m, click_3m, click_4m, click_5m, click_6m FROM label_rows LEFT JOIN (
    SELECT "Customer_ID" """ + "".join(
        f", min(fe_1) FILTER (datediff('month', snapshot_date, DATE '1998-06-01') = {i}) AS click_{i}m" for i in _CLICK_MONTHS
    ) + """ FROM clicks WHERE snapshot_date >= DATE '1997-12-01' AND snapshot_date < DATE '1998-06-01' GROUP BY 1) AS c
  USING ("Customer_ID"))
SELECT 'click_1m'""", 1),
    ["label_rows", "clicks"],
    _CLICK_RANKED,
)
def _(spark, sf):
    from riskloom.operators.features import clickstream_pivot
    from riskloom.operators.joins import lookup_join

    pivoted = clickstream_pivot(V.clicks(spark, sf), "1998-06-01", 6)
    return P.spearman_matrix(lookup_join(V.labels_silver(spark, sf), pivoted, "Customer_ID"), _CLICK_RANKED)


@query(
    "a10_score_stats",
    """SELECT snapshot_date, avg(model_predictions) AS mean, stddev_samp(model_predictions) AS std,
  min(model_predictions) AS min, max(model_predictions) AS max, count(*) AS "count" FROM scores GROUP BY 1""",
    ["scores"],
    ["mean", "std", "min", "max"],
)
def _(spark, sf):
    return P.score_stats(V.scores(spark, sf), "model_predictions", ["snapshot_date"])


@query(
    "a11_score_diagnostics",
    """SELECT snapshot_date, count(*) AS total_rows, count(DISTINCT model_predictions) AS unique_values,
  min(model_predictions) AS min, max(model_predictions) AS max, avg(model_predictions) AS mean,
  stddev_pop(model_predictions) AS std FROM scores GROUP BY 1""",
    ["scores"],
    ["min", "max", "mean", "std"],
)
def _(spark, sf):
    return P.score_diagnostics(V.scores(spark, sf), "model_predictions")


@query(
    "a11_constant_score_report",
    """SELECT c.*, baseline_std,
  CASE WHEN current_min = current_max AND baseline_std > 0.01 THEN 'All predictions identical' ELSE 'Predictions vary' END AS issue,
  CASE WHEN current_min = current_max AND baseline_std > 0.01 THEN 'CRITICAL' ELSE 'INFO' END AS severity,
  CASE WHEN current_min = current_max AND baseline_std > 0.01 THEN 'RETRAIN MODEL' ELSE 'NONE' END AS recommended_action
FROM (SELECT count(p) AS current_count, min(p) AS current_min, max(p) AS current_max
    FROM (SELECT model_predictions * 0 + 0.16442 AS p FROM scores) AS s) AS c,
  (SELECT stddev_pop(prediction) AS baseline_std FROM score_baseline) AS b""",
    ["scores", "score_baseline"],
    ["current_min", "current_max", "baseline_std"],
)
def _(spark, sf):
    frozen = V.scores(spark, sf).withColumn(
        "model_predictions", F.col("model_predictions") * 0 + F.lit(0.16442)
    )
    return P.constant_score_report(V.score_baseline(spark, sf), "prediction", frozen, "model_predictions")


@query(
    "a14_psi_summary",
    """WITH months AS (SELECT snapshot_date, avg(model_predictions) AS psi FROM scores GROUP BY 1)
SELECT count(*) AS months, avg(psi) AS mean, stddev_samp(psi) AS std, min(psi) AS min, max(psi) AS max FROM months""",
    ["scores"],
    ["mean", "std", "min", "max"],
)
def _(spark, sf):
    from riskloom.operators.decide import psi_summary

    rows = P.score_stats(V.scores(spark, sf), "model_predictions", ["snapshot_date"])
    return psi_summary(rows.select("snapshot_date", F.col("mean").alias("psi")))


_LEDGER_TYPES = {
    "loan_id": "string", "Customer_ID": "string", "loan_start_date": "date", "tenure": "int",
    "installment_num": "int", "loan_amt": "double", "due_amt": "double", "paid_amt": "double",
    "overdue_amt": "double", "balance": "double", "snapshot_date": "date",
}


@query(
    "a15_schema_profile",
    _union(
        f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count("{c}") AS non_null FROM ledger"""
        for c, t in _LEDGER_TYPES.items()
    ),
    ["ledger"],
)
def _(spark, sf):
    return P.schema_profile(V.ledger(spark, sf))


_KINDS = {
    "loan_id": "categorical", "loan_start_date": "categorical", "tenure": "numeric", "installment_num": "numeric",
    "loan_amt": "numeric", "due_amt": "numeric", "paid_amt": "numeric", "overdue_amt": "numeric", "balance": "numeric",
}


@query(
    "a16_classify_columns",
    _union(
        f"""SELECT '{c}' AS column_name, '{k}' AS kind, count("{c}") AS non_null FROM ledger"""
        for c, k in _KINDS.items()
    ),
    ["ledger"],
)
def _(spark, sf):
    rows = V.ledger(spark, sf)
    kinds = P.classify_columns(rows)
    out = None
    for kind, cols in kinds.items():
        one = P.schema_profile(rows.select(*cols)).select("column_name", F.lit(kind).alias("kind"), "non_null")
        out = one if out is None else out.unionAll(one)
    return out


_SHARES = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, CAST(i - 1 AS INTEGER) AS bin_id, count(*) AS n, count(*) / (SELECT count(*) FROM order_features) AS share
FROM order_features, (SELECT list_concat(['-Infinity'::DOUBLE], quantile_disc(CAST({c} AS DOUBLE),
    [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]), ['Infinity'::DOUBLE]) AS e FROM order_features WHERE snapshot_date < DATE '1996-01-01') AS q,
  (SELECT unnest(range(1, 11)) AS i) AS s
WHERE {c} > e[i] AND {c} <= e[i + 1] GROUP BY i"""
    for c in ("amount", "tier")
)


@query("a12_bin_frequency", _SHARES, ["order_features"], ["share"])
def _(spark, sf):
    rows = V.order_features(spark, sf)
    base = rows.where("snapshot_date < date'1996-01-01'")
    # Accuracy high enough to be exact on the test data.
    edges = D.psi_edges_quantile(base, ["amount", "tier"])
    return D.bin_frequency(rows, ["amount", "tier"], edges)


def top_k_sql(source: str, cols, k: int) -> str:
    return _union(
        f"""SELECT '{c}' AS feature, category, CAST(sum(n) AS BIGINT) AS n, sum(n) / max(total) AS share
FROM (SELECT CASE WHEN r <= {k} THEN category ELSE '__OTHER__' END AS category, n, total
  FROM (SELECT category, n, row_number() OVER (ORDER BY n DESC, category) AS r, sum(n) OVER () AS total
    FROM (SELECT COALESCE(CAST("{c}" AS VARCHAR), '__NULL__') AS category, count(*) AS n FROM {source} GROUP BY 1) AS g) AS o) AS p
GROUP BY category"""
        for c in cols
    )


@query("a13_top_k_categories", top_k_sql("order_features", ["priority", "branch"], 50), ["order_features"], ["share"])
def _(spark, sf):
    return D.top_k_categories(V.order_features(spark, sf), ["priority", "branch"])


ORDER_CODES = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"]


@query("a13_top_k_wide", top_k_sql("orders", ORDER_CODES, 50), [], ["share"])
def _(spark, sf):
    # From one value per row to three values in all.
    return D.top_k_categories(V.table(spark, sf, "orders"), ORDER_CODES, buckets=BUCKETS)


@query("a13_top_k_brands", top_k_sql("part", ["p_brand"], 20), [], ["share"])
def _(spark, sf):
    return D.top_k_categories(V.table(spark, sf, "part"), ["p_brand"], 20)
