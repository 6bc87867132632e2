"""D1..D23: population stability, alerts and retrain decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import decide as G
from riskloom.operators import drift as D
from riskloom.operators import sketches as S
from riskloom.plans.monitoring import decide_months, monitor_scores, read_decisions, store_decisions, wanted_months
from riskloom.session import scratch_dir, stored
from riskloom.sources import tables
from riskloom.streaming.monitoring import watch_scores
from riskloom.workload import views as V
from riskloom.workload.profiling import top_k_sql
from riskloom.workload.registry import query

TENTHS = "[" + ", ".join(f"{p!r}::DOUBLE" for p in D._tenths(10)) + "]"
INNER = "[" + ", ".join(f"{i / 10!r}::DOUBLE" for i in range(1, 10)) + "]"

# How a value falls into a bin (lo, hi, number i, last) under each definition.
INSIDE = {
    "right": "x.v > lo AND x.v <= hi",
    "lowest": "(x.v > lo OR (i = 1 AND x.v = lo)) AND x.v <= hi",
    "left": "x.v >= lo AND (x.v < hi OR (last AND x.v = hi))",
}


def long_sql(source: str, cols, keep: str = "", where: str = "true") -> str:
    keep = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {source} WHERE {where}" for c in cols
    )


def psi_sql(base: str, cur: str, edges: str, closed: str, share: str, term: str) -> str:
    """Common table expressions ending in ``psi(feature, snapshot_date, psi)``.

    ``share`` is a template over n (bin), s (rows in bins) and a (all rows).
    """
    ref_share = share.format(
        n="n", s="sum(n) OVER (PARTITION BY feature)", a="max(a) OVER (PARTITION BY feature)"
    )
    cur_share = share.format(
        n="n", s="sum(n) OVER (PARTITION BY feature, snapshot_date)",
        a="max(a) OVER (PARTITION BY feature, snapshot_date)",
    )
    return f"""base_long AS ({base}),
cur_long AS ({cur}),
edges AS (SELECT feature, {edges} AS e FROM base_long GROUP BY feature),
bins AS (SELECT feature, i, e[i] AS lo, e[i + 1] AS hi, i = len(e) - 1 AS last
  FROM edges, (SELECT unnest(range(1, 11)) AS i) AS steps WHERE i < len(e)),
ref_n AS (SELECT b.feature, b.i, count(x.v) AS n, (SELECT count(*) FROM base_long AS t WHERE t.feature = b.feature) AS a
  FROM bins AS b LEFT JOIN base_long AS x ON x.feature = b.feature AND {INSIDE[closed]} GROUP BY b.feature, b.i),
seen AS (SELECT feature, snapshot_date, count(*) AS a FROM cur_long GROUP BY 1, 2),
cur_n AS (SELECT s.feature, s.snapshot_date, b.i, count(x.v) AS n, max(s.a) AS a
  FROM seen AS s JOIN bins AS b ON s.feature = b.feature
  LEFT JOIN cur_long AS x ON x.feature = s.feature AND x.snapshot_date = s.snapshot_date AND {INSIDE[closed]} GROUP BY 1, 2, 3),
ref_p AS (SELECT feature, i, {ref_share} AS p FROM ref_n),
cur_p AS (SELECT feature, snapshot_date, i, {cur_share} AS p FROM cur_n),
psi AS (SELECT c.feature, c.snapshot_date, sum({term.format(c="c.p", r="r.p")}) AS psi
  FROM cur_p AS c JOIN ref_p AS r ON c.feature = r.feature AND c.i = r.i GROUP BY 1, 2)"""


PLAIN_TERM = "({c} - {r}) * ln({c} / {r})"
INF_TERM = "CASE WHEN {c} = 0 AND {r} = 0 THEN 0 WHEN {c} = 0 OR {r} = 0 THEN 'Infinity'::DOUBLE ELSE ({c} - {r}) * ln({c} / {r}) END"
EXACT_EDGES = f"list_sort(list_distinct(quantile_cont(v, {TENTHS})))"
SKETCH_EDGES = f"list_concat(['-Infinity'::DOUBLE], quantile_disc(v, {INNER}), ['Infinity'::DOUBLE])"
SHARE_A = "greatest({n} / {a}, 1e-12)"
SHARE_C = "COALESCE({n} / NULLIF({s}, 0), 1e-5)"
SHARE_D = "{n} / ({s} + 1e-9) + 1e-9"

KEYS = ["score", "util_rate", "age"]


def scheduled_sql(cols=KEYS, source="monitored") -> str:
    return psi_sql(
        long_sql(source, cols, "", "snapshot_date < DATE '1996-01-01'"),
        long_sql(source, cols, "snapshot_date"),
        EXACT_EDGES, "left", SHARE_D, PLAIN_TERM,
    )


PAYLOAD_CTE = f"""{scheduled_sql()},
payload AS (SELECT strftime(m.snapshot_date, '%Y-%m') AS month,
  CASE WHEN m.snapshot_date >= DATE '1996-01-01' AND s.snapshot_date IS NOT NULL THEN o.overall END AS overall,
  CASE WHEN m.snapshot_date < DATE '1996-01-01' THEN 'SKIPPED_NO_BASELINE'
    WHEN s.snapshot_date IS NULL THEN 'SKIPPED_NO_PREDICTION' ELSE 'OK' END AS status, m.snapshot_date
FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS snapshot_date) AS m
LEFT JOIN (SELECT DISTINCT snapshot_date FROM monitored) AS s ON s.snapshot_date = m.snapshot_date
LEFT JOIN (SELECT snapshot_date, max(psi) AS overall FROM psi GROUP BY 1) AS o ON o.snapshot_date = m.snapshot_date)"""
PAYLOAD_LONG = """payload_long AS (SELECT p.month, p.overall, p.snapshot_date, x.feature, x.psi FROM payload AS p
  JOIN psi AS x ON x.snapshot_date = p.snapshot_date WHERE p.status = 'OK')"""


def payloads(spark, sf):
    base, cur = V.monitored_baseline(spark, sf), V.monitored(spark, sf)
    months = tables.month_spine(spark, "1995-01-01", "2001-12-01")
    return D.monthly_psi(base, cur, months, "1996-01-01")


def trend(spark, sf, col="util_rate"):
    base, cur = V.monitored_baseline(spark, sf), V.monitored(spark, sf)
    return D.psi_trend(base, cur, col, col)


# --- edges, baseline, definitions A and B ---------------------------------------------------

FEATURE_CUR = "snapshot_date >= DATE '1996-01-01'"
FEATURE_BASE = "snapshot_date < DATE '1996-01-01'"


def _halves(spark, sf):
    rows = V.order_features(spark, sf)
    return rows.where(FEATURE_BASE.replace("DATE ", "date")), rows.where(FEATURE_CUR.replace("DATE ", "date"))


@query(
    "d1_psi_edges_quantile",
    f"""SELECT feature, i, e[i] AS edge FROM (SELECT feature, {SKETCH_EDGES} AS e FROM (
  {long_sql("order_features", ["amount", "tier"])}) AS l GROUP BY feature) AS q,
  (SELECT unnest(range(1, 12)) AS i) AS s""",
    ["order_features"],
)
def _(spark, sf):
    edges = D.psi_edges_quantile(V.order_features(spark, sf), ["amount", "tier"])
    return edges.select("feature", F.posexplode("edges").alias("i", "edge")).select(
        "feature", (F.col("i") + 1).cast("bigint").alias("i"), "edge"
    )


_WINDOWS = [("early", "1992-01-01", "1995-12-01"), ("middle", "1996-01-01", "1997-12-01"), ("all", "1992-01-01", "2010-12-01")]


@query(
    "d1_window_edges_from_sketches",
    "\nUNION ALL\n".join(
        f"""SELECT '{w}' AS "window", feature, n, CAST(i AS BIGINT) AS i, e[i] AS edge FROM (
  SELECT feature, count(v) AS n, quantile_disc(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM (
    {long_sql("order_features", ["amount", "tier"], "", f"snapshot_date BETWEEN DATE '{lo}' AND DATE '{hi}'")}) AS l
  WHERE v IS NOT NULL GROUP BY feature) AS q, (SELECT unnest(range(1, 10)) AS i) AS s"""
        for w, lo, hi in _WINDOWS
    ),
    ["order_features"],
)
def _(spark, sf):
    rows, cols = V.order_features(spark, sf), ["amount", "tier"]
    path = scratch_dir(spark, "month-sketches")
    S.store_sketches(S.quantile_sketches(rows, cols), path)
    windows = spark.createDataFrame(_WINDOWS, "window string, lo string, hi string").select(
        "window", F.col("lo").cast("date").alias("lo"), F.col("hi").cast("date").alias("hi")
    )
    found = S.window_quantiles(rows, spark.read.parquet(path), windows, cols, [i / 10 for i in range(1, 10)])
    return found.select("window", "feature", "n", F.posexplode("quantiles").alias("i", "edge")).withColumn(
        "i", (F.col("i") + 1).cast("bigint")
    )


NUMERIC_A = psi_sql(
    long_sql("order_features", ["amount", "tier"], "", FEATURE_BASE),
    long_sql("order_features", ["amount", "tier"], "snapshot_date", FEATURE_CUR),
    SKETCH_EDGES, "right", SHARE_A, PLAIN_TERM,
)

CATEGORIES = ["priority", "branch"]


def _categorical_cte() -> str:
    base = top_k_sql("base_rows", CATEGORIES, 50)
    cur = " UNION ALL ".join(
        f"SELECT snapshot_date, '{c}' AS feature, COALESCE({c}, '__NULL__') AS category FROM order_features WHERE {FEATURE_CUR}"
        for c in CATEGORIES
    )
    return f"""base_rows AS (SELECT * FROM order_features WHERE {FEATURE_BASE}),
cat_ref AS ({base}),
cat_cur AS (SELECT snapshot_date, x.feature, CASE WHEN r.category IS NULL THEN '__OTHER__' ELSE x.category END AS category, count(*) AS n
  FROM ({cur}) AS x LEFT JOIN cat_ref AS r ON r.feature = x.feature AND r.category = x.category GROUP BY 1, 2, 3),
cat_all AS (SELECT snapshot_date, feature, sum(n) AS a FROM cat_cur GROUP BY 1, 2),
cat_p AS (SELECT a.snapshot_date, r.feature, greatest(r.share, 1e-12) AS r, greatest(COALESCE(c.n, 0) / a.a, 1e-12) AS c
  FROM cat_ref AS r JOIN cat_all AS a ON a.feature = r.feature
  LEFT JOIN cat_cur AS c ON c.feature = r.feature AND c.category = r.category AND c.snapshot_date = a.snapshot_date),
cat_psi AS (SELECT feature, snapshot_date, sum((c - r) * ln(c / r)) AS psi FROM cat_p GROUP BY 1, 2)"""


CATEGORICAL_B = _categorical_cte()


@query(
    "d2_psi_baseline",
    f"""WITH {NUMERIC_A}, {CATEGORICAL_B}
SELECT 'credit_model' AS model_name, DATE '1995-12-01' AS baseline_snapshot, feature, 'numeric' AS value_type,
  CAST(i - 1 AS INTEGER) AS bin_id, lo, hi, CAST(NULL AS VARCHAR) AS category, n / a AS p_ref FROM ref_n JOIN bins USING (feature, i)
UNION ALL SELECT 'credit_model', DATE '1995-12-01', feature, 'categorical', NULL, NULL, NULL, category, share FROM cat_ref""",
    ["order_features"],
    ["p_ref"],
)
def baseline(spark, sf):
    base, _ = _halves(spark, sf)
    return D.psi_baseline(base, "credit_model", "1995-12-01")


@query("d3_psi_numeric", f"WITH {NUMERIC_A} SELECT snapshot_date, feature, psi FROM psi", ["order_features"], ["psi"])
def _(spark, sf):
    _, cur = _halves(spark, sf)
    return D.psi_numeric(cur, baseline(spark, sf), ["amount", "tier"], ["snapshot_date"])


@query(
    "d4_psi_categorical", f"WITH {CATEGORICAL_B} SELECT snapshot_date, feature, psi FROM cat_psi", ["order_features"], ["psi"]
)
def _(spark, sf):
    _, cur = _halves(spark, sf)
    return D.psi_categorical(cur, baseline(spark, sf), CATEGORIES, ["snapshot_date"])


GRADE = "CASE WHEN psi < 0.1 THEN 'low' WHEN psi < 0.25 THEN 'medium' WHEN psi IS NOT NULL THEN 'high' END"
LEVEL = "CASE WHEN psi < 0.1 THEN 'GREEN' WHEN psi < 0.25 THEN 'YELLOW' WHEN psi IS NOT NULL THEN 'RED' END"

FEATURE_PSI = f"""WITH {NUMERIC_A}, {CATEGORICAL_B}
SELECT 'credit_model' AS model_name, '1995-12-01' AS baseline_snapshot, strftime(snapshot_date, '%Y-%m-%d') AS current_snapshot,
  feature, value_type, psi, {GRADE} AS psi_grade
FROM (SELECT feature, snapshot_date, 'numeric' AS value_type, psi FROM psi
  UNION ALL SELECT feature, snapshot_date, 'categorical', psi FROM cat_psi) AS u"""


@query("d5_feature_psi", FEATURE_PSI, ["order_features"], ["psi"])
def _(spark, sf):
    _, cur = _halves(spark, sf)
    return D.feature_psi(cur, baseline(spark, sf), "credit_model", "1995-12-01")


# --- score PSI ------------------------------------------------------------------------------

PREDICTION_C = psi_sql(
    long_sql("monitored", KEYS, "", FEATURE_BASE),
    long_sql("monitored", KEYS, "snapshot_date", FEATURE_CUR),
    EXACT_EDGES, "lowest", SHARE_C, INF_TERM,
)


def _monitored_halves(spark, sf):
    return V.monitored_baseline(spark, sf), V.monitored(spark, sf).where(FEATURE_CUR.replace("DATE ", "date"))


@query("d6_psi_prediction", f"WITH {PREDICTION_C} SELECT snapshot_date, feature, psi FROM psi", ["monitored"], ["psi"])
def _(spark, sf):
    base, cur = _monitored_halves(spark, sf)
    return D.psi_prediction(base, cur, KEYS, ["snapshot_date"])


@query(
    "d7_psi_scheduled", f"WITH {scheduled_sql()} SELECT snapshot_date, feature, psi FROM psi", ["monitored"], ["psi"]
)
def _(spark, sf):
    base, cur = V.monitored_baseline(spark, sf), V.monitored(spark, sf)
    return D.psi_scheduled(base, cur, KEYS, ["snapshot_date"])


def equal_width_sql(base: str, cur: str) -> str:
    """``psi(feature, snapshot_date, psi)`` on equal-width bins of each joint range."""
    return f"""base_long AS ({base}),
cur_long AS ({cur}),
spans AS (SELECT c.feature, c.snapshot_date, least(c.lo, b.lo) AS lo, greatest(c.hi, b.hi) AS hi
  FROM (SELECT feature, snapshot_date, min(v) AS lo, max(v) AS hi FROM cur_long GROUP BY 1, 2) AS c
  JOIN (SELECT feature, min(v) AS lo, max(v) AS hi FROM base_long GROUP BY 1) AS b ON b.feature = c.feature),
bins AS (SELECT feature, snapshot_date, i, i = 9 AS last, i * ((hi - lo) / 10) + lo AS lo,
    CASE WHEN i = 9 THEN hi ELSE (i + 1) * ((hi - lo) / 10) + lo END AS hi
  FROM spans, (SELECT unnest(range(0, 10)) AS i) AS steps),
ref_n AS (SELECT b.feature, b.snapshot_date, b.i, count(x.v) AS n FROM bins AS b
  LEFT JOIN base_long AS x ON x.feature = b.feature AND {INSIDE["left"]} GROUP BY 1, 2, 3),
cur_n AS (SELECT b.feature, b.snapshot_date, b.i, count(x.v) AS n FROM bins AS b
  LEFT JOIN cur_long AS x ON x.feature = b.feature AND x.snapshot_date = b.snapshot_date AND {INSIDE["left"]} GROUP BY 1, 2, 3),
shares AS (SELECT r.feature, r.snapshot_date, r.i,
    CASE WHEN r.n = 0 THEN 1e-6 ELSE r.n / sum(r.n) OVER w END AS r,
    CASE WHEN c.n = 0 THEN 1e-6 ELSE c.n / sum(c.n) OVER w END AS c
  FROM ref_n AS r JOIN cur_n AS c ON c.feature = r.feature AND c.snapshot_date = r.snapshot_date AND c.i = r.i
  WINDOW w AS (PARTITION BY r.feature, r.snapshot_date)),
psi AS (SELECT feature, snapshot_date, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY 1, 2)"""


@query(
    "d8_psi_equal_width",
    f"""WITH {equal_width_sql(long_sql("monitored", KEYS, "", FEATURE_BASE),
                              long_sql("monitored", KEYS, "DATE '2000-01-01' AS snapshot_date", FEATURE_CUR))}
SELECT feature, psi FROM psi""",
    ["monitored"],
    ["psi"],
)
def _(spark, sf):
    base, cur = _monitored_halves(spark, sf)
    return D.psi_equal_width(base, cur, KEYS)


_STATS = """avg({0}) AS {1}_mean, stddev_samp({0}) AS {1}_std, min({0}) AS {1}_min, max({0}) AS {1}_max, count(*) AS {1}_count"""
DRIFT_SQL = f"""WITH {PREDICTION_C},
now AS (SELECT snapshot_date, {_STATS.format("util_rate", "current")} FROM monitored WHERE {FEATURE_CUR} GROUP BY 1),
past AS (SELECT {_STATS.format("util_rate", "baseline")} FROM monitored WHERE {FEATURE_BASE}),
drift AS (SELECT 'credit_model' AS model_name, p.snapshot_date, psi, {LEVEL} AS alert_level, past.*, now.* EXCLUDE (snapshot_date)
  FROM psi AS p JOIN now ON now.snapshot_date = p.snapshot_date, past WHERE p.feature = 'util_rate')"""
DRIFT_DOUBLES = ["psi", *[f"{side}_{n}" for side in ("baseline", "current") for n in ("mean", "std", "min", "max")]]


@query(
    "d10_monthly_psi_prediction",
    f"""WITH {scheduled_sql(["util_rate"])}
SELECT strftime(snapshot_date, '%Y-%m') AS month, psi AS overall, psi AS psi_prediction, 'OK' AS status FROM psi""",
    ["monitored"],
    ["overall", "psi_prediction"],
)
def _(spark, sf):
    # The names that training and scoring write: compared under one name.
    base = V.monitored_baseline(spark, sf).select(F.col("util_rate").alias("prediction"))
    scores = V.monitored(spark, sf).select(F.col("util_rate").alias(" model_predictions "), "snapshot_date")
    found = D.monthly_psi(base, scores, scores.select("snapshot_date").distinct())
    return found.select("month", "overall", F.try_element_at("psi", F.lit("prediction")).alias("psi_prediction"), "status")


@query("d9_prediction_drift", f"{DRIFT_SQL} SELECT * FROM drift", ["monitored"], DRIFT_DOUBLES)
def _(spark, sf):
    base, cur = _monitored_halves(spark, sf)
    return D.prediction_drift(base, cur, "credit_model", "util_rate", "util_rate", ["snapshot_date"])


@query(
    "d10_monthly_psi",
    f"""WITH {PAYLOAD_CTE}
SELECT month, overall, status, max(x.psi) FILTER (x.feature = 'score') AS psi_score,
  max(x.psi) FILTER (x.feature = 'util_rate') AS psi_util_rate, max(x.psi) FILTER (x.feature = 'age') AS psi_age
FROM payload AS p LEFT JOIN psi AS x ON x.snapshot_date = p.snapshot_date AND p.status = 'OK' GROUP BY month, overall, status""",
    ["monitored"],
    ["overall", "psi_score", "psi_util_rate", "psi_age"],
)
def _(spark, sf):
    found = payloads(spark, sf)
    return found.select(
        "month", "overall", "status", *[F.try_element_at("psi", F.lit(c)).alias(f"psi_{c}") for c in KEYS]
    )


TREND_SQL = f"""WITH {equal_width_sql(long_sql("monitored", ["util_rate"], "", FEATURE_BASE),
                                      long_sql("monitored", ["util_rate"], "snapshot_date"))},
trend AS (SELECT p.snapshot_date, psi, s."count", s.mean, s.std, {LEVEL} AS status FROM psi AS p JOIN (
  SELECT snapshot_date, count(util_rate) AS "count", avg(util_rate) AS mean, stddev_pop(util_rate) AS std
  FROM monitored GROUP BY 1) AS s ON s.snapshot_date = p.snapshot_date)"""


@query("d11_psi_trend", f"{TREND_SQL} SELECT * FROM trend", ["monitored"], ["psi", "mean", "std"])
def _(spark, sf):
    return trend(spark, sf)


@query(
    "d12_grade_psi",
    f"{TREND_SQL} SELECT snapshot_date, psi, {GRADE} AS psi_grade, {LEVEL} AS alert_level FROM trend",
    ["monitored"],
    ["psi"],
)
def _(spark, sf):
    return G.grade_psi(trend(spark, sf).select("snapshot_date", "psi"))


NOW = "2002-01-01 06:00:00"
ALERT_COLUMNS = f"""{LEVEL} AS alert_level,
  CASE {LEVEL} WHEN 'GREEN' THEN 'PASS' WHEN 'YELLOW' THEN 'WARNING' WHEN 'RED' THEN 'CRITICAL' END AS status,
  CASE {LEVEL} WHEN 'GREEN' THEN 'CONTINUE' WHEN 'YELLOW' THEN 'MONITOR' WHEN 'RED' THEN 'RETRAIN' END AS action,
  CASE {LEVEL} WHEN 'GREEN' THEN 'Model is running normally. PSI=' || printf('%.6f', psi)
    WHEN 'YELLOW' THEN 'Minor drift detected. PSI=' || printf('%.6f', psi) || ', please monitor closely'
    WHEN 'RED' THEN 'Significant drift detected. PSI=' || printf('%.6f', psi) || ', recommend immediate retraining' END AS message,
  {LEVEL} <> 'GREEN' AS notify, '{NOW}' AS timestamp"""


@query(
    "d13_alert_records",
    f"{TREND_SQL} SELECT snapshot_date, psi, {ALERT_COLUMNS} FROM trend",
    ["monitored"],
    ["psi"],
)
def _(spark, sf):
    alerts = G.alert_records(trend(spark, sf).select("snapshot_date", "psi"), now=NOW)
    return alerts.withColumn("timestamp", F.col("timestamp").cast("string"))


@query(
    "d14_alert_records_detailed",
    f"""{TREND_SQL} SELECT snapshot_date, psi, status,
  CASE status WHEN 'GREEN' THEN 'INFO' WHEN 'YELLOW' THEN 'WARNING' ELSE 'CRITICAL' END AS severity,
  CASE status WHEN 'GREEN' THEN '' WHEN 'YELLOW' THEN 'team@example.org' ELSE 'team@example.org,ops@example.org' END AS recipients,
  CASE status WHEN 'GREEN' THEN '' WHEN 'YELLOW' THEN 'email' ELSE 'email,slack' END AS channels,
  CASE status WHEN 'GREEN' THEN 'OK: PSI stable (PSI=' || printf('%.4f', psi) || '). No action needed.'
    WHEN 'YELLOW' THEN 'WARNING: PSI shows moderate drift (PSI=' || printf('%.4f', psi) || '). Monitor next month.'
    ELSE 'URGENT: PSI detected significant drift (PSI=' || printf('%.4f', psi) || '). Triggering model retraining.' END AS message,
  CASE status WHEN 'GREEN' THEN 'CONTINUE' WHEN 'YELLOW' THEN 'MONITOR' ELSE 'RETRAIN_NOW' END AS recommended_action,
  '{NOW}' AS timestamp, snapshot_date AS monitoring_date, 'credit_model' AS model_name,
  0.1::DOUBLE AS threshold_moderate, 0.25::DOUBLE AS threshold_significant
FROM trend""",
    ["monitored"],
    ["psi"],
)
def _(spark, sf):
    rows = trend(spark, sf).select("snapshot_date", "psi")
    alerts = G.alert_records_detailed(
        rows, ["team@example.org"], ["ops@example.org"], now=NOW,
        monitoring_date=F.col("snapshot_date"), model_name="credit_model",
    )
    listed = {c: F.concat_ws(",", c) for c in ("recipients", "channels")}
    return alerts.withColumns({**listed, "timestamp": F.col("timestamp").cast("string")})


@query(
    "d15_route_status",
    f"""{TREND_SQL} SELECT snapshot_date, status,
  CASE status WHEN 'RED' THEN 'trigger_retrain' WHEN 'YELLOW' THEN 'send_alert' ELSE 'continue' END AS branch FROM trend""",
    ["monitored"],
)
def _(spark, sf):
    return G.route_status(trend(spark, sf).select("snapshot_date", "status"))


DECISION_CTE = f"""{PAYLOAD_CTE},
decision AS (SELECT p.month, p.overall, p.status,
    CAST(count(x.psi) FILTER (x.psi >= 0.2) AS INTEGER) AS key_columns_high,
    p.status NOT LIKE 'SKIPPED%' AND (COALESCE(p.overall, 0) >= 0.25 OR count(x.psi) FILTER (x.psi >= 0.2) >= 2) AS wants_retrain
  FROM payload AS p LEFT JOIN psi AS x ON x.snapshot_date = p.snapshot_date AND p.status = 'OK'
  GROUP BY p.month, p.overall, p.status)"""


@query("d16_retrain_decision", f"WITH {DECISION_CTE} SELECT * FROM decision", ["monitored"], ["overall"])
def _(spark, sf):
    return G.retrain_decision(payloads(spark, sf)).drop("psi")


@query(
    "d17_cooldown",
    f"""WITH RECURSIVE {DECISION_CTE},
wanted AS (SELECT strptime(month, '%Y-%m')::DATE AS day FROM decision WHERE wants_retrain),
ran AS (SELECT min(day) AS day FROM wanted
  UNION ALL SELECT (SELECT min(w.day) FROM wanted AS w WHERE w.day >= r.day + 100) FROM ran AS r
    WHERE EXISTS (SELECT 1 FROM wanted AS w WHERE w.day >= r.day + 100))
SELECT 'credit_model' AS model_name, strptime(month, '%Y-%m')::DATE AS decided_on, wants_retrain,
  CASE WHEN wants_retrain AND strptime(month, '%Y-%m')::DATE IN (SELECT day FROM ran) THEN 'retrain_model' ELSE 'skip_retrain' END AS branch
FROM decision""",
    ["monitored"],
)
def _(spark, sf):
    # A window longer than a month, so that months are really suppressed.
    decided = G.retrain_decision(payloads(spark, sf)).select(
        F.lit("credit_model").alias("model_name"),
        F.to_date("month", "yyyy-MM").alias("decided_on"),
        "wants_retrain",
    )
    return G.cooldown(decided, days=100)


@query(
    "d17_cooldown_stored",
    f"""WITH RECURSIVE {DECISION_CTE},
wanted AS (SELECT strptime(month, '%Y-%m')::DATE AS day FROM decision WHERE wants_retrain),
held AS (SELECT min(day) + 100 AS until FROM wanted),
ran AS (SELECT min(day) AS day FROM wanted WHERE day >= (SELECT until FROM held)
  UNION ALL SELECT (SELECT min(w.day) FROM wanted AS w WHERE w.day >= r.day + 14) FROM ran AS r
    WHERE EXISTS (SELECT 1 FROM wanted AS w WHERE w.day >= r.day + 14))
SELECT 'credit_model' AS model_name, strptime(month, '%Y-%m')::DATE AS decided_on, wants_retrain,
  CASE WHEN wants_retrain AND strptime(month, '%Y-%m')::DATE IN (SELECT day FROM ran) THEN 'retrain_model' ELSE 'skip_retrain' END AS branch
FROM decision""",
    ["monitored"],
)
def _(spark, sf):
    # The first wanted retrain ran earlier and its state, stored for 100 days, holds the next ones back.
    decided = stored(
        G.retrain_decision(payloads(spark, sf)).select(
            F.lit("credit_model").alias("model_name"), F.to_date("month", "yyyy-MM").alias("decided_on"), "wants_retrain"
        ),
        "decisions",
    )
    first = decided.where("wants_retrain").groupBy("model_name").agg(F.min("decided_on").alias("decided_on"))
    earlier = G.cooldown_state(first.withColumn("branch", F.lit("retrain_model")), days=100)
    return G.cooldown(decided, state=stored(earlier, "cooldown"))


@query(
    "d17_cooldown_state",
    f"""WITH {DECISION_CTE}
SELECT 'credit_model' AS model_name, max(strptime(month, '%Y-%m')::DATE) + 14 AS cooldown_until FROM decision WHERE wants_retrain
HAVING count(*) > 0""",
    ["monitored"],
)
def _(spark, sf):
    base, cur = V.monitored_baseline(spark, sf), V.monitored(spark, sf)
    months = tables.month_spine(spark, "1995-01-01", "2001-12-01")
    return G.cooldown_state(decide_months(base, cur, months, "credit_model", "1996-01-01"))


@query(
    "d17_decisions_by_run",
    f"""WITH RECURSIVE {DECISION_CTE},
wanted AS (SELECT strptime(month, '%Y-%m')::DATE AS day FROM decision WHERE wants_retrain),
ran AS (SELECT min(day) AS day FROM wanted
  UNION ALL SELECT (SELECT min(w.day) FROM wanted AS w WHERE w.day >= r.day + 100) FROM ran AS r
    WHERE EXISTS (SELECT 1 FROM wanted AS w WHERE w.day >= r.day + 100))
SELECT 'credit_model' AS model_name, month, overall, status, key_columns_high, wants_retrain,
  CASE WHEN wants_retrain AND strptime(month, '%Y-%m')::DATE IN (SELECT day FROM ran) THEN 'retrain_model' ELSE 'skip_retrain' END AS branch
FROM decision""",
    ["monitored"],
    ["overall"],
)
def _(spark, sf):
    # Three runs, the months of the last one first and some of them twice: the decisions of one run over all months.
    wanted = stored(
        wanted_months(
            V.monitored_baseline(spark, sf), V.monitored(spark, sf),
            tables.month_spine(spark, "1995-01-01", "2001-12-01"), "credit_model", "1996-01-01",
        ),
        "wanted",
    )
    path = scratch_dir(spark, "decisions")
    for run in ("month >= '1999-06'", "month < '1997-03'", "month >= '1997-03' AND month < '2000-01'"):
        store_decisions(wanted.where(run), path, days=100, token=run)
    return read_decisions(spark, path).drop("decided_on", "psi")


@query(
    "d10_watched_scores",
    f"""WITH RECURSIVE {DECISION_CTE},
wanted AS (SELECT strptime(month, '%Y-%m')::DATE AS day FROM decision WHERE wants_retrain),
ran AS (SELECT min(day) AS day FROM wanted
  UNION ALL SELECT (SELECT min(w.day) FROM wanted AS w WHERE w.day >= r.day + 100) FROM ran AS r
    WHERE EXISTS (SELECT 1 FROM wanted AS w WHERE w.day >= r.day + 100))
SELECT month, overall, key_columns_high, wants_retrain,
  CASE WHEN wants_retrain AND strptime(month, '%Y-%m')::DATE IN (SELECT day FROM ran) THEN 'retrain_model' ELSE 'skip_retrain' END AS branch
FROM decision WHERE status = 'OK'""",
    ["monitored"],
    ["overall"],
)
def _(spark, sf):
    # The scores arrive as files of a stream, two at a time; every month is spread over all files.
    scores = V.monitored(spark, sf).where(F.col("snapshot_date") >= F.lit("1996-01-01").cast("date"))
    arriving, root = scratch_dir(spark, "arriving"), scratch_dir(spark, "watched")
    scores.repartition(4, "Customer_ID").write.parquet(arriving)
    stream = spark.readStream.schema(scores.schema).option("maxFilesPerTrigger", 2).parquet(arriving)
    watch_scores(
        stream, V.monitored_baseline(spark, sf), root, scratch_dir(spark, "progress"), "credit_model", "1996-01-01", days=100
    )
    found = read_decisions(spark, f"{root}/decisions")
    return found.select("month", "overall", "key_columns_high", "wants_retrain", "branch")


@query(
    "d18_monitor_scores",
    f"{DRIFT_SQL} SELECT * EXCLUDE (alert_level), {ALERT_COLUMNS} FROM drift",
    ["monitored"],
    DRIFT_DOUBLES,
)
def _(spark, sf):
    base, cur = _monitored_halves(spark, sf)
    base = base.select(F.col("util_rate").alias("prediction"))
    cur = cur.select("snapshot_date", F.col("util_rate").alias("model_predictions"))
    found = monitor_scores(base, cur, "credit_model", ["snapshot_date"], now=NOW)
    return found.withColumn("timestamp", F.col("timestamp").cast("string"))


@query(
    "d19_psi_dashboard_trend",
    f"""WITH {PAYLOAD_CTE} SELECT month, strptime(month, '%Y-%m')::DATE AS month_dt, overall AS overall_psi,
  0.1::DOUBLE AS moderate_threshold, 0.25::DOUBLE AS significant_threshold FROM payload WHERE status = 'OK'""",
    ["monitored"],
    ["overall_psi"],
)
def _(spark, sf):
    return G.psi_dashboard_trend(payloads(spark, sf))


@query(
    "d20_feature_psi_latest",
    f"""WITH {PAYLOAD_CTE}, {PAYLOAD_LONG}
SELECT feature AS "Feature", psi AS "PSI" FROM payload_long WHERE month = (SELECT max(month) FROM payload_long)""",
    ["monitored"],
    ["PSI"],
)
def _(spark, sf):
    return G.feature_psi_latest(payloads(spark, sf))


MATRIX_MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13)]


@query(
    "d21_psi_matrix",
    f"""WITH {PAYLOAD_CTE}, {PAYLOAD_LONG}
SELECT feature, {", ".join(f"max(psi) FILTER (month = '{m}') AS {chr(34)}{m}{chr(34)}" for m in MATRIX_MONTHS)}
FROM payload_long GROUP BY feature""",
    ["monitored"],
    MATRIX_MONTHS,
)
def _(spark, sf):
    return G.psi_matrix(payloads(spark, sf), MATRIX_MONTHS)


@query(
    "d22_generic_column_psi",
    f"""WITH {equal_width_sql(long_sql("order_features", ["amount", "tier"], "", FEATURE_BASE),
                              long_sql("order_features", ["amount", "tier"], "DATE '2000-01-01' AS snapshot_date", FEATURE_CUR))},
{CATEGORICAL_B.replace("SELECT snapshot_date, 'priority'", "SELECT DATE '2000-01-01' AS snapshot_date, 'priority'").replace(
    "SELECT snapshot_date, 'branch'", "SELECT DATE '2000-01-01' AS snapshot_date, 'branch'")}
SELECT feature, psi, type, {LEVEL} AS status
FROM (SELECT feature, psi, 'numeric' AS type FROM psi UNION ALL SELECT feature, psi, 'categorical' FROM cat_psi) AS u""",
    ["order_features"],
    ["psi"],
)
def _(spark, sf):
    base, cur = _halves(spark, sf)
    return D.generic_column_psi(base.drop("snapshot_date"), cur.drop("snapshot_date"))


@query(
    "d23_alert_policy",
    f"""{TREND_SQL} SELECT snapshot_date, psi, level, psi_min, psi_max, policy_status, policy_action, escalation,
  CASE level WHEN 'yellow' THEN 'team@example.org' WHEN 'red' THEN 'team@example.org,ops@example.org' ELSE '' END AS recipients
FROM trend LEFT JOIN (VALUES ('green', 0::DOUBLE, 0.1::DOUBLE, 'HEALTHY', 'continue_operation', NULL),
  ('yellow', 0.1::DOUBLE, 0.25::DOUBLE, 'WARNING', 'monitor_closely', 'notify_team_within_1_hour'),
  ('red', 0.25::DOUBLE, 'Infinity'::DOUBLE, 'CRITICAL', 'trigger_retrain', 'immediate_escalation_and_retrain'))
  AS policy(level, psi_min, psi_max, policy_status, policy_action, escalation) ON psi >= psi_min AND psi < psi_max""",
    ["monitored"],
    ["psi"],
)
def _(spark, sf):
    rows = trend(spark, sf).select("snapshot_date", "psi")
    sent = G.apply_policy(rows, team=["team@example.org"], escalation=["ops@example.org"])
    return sent.withColumn("recipients", F.concat_ws(",", "recipients"))


@query(
    "a14_psi_status_breakdown",
    f"{TREND_SQL} SELECT status, count(*) AS months FROM trend GROUP BY status",
    ["monitored"],
)
def _(spark, sf):
    return G.status_breakdown(trend(spark, sf))


@query(
    "a14_psi_trend_summary",
    f"{TREND_SQL} SELECT count(*) AS months, avg(psi) AS mean, stddev_samp(psi) AS std, min(psi) AS min, max(psi) AS max FROM trend",
    ["monitored"],
    ["mean", "std", "min", "max"],
)
def _(spark, sf):
    return G.psi_summary(trend(spark, sf))
