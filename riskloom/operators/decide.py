"""Alerts, retrain decisions and dashboard tables. Inputs hold one row per month or feature."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions import psi as X
from riskloom.sources.payloads import ok_payloads

# Decision thresholds.
OVERALL_THRESHOLD = 0.25
KEY_THRESHOLD = 0.20
KEY_MIN_COUNT = 2
COOLDOWN_DAYS = 14
# The alert policy, one entry per level.
POLICY = [
    ("green", 0.0, 0.1, "HEALTHY", "continue_operation", None),
    ("yellow", 0.1, 0.25, "WARNING", "monitor_closely", "notify_team_within_1_hour"),
    ("red", 0.25, float("inf"), "CRITICAL", "trigger_retrain", "immediate_escalation_and_retrain"),
]


def _by_level(level: Column, green, yellow, red) -> Column:
    values = [v if isinstance(v, Column) else F.lit(v) for v in (green, yellow, red)]
    return (
        F.when(level == "GREEN", values[0]).when(level == "YELLOW", values[1]).when(level == "RED", values[2])
    )


def fixed(c: Column, digits: int) -> Column:
    """Number as text with ``digits`` decimals; infinite and undefined as inf and nan."""
    return (
        F.when(F.isnan(c), "nan")
        .when(c == float("inf"), "inf")
        .otherwise(F.format_string(f"%.{digits}f", c))
    )


def grade_psi(df: DataFrame, psi: str = "psi") -> DataFrame:
    return df.withColumns(
        {"psi_grade": X.grade(F.col(psi)), "alert_level": X.alert_level(F.col(psi))}
    )


def _at(now: Column | str | None) -> Column:
    """Time of a record: an argument, so that a rerun writes the same."""
    return (F.lit(now) if not isinstance(now, Column) else now).cast("timestamp")


def alert_records(df: DataFrame, psi: str = "psi", now: Column | str | None = None) -> DataFrame:
    """Alert of each row: level, status, action, message with six decimals, notify flag, time."""
    level = X.alert_level(F.col(psi))
    text = F.concat(F.lit("PSI="), fixed(F.col(psi), 6))
    # The texts of the messages.
    message = _by_level(
        level,
        F.concat(F.lit("Model is running normally. "), text),
        F.concat(F.lit("Minor drift detected. "), text, F.lit(", please monitor closely")),
        F.concat(F.lit("Significant drift detected. "), text, F.lit(", recommend immediate retraining")),
    )
    return df.withColumns(
        {
            "alert_level": level,
            "status": _by_level(level, "PASS", "WARNING", "CRITICAL"),
            "action": _by_level(level, "CONTINUE", "MONITOR", "RETRAIN"),
            "message": message,
            "notify": level != "GREEN",
            "timestamp": _at(now),
        }
    )


def alert_records_detailed(
    df: DataFrame,
    team: Sequence[str],
    escalation: Sequence[str],
    psi: str = "psi",
    now: Column | str | None = None,
    monitoring_date: Column | None = None,
    model_name: str | None = None,
) -> DataFrame:
    """Alerts with recipients and channels: a warning goes to ``team`` by e-mail, a critical
    one also to ``escalation`` and to chat. Each names its time, date, model and thresholds."""
    level = X.alert_level(F.col(psi))
    nobody = F.array().cast("array<string>")
    team_list = F.array(*[F.lit(x) for x in team])
    everyone = F.array(*[F.lit(x) for x in [*team, *escalation]])
    text = F.concat(F.lit("(PSI="), fixed(F.col(psi), 4), F.lit(")"))
    # The texts of the messages.
    message = _by_level(
        level,
        F.concat(F.lit("OK: PSI stable "), text, F.lit(". No action needed.")),
        F.concat(F.lit("WARNING: PSI shows moderate drift "), text, F.lit(". Monitor next month.")),
        F.concat(
            F.lit("URGENT: PSI detected significant drift "), text, F.lit(". Triggering model retraining.")
        ),
    )
    return df.withColumns(
        {
            "status": level,
            "severity": _by_level(level, "INFO", "WARNING", "CRITICAL"),
            "recipients": _by_level(level, nobody, team_list, everyone),
            "channels": _by_level(
                level, nobody, F.array(F.lit("email")), F.array(F.lit("email"), F.lit("slack"))
            ),
            "message": message,
            "recommended_action": _by_level(level, "CONTINUE", "MONITOR", "RETRAIN_NOW"),
            "timestamp": _at(now),
            "monitoring_date": (F.lit(None) if monitoring_date is None else monitoring_date).cast("date"),
            "model_name": F.lit(model_name).cast("string"),
            "threshold_moderate": F.lit(X.LOW),
            "threshold_significant": F.lit(X.HIGH),
        }
    )


def route_status(df: DataFrame, status: str = "status") -> DataFrame:
    branch = F.when(F.col(status) == "RED", "trigger_retrain").when(
        F.col(status) == "YELLOW", "send_alert"
    )
    return df.withColumn("branch", branch.otherwise("continue"))


def retrain_decision(
    payloads: DataFrame,
    overall_threshold: float = OVERALL_THRESHOLD,
    key_threshold: float = KEY_THRESHOLD,
    key_min: int = KEY_MIN_COUNT,
) -> DataFrame:
    """Payloads with ``wants_retrain``: overall index too high, or enough columns too high.

    Skipped months and missing or NaN indices never ask for a retrain.
    """
    nan = F.lit(float("nan"))
    overall = F.coalesce(F.nullif(F.col("overall"), nan), F.lit(0.0))
    values = F.coalesce(F.map_values("psi"), F.array().cast("array<double>"))
    high = F.size(F.filter(values, lambda v: F.coalesce(F.nullif(v, nan), F.lit(0.0)) >= key_threshold))
    drifted = (overall >= overall_threshold) | (high >= key_min)
    computed = ~F.coalesce(F.col("status"), F.lit("")).startswith("SKIPPED")
    return payloads.withColumns(
        {"key_columns_high": high, "wants_retrain": computed & drifted}
    )


def cooldown(
    decisions: DataFrame,
    model: str = "model_name",
    when: str = "decided_on",
    days: int = COOLDOWN_DAYS,
    state: DataFrame | None = None,
    now: Column | str | date | None = None,
) -> DataFrame:
    """Final branch per decision: a wanted retrain runs unless the last one that ran is less
    than ``days`` days back, in event time. ``state`` (``cooldown_state`` of earlier runs) holds
    back models until their date; with ``now`` all decisions are taken at that time instead.

    The rule depends on its own earlier outcomes, so the wanted dates of a model are folded
    in order. They are distinct days: the list grows with the monitoring history of one
    model (a row per month), not with data.
    """
    names = decisions.columns
    day = F.col(when) if now is None else (now if isinstance(now, Column) else F.lit(now)).cast("date")
    decisions = decisions.withColumn("_day", day)
    if state is None:
        decisions = decisions.withColumn("_until", F.lit(None).cast("date"))
    else:
        # One row per model.
        known = state.select(F.col(model).alias("_model"), F.col("cooldown_until").alias("_until"))
        decisions = decisions.join(known, F.col(model).eqNullSafe(F.col("_model")), "left").drop("_model")
    wanted = F.collect_set(F.when(F.col("wants_retrain"), F.col("_day")))
    days_wanted = F.sort_array(wanted.over(Window.partitionBy(model)))
    start = F.struct(
        F.col("_until").alias("until"), F.array().cast("array<date>").alias("ran")
    )

    def step(acc: Column, day: Column) -> Column:
        free = acc["until"].isNull() | (day >= acc["until"])
        return F.when(
            free,
            F.struct(
                F.date_add(day, days).alias("until"), F.array_append(acc["ran"], day).alias("ran")
            ),
        ).otherwise(acc)

    ran = F.aggregate("_days", start, step, lambda acc: acc["ran"])
    runs = F.coalesce(F.col("wants_retrain") & F.array_contains(ran, F.col("_day")), F.lit(False))
    return (
        decisions.withColumn("_days", days_wanted)
        .withColumn("branch", F.when(runs, "retrain_model").otherwise("skip_retrain"))
        .select(*names, "branch")
    )


def cooldown_state(
    decided: DataFrame,
    model: str = "model_name",
    when: str = "decided_on",
    days: int = COOLDOWN_DAYS,
    state: DataFrame | None = None,
) -> DataFrame:
    """Per model: until when retraining is suppressed after its last retrain; written by one run and read by the next.

    Models of an earlier ``state`` without a later retrain keep their date.
    """
    ran = decided.where(F.col("branch") == "retrain_model")
    own = ran.groupBy(model).agg(F.date_add(F.max(when), days).alias("cooldown_until"))
    if state is None:
        return own
    both = own.unionByName(state.select(model, "cooldown_until"))
    return both.groupBy(model).agg(F.max("cooldown_until").alias("cooldown_until"))


def psi_dashboard_trend(payloads: DataFrame) -> DataFrame:
    """Computed months in order, with the two threshold lines."""
    return (
        payloads.where(F.col("status") == "OK")
        .select(
            "month",
            F.to_date("month", "yyyy-MM").alias("month_dt"),
            F.col("overall").alias("overall_psi"),
            F.lit(X.LOW).alias("moderate_threshold"),
            F.lit(X.HIGH).alias("significant_threshold"),
        )
        .orderBy("month")
    )


def feature_psi_latest(payloads: DataFrame) -> DataFrame:
    """Features of the latest computed month, highest index first."""
    rows = ok_payloads(payloads)
    latest = rows.agg(F.max("month")).scalar()
    return (
        rows.where(F.col("month") == latest)
        .select(F.col("feature").alias("Feature"), F.col("psi").alias("PSI"))
        .orderBy(F.col("PSI").desc(), "Feature")
    )


def psi_matrix(payloads: DataFrame, months: Sequence[str]) -> DataFrame:
    """Feature by month grid of the given months."""
    rows = ok_payloads(payloads).where(F.col("feature").isNotNull())
    return rows.groupBy("feature").pivot("month", list(months)).agg(F.max("psi"))


def psi_summary(trend: DataFrame, psi: str = "psi") -> DataFrame:
    """Mean, sample deviation, range and number of months of an index."""
    return trend.agg(
        F.count("*").alias("months"),
        F.avg(psi).alias("mean"),
        F.stddev_samp(psi).alias("std"),
        F.min(psi).alias("min"),
        F.max(psi).alias("max"),
    )


def status_breakdown(trend: DataFrame, status: str = "status") -> DataFrame:
    return trend.groupBy(status).agg(F.count("*").alias("months"))


def alert_policy(spark: SparkSession) -> DataFrame:
    """The policy as a literal table: three rows."""
    schema = "level string, psi_min double, psi_max double, policy_status string, policy_action string, escalation string"
    rows = ", ".join(
        "({})".format(
            ", ".join(
                "null" if v is None else "double('Infinity')" if v == float("inf")
                else f"'{v}'" if isinstance(v, str) else f"{v}D"
                for v in row
            )
        )
        for row in POLICY
    )
    names = ", ".join(part.split()[0] for part in schema.split(", "))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS policy({names})")


def apply_policy(
    df: DataFrame, psi: str = "psi", team: Sequence[str] = (), escalation: Sequence[str] = ()
) -> DataFrame:
    """Each row with the policy entry whose ``[psi_min, psi_max)`` holds its index, and whom it is sent to.

    The policy has three fixed rows, so it becomes one literal array and a filter on it.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(level).alias("level"),
                F.lit(lo).alias("psi_min"),
                F.lit(hi).alias("psi_max"),
                F.lit(status).alias("policy_status"),
                F.lit(action).alias("policy_action"),
                F.lit(escalation).cast("string").alias("escalation"),
            )
            for level, lo, hi, status, action, escalation in POLICY
        ]
    )
    value = F.col(psi)
    hit = F.filter(entries, lambda p: (value >= p["psi_min"]) & (value < p["psi_max"]))
    listed = lambda names: F.array(*[F.lit(n) for n in names]).cast("array<string>")
    recipients = (
        F.when(F.col("_p.level") == "red", listed([*team, *escalation]))
        .when(F.col("_p.level") == "yellow", listed(team))
        .otherwise(listed([]))
    )
    return df.withColumn("_p", F.get(hit, F.lit(0))).select(*df.columns, "_p.*", recipients.alias("recipients"))
