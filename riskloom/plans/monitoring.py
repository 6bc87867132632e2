"""Monitoring run: drift of the scores, alerts and the retrain decision."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.decide import COOLDOWN_DAYS, alert_records, cooldown, cooldown_state, retrain_decision
from riskloom.operators.drift import monthly_psi, prediction_drift
from riskloom.session import stored
from riskloom.sources import versions

# What a stored decision keeps of a month.
DECISION = (
    "model_name string, decided_on date, month string, overall double, psi map<string,double>, status string, "
    "key_columns_high int, wants_retrain boolean, branch string"
)


def monitor_scores(
    base: DataFrame,
    current: DataFrame,
    model_name: str,
    by: Sequence[str] = (),
    empty: str = "inf",
    now: str | None = None,
) -> DataFrame:
    """Prediction drift with its alert record, per group of ``by``."""
    return alert_records(prediction_drift(base, current, model_name, by=by, empty=empty), now=now)


def wanted_months(
    base: DataFrame,
    predictions: DataFrame,
    months: DataFrame,
    model_name: str,
    baseline_from: str | date | None = None,
) -> DataFrame:
    """Monthly payloads with ``wants_retrain``, dated on the first of the month."""
    return retrain_decision(monthly_psi(base, predictions, months, baseline_from)).withColumns(
        {"model_name": F.lit(model_name), "decided_on": F.to_date("month", "yyyy-MM")}
    )


def decide_months(
    base: DataFrame,
    predictions: DataFrame,
    months: DataFrame,
    model_name: str,
    baseline_from: str | date | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Monthly payloads with the retrain decision after cool-down, decided on the month date.

    ``state`` is the stored cool-down of earlier runs.
    """
    return cooldown(wanted_months(base, predictions, months, model_name, baseline_from), state=state)


def store_decisions(
    wanted: DataFrame, path: str, days: int = COOLDOWN_DAYS, token: str | None = None
) -> int:
    """Commit the months of ``wanted`` to the decisions at ``path``, one row per model and month.

    A month that was decided before is replaced, and the cool-down of its model is folded again over all its months. So
    runs over single months, in any order and repeated or not, end with the decisions of one run over all of them. What
    was decided earlier stays readable under its version number.
    """
    fields = [f.split(" ") for f in DECISION.split(", ")]
    # A row per month; stored, since every attempt to commit reads it twice.
    new = stored(wanted.select(*[F.col(n).cast(t).alias(n) for n, t in fields if n != "branch"]), "wanted")

    def change(known: DataFrame | None) -> DataFrame:
        if known is None:
            return cooldown(new, days=days)
        others = known.drop("branch").join(new, ["model_name", "decided_on"], "left_anti")
        return cooldown(others.unionByName(new), days=days)

    return versions.update(wanted.sparkSession, path, change, token)


def read_decisions(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Decisions as last committed, or at an earlier commit; none before the first."""
    found = versions.read(spark, path, number)
    return spark.createDataFrame([], DECISION) if found is None else found


def stored_cooldown(spark: SparkSession, path: str, days: int = COOLDOWN_DAYS) -> DataFrame:
    """Until when each model is held back by its last retrain, from the stored decisions."""
    return cooldown_state(read_decisions(spark, path), days=days)
