"""Training, scoring and checking of the boosted-tree classifier."""

from __future__ import annotations

import json
import random
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import boost
from riskloom.operators.assemble import split_hash, window_columns
from riskloom.operators.boost import BoostedTrees, Params
from riskloom.operators.preprocess import Preprocessor, fit_preprocessor
from riskloom.operators.ranks import auc
from riskloom.session import stored

# Search space, draws, folds and seed.
SEED = 42
SEARCH_SPACE: dict[str, list] = {
    "n_estimators": [25, 50],
    "max_depth": [2, 3],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "colsample_bytree": [0.6, 0.8],
    "gamma": [0, 0.1],
    "min_child_weight": [1, 3, 5],
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 1.5, 2],
}
SEARCH_DRAWS = 100
FOLDS = 3


@dataclass
class ScoringModel:
    """Fitted preprocessing with the fitted trees."""

    preprocessor: Preprocessor
    model: BoostedTrees
    params: dict[str, object]

    def probabilities(self, df: DataFrame) -> DataFrame:
        """``df`` without its raw features, with ``model_predictions`` added."""
        prepared = self.preprocessor.transform(df)
        others = [c for c in df.columns if c not in self.preprocessor.features]
        scored = self.model.scored(prepared, "_probability")
        return scored.select(*others, F.col("_probability").alias("model_predictions"))


def _prepared(preprocessor: Preprocessor, train: DataFrame, label: str, key: Sequence[str], **extra: Column) -> DataFrame:
    """Stored: key, label and prepared features, which the passes of the learner read again and again."""
    kept = [c for c in dict.fromkeys([*key, label]) if c not in preprocessor.features]
    rows = preprocessor.transform(train.withColumns(extra))
    return stored(rows.select(*kept, *extra, *preprocessor.features), "training-rows", boost.FILE_ROWS)


def train_classifier(
    train: DataFrame,
    features: Sequence[str] | None = None,
    label: str = "label",
    params: Mapping[str, object] | None = None,
    key: Sequence[str] = (),
) -> ScoringModel:
    """Fit the preprocessing and boosted trees with a fixed seed. Rows are drawn by ``key``, else by their features."""
    preprocessor = fit_preprocessor(train, features)
    rows = _prepared(preprocessor, train, label, key)
    chosen = dict(params or {})
    names = preprocessor.features
    trees = boost.train(rows, names, label, list(key) or names, Params(**chosen), SEED)
    return ScoringModel(preprocessor, trees, chosen)


def draw_params(space: Mapping[str, Sequence] = SEARCH_SPACE, n: int = SEARCH_DRAWS, seed: int = SEED) -> list[dict]:
    """``n`` distinct random points of the grid (all of them if there are fewer)."""
    names = list(space)
    size = 1
    for name in names:
        size *= len(space[name])
    points = random.Random(seed).sample(range(size), min(n, size))
    drawn = []
    for point in points:
        one = {}
        for name in names:
            point, position = divmod(point, len(space[name]))
            one[name] = space[name][position]
        drawn.append(one)
    return drawn


def random_search(
    train: DataFrame,
    key: Sequence[str],
    features: Sequence[str] | None = None,
    label: str = "label",
    space: Mapping[str, Sequence] = SEARCH_SPACE,
    n: int = SEARCH_DRAWS,
    folds: int = FOLDS,
    rungs: Sequence[int] = (),
) -> tuple[ScoringModel, list[tuple[dict, float]]]:
    """Best of ``n`` random grid points by cross-validated AUC of the probabilities.

    Folds come from a hash of ``key``, so they are the same in every run. All points and folds are fitted in shared
    passes; with ``rungs``, numbers of trees, the better half goes on at each. Returns the model refitted on all rows and
    the mean AUC of each point where it ended, the best first.
    """
    preprocessor = fit_preprocessor(train, features)
    digits = F.conv(F.substring(split_hash(key), 9, 7), 16, 10).cast("int")
    rows = _prepared(preprocessor, train, label, key, _fold=F.pmod(digits, F.lit(folds)))
    drawn = draw_params(space, n)
    names = preprocessor.features
    candidates = [Params(**point) for point in drawn]
    found = boost.search(rows, names, label, key, candidates, folds, rungs, F.col("_fold"), SEED)
    trees = boost.train(rows, names, label, key, found.best, SEED, edges=found.edges)
    fitted = ScoringModel(preprocessor, trees, drawn[found.table[0][0]])
    return fitted, [(drawn[c], area) for c, _, _, area in found.table]


def score(model: ScoringModel, df: DataFrame, model_name: str) -> DataFrame:
    """Predictions of assembled rows: Customer_ID, snapshot_date, model_name, model_predictions."""
    return model.probabilities(df).select(
        "Customer_ID",
        F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"),
        F.lit(model_name).alias("model_name"),
        "model_predictions",
    )


def baseline_month(train_date: Column) -> Column:
    """First of the month that holds the last day of the training window."""
    return F.trunc(window_columns(train_date)["train_end"], "MM")


def baseline_scores(model: ScoringModel, df: DataFrame, model_name: str) -> DataFrame:
    """The same scores for the baseline month, in a column named ``prediction``."""
    return score(model, df, model_name).withColumnRenamed("model_predictions", "prediction")


def evaluate(model: ScoringModel, df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    """AUC and Gini per split; null for a split with a single class."""
    return auc(model.probabilities(df), "model_predictions", label, [split])


def save_model(spark: SparkSession, model: ScoringModel, path: str) -> None:
    """Model directory: one line of JSON with trees and preprocessing, next to the table of category codes."""
    fitted = model.preprocessor
    numbers = {"features": fitted.features, "medians": fitted.medians, "scale": fitted.scale}
    state = json.dumps({"preprocessor": numbers, "params": model.params, "trees": asdict(model.model)})
    if fitted.occupation_codes is not None:
        fitted.occupation_codes.write.mode("overwrite").parquet(f"{path}/codes")
    one = spark.range(1).select(F.lit(state).alias("value"))
    one.write.mode("overwrite").text(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> ScoringModel:
    state = json.loads(spark.read.text(f"{path}/model").first()["value"])
    fitted = Preprocessor(**state["preprocessor"])
    if "Occupation" in fitted.features:
        fitted.occupation_codes = spark.read.parquet(f"{path}/codes")
    return ScoringModel(fitted, BoostedTrees.from_json(json.dumps(state["trees"])), state["params"])


def verify_reload(model: ScoringModel, path: str, df: DataFrame, label: str = "label") -> DataFrame:
    """AUC of the model in memory next to the AUC of the saved copy, per split."""
    loaded = load_model(df.sparkSession, path)
    before = evaluate(model, df, label).select("split", F.col("auc").alias("auc_trained"))
    after = evaluate(loaded, df, label).select("split", F.col("auc").alias("auc_reloaded"))
    return before.join(after, "split").withColumn(
        "equal", F.col("auc_trained").eqNullSafe(F.col("auc_reloaded"))
    )
