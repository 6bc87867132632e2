"""Second-order boosted trees with weight penalties, many models in shared passes.

Rows are binned once at exact quantiles and stored. One pass a level reads them and sums, for every model, the gradients
and second derivatives of the logistic loss per node, feature and bin; Spark merges the sums of all tasks model by model
and picks the best split of each node there. Only splits, some numbers a node, come to the driver. Models that differ in
parameters or in the fold they leave out share these passes. What the trees so far add up to is worked out from them and
stored every ``STORE_EVERY`` trees.

Derivatives are summed as whole multiples of 1 / UNIT, so trees depend neither on how rows are dealt nor on retries.

With G and H the sums of a node, its weight is -T(G) / (H + lambda), where T moves G towards zero by alpha, and its score
T(G)^2 / (H + lambda). A node is split where the scores of both sides exceed its own by more than gamma, and both sides
have at least min_child_weight of H; the best split wins, ties go to the first feature and lowest cut. A null feature
goes left, as does a value equal to a cut.
"""

from __future__ import annotations

import json
import math
import random
import sys
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ranks import ACCURACY, MARGIN, SMALL_GROUP, auc, running_totals
from riskloom.session import stored

# Executor code of this module is shipped by value, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
UNIT = 1 << 24
STORE_EVERY = 20
# Rows of a stored file: a pass takes long for the bytes it reads, so cores are kept busy by files, not by sizes.
FILE_ROWS = 50_000
# The same for rows times the models that work on them.
FILE_MARGINS = 600_000
# Sums of this many tasks are merged at once.
FAN_IN = 64
# Least gain that counts as one.
NO_GAIN = 1e-6


@dataclass(frozen=True)
class Params:
    n_estimators: int = 50
    max_depth: int = 3
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0


@dataclass
class Tree:
    """Nodes numbered like a heap: those below node i are 2i + 1 and 2i + 2. A node without a feature (-1) is a leaf."""

    feature: list[int]
    cut: list[int]
    value: list[float]
    gain: list[float]

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls([-1] * n, [0] * n, [0.0] * n, [0.0] * n)

    def leaves(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node that each column of bins, with a row per feature, is in after ``levels`` steps."""
        kind = np.min_scalar_type(2 ** (levels + 1))
        at = np.zeros(bins.shape[1], dtype=kind)
        for i in range(2**levels - 1):
            if self.feature[i] >= 0:
                # From node i to 2i + 1 or 2i + 2.
                step = (bins[self.feature[i]] > self.cut[i]).astype(kind)
                step += kind.type(i + 1)
                step *= at == i
                at += step
        return at


@dataclass
class Model:
    """One model in the making: its parameters and the fold it does not learn from (none: -1)."""

    params: Params
    fold: int = -1
    trees: list[Tree] = field(default_factory=list)
    # Trees whose sum is stored with the rows.
    stored: int = 0

    def columns(self, n_features: int, seed: int) -> list[int]:
        """The features that the next tree may use."""
        n = max(1, math.ceil(self.params.colsample_bytree * n_features - 1e-9))
        return sorted(random.Random(f"{seed}:{len(self.trees)}").sample(range(n_features), n))


@dataclass
class BoostedTrees:
    """A fitted model over raw feature columns."""

    features: list[str]
    edges: list[list[float]]
    trees: list[Tree]
    params: Params

    def scored(self, df: DataFrame, name: str, probability: bool = True) -> DataFrame:
        """``df`` with the probability, else the log odds, as ``name``: one compiled expression over its columns."""
        used = sorted({f for t in self.trees for f in t.feature if f >= 0})
        numbers = {f"_f{i}": F.nullif(F.col(self.features[i]).cast("double"), F.lit(float("nan"))) for i in used}

        def node(tree: Tree, i: int) -> str:
            f = tree.feature[i]
            if f < 0:
                return f"{tree.value[i]!r}D"
            # A null is not above the edge.
            return f"if(_f{f} > {self.edges[f][tree.cut[i]]!r}D, {node(tree, 2 * i + 2)}, {node(tree, 2 * i + 1)})"

        margin = F.expr(" + ".join(["0.0D", *(node(t, 0) for t in self.trees)]))
        value = 1 / (1 + F.exp(-margin)) if probability else margin
        return df.withColumns(numbers).withColumn(name, value).drop(*numbers)

    def splits(self) -> list[tuple]:
        """(tree, node, feature, threshold, gain, value) of every node that was reached."""
        out = []
        for t, tree in enumerate(self.trees):
            reached = [0]
            for i in reached:
                f = tree.feature[i]
                edge = self.edges[f][tree.cut[i]] if f >= 0 else None
                out.append((t, i, self.features[f] if f >= 0 else None, edge, tree.gain[i], tree.value[i]))
                reached += [2 * i + 1, 2 * i + 2] if f >= 0 else []
        return out

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> BoostedTrees:
        state = json.loads(text)
        return cls(state["features"], state["edges"], [Tree(**t) for t in state["trees"]], Params(**state["params"]))


def feature_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Distinct exact quantiles of every feature, at most ``bins`` - 1 each, without its largest value.

    A sketch brackets each quantile as in :mod:`riskloom.operators.ranks`. One pass then sorts some thousand values at a
    time, which counts those below all brackets at once and collapses those inside them.
    """
    probs = [i / bins for i in range(1, bins)]
    names = [f"f{i}" for i in range(len(features))]
    numbers = [F.nullif(F.col(f).try_cast("double"), F.lit(float("nan"))).alias(n) for f, n in zip(features, names)]
    rows = stored(df.select(*numbers), "boost-values", FILE_ROWS)
    ends = [(max(p - MARGIN, 0.0), min(p + MARGIN, 1.0)) for p in probs]
    inner = sorted({p for pair in ends for p in pair})
    # Some numbers per feature.
    sketches = rows.select(
        *[
            F.struct(
                F.count(n).alias("n"),
                F.min(n).alias("least"),
                F.max(n).alias("largest"),
                F.percentile_approx(n, inner, ACCURACY).alias("near"),
            ).alias(n)
            for n in names
        ]
    ).first()
    known = {f: s for f, s in enumerate(sketches) if s.n} if probs and names else {}

    brackets = {}
    for f, s in known.items():
        whole = s.n <= SMALL_GROUP
        los = [s.least if whole or lo == 0.0 else s.near[inner.index(lo)] for lo, _ in ends]
        his = [s.largest if whole or hi == 1.0 else s.near[inner.index(hi)] for _, hi in ends]
        brackets[f] = np.array(los), np.array(his)
    if not brackets:
        return [[] for _ in features]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        below = {f: np.zeros(len(probs), dtype=np.int64) for f in brackets}
        for batch in batches:
            held: list[tuple[int, int, np.ndarray, np.ndarray]] = []
            for f, (los, his) in brackets.items():
                values = batch[names[f]].to_numpy(dtype=float)
                # Zero has one sign.
                values = np.sort(values[~np.isnan(values)]) + 0.0
                starts, stops = np.searchsorted(values, los, side="left"), np.searchsorted(values, his, side="right")
                below[f] += starts
                for i in np.flatnonzero(stops > starts):
                    value, copies = np.unique(values[starts[i] : stops[i]], return_counts=True)
                    held.append((f, int(i), value, copies))
            if held:
                sizes = [len(value) for _, _, value, _ in held]
                feature, place = (np.repeat([h[k] for h in held], sizes) for k in (0, 1))
                value, copies = (np.concatenate([h[k] for h in held]) for k in (2, 3))
                yield pd.DataFrame({"feature": feature, "i": place, "value": value, "copies": copies, "below": 0})
        for f, (los, _) in brackets.items():
            yield pd.DataFrame({"feature": f, "i": range(len(probs)), "value": los + 0.0, "copies": 0, "below": below[f]})

    counts = rows.mapInPandas(count, "feature int, i int, value double, copies long, below long")
    cells = counts.groupBy("feature", "i", "value").agg(F.sum("copies").alias("copies"), F.sum("below").alias("below"))
    placed = running_totals(cells, ["feature", "i"], "value", ["copies", "below"])
    ranks = [max(1, math.ceil(round(p * known[f].n, 6))) if f in known else 0 for f in range(len(names)) for p in probs]
    wanted = F.get(F.lit(ranks), F.col("feature") * len(probs) + F.col("i"))
    before = F.col("below_group") + F.col("copies_before")
    own = placed.where((before < wanted) & (wanted <= before + F.col("copies"))).select("feature", "value").collect()
    if len(own) != len(brackets) * len(probs):
        raise ValueError("rank outside its bracket")
    found: list[set[float]] = [set() for _ in features]
    for r in own:
        if r.value < known[r.feature].largest:
            found[r.feature].add(r.value)
    return [sorted(values) for values in found]


def _file_rows(n_models: int) -> int:
    return max(1, min(FILE_ROWS, FILE_MARGINS // max(1, n_models)))


def binned_rows(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    edges: Sequence[Sequence[float]],
    key: Sequence[str],
    fold: Column | None = None,
    n_models: int = 1,
) -> DataFrame:
    """Stored for ``n_models``: label, fold, a number drawn from the key, and the bin of every feature, one byte each."""
    edges = [np.array(e) for e in edges]
    if max((len(e) for e in edges), default=0) > 255:
        raise ValueError("at most 256 bins")
    names = [f"f{i}" for i in range(len(edges))]
    numbers = [F.col(f).try_cast("double").alias(n) for f, n in zip(features, names)]
    draw = F.xxhash64(*[F.col(c).cast("string") for c in key])
    fold = (F.lit(0) if fold is None else fold).cast("int")
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), fold.alias("fold"), draw.alias("draw"), *numbers)

    def sort_in(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins = np.zeros((len(batch), len(edges)), dtype=np.uint8)
            for i, (name, edge) in enumerate(zip(names, edges)):
                values = batch[name].to_numpy(dtype=float)
                bins[:, i] = np.where(np.isnan(values), 0, np.searchsorted(edge, values, side="left"))
            yield batch[["y", "fold", "draw"]].assign(bins=[b.tobytes() for b in bins], margins=b"")

    return stored(rows.mapInPandas(sort_in, "y double, fold int, draw long, bins binary, margins binary"), "boost-rows", _file_rows(n_models))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _parts(batches: Iterator[pd.DataFrame], n_features: int, n_models: int, rows: int = 10_000):
    """Rows some at a time, with their bins, a row per feature, and the stored margins of all models."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            part = batch.iloc[start : start + rows]
            bins = np.frombuffer(b"".join(part.bins), dtype=np.uint8).reshape(len(part), n_features)
            bins = np.ascontiguousarray(bins.T)
            held = b"".join(part.margins)
            margins = np.frombuffer(held).reshape(len(part), n_models) if held else np.zeros((len(part), n_models))
            yield part, bins, margins


def _unstored(models: list[Model]) -> list[Model]:
    """What tasks need of the models: the trees whose sum is not stored with the rows."""
    return [replace(x, trees=x.trees[x.stored :], stored=0) for x in models]


def _margin(model: Model, bins: np.ndarray, before: np.ndarray) -> np.ndarray:
    out = before.copy()
    for tree in model.trees[model.stored :]:
        out += np.array(tree.value)[tree.leaves(bins, model.params.max_depth)]
    return out


def _histograms(rows: DataFrame, models: list[Model], growing: dict[int, tuple[Tree, int, list[int]]], n_features: int, bins: int, seed: int) -> DataFrame:
    """Per task and growing model, the sums per node of its level, feature and bin."""
    sent, turns = _unstored(models), {m: len(models[m].trees) for m in growing}

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        sums = {m: np.zeros((2, 2**level, len(cols), bins), dtype=np.int64) for m, (_, level, cols) in growing.items()}
        for part, binned, before in _parts(batches, n_features, len(sent)):
            y, fold = part.y.to_numpy(), part.fold.to_numpy()
            draw = part.draw.to_numpy().view(np.uint64)
            # Models with the same fold and share of rows learn from the same rows.
            used: dict[tuple[int, float, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
            for m, (tree, level, cols) in growing.items():
                model = sent[m]
                t, share = turns[m], model.params.subsample
                rows_of = (model.fold, share, t if share < 1 else 0)
                if rows_of not in used:
                    use = fold != model.fold
                    if share < 1:
                        with np.errstate(over="ignore"):
                            use &= _mixed(draw ^ _mixed(np.array([(seed << 20) + t + 1], dtype=np.uint64))) / 2.0**64 < share
                    use = np.flatnonzero(use)
                    used[rows_of] = use, y[use], np.ascontiguousarray(binned[:, use])
                use, own_y, own = used[rows_of]
                p = 1 / (1 + np.exp(-_margin(model, own, before[use, m])))
                g = np.rint((p - own_y) * UNIT)
                h = np.rint(p * (1 - p) * UNIT)
                node = tree.leaves(own, level).astype(np.int64) - (2**level - 1)
                base, size = node * bins, 2**level * bins
                if len(node) and node.min() < 0:
                    # Rows in a leaf of an earlier level are done.
                    open_rows = np.flatnonzero(node >= 0)
                    base, g, h, own = base[open_rows], g[open_rows], h[open_rows], own[:, open_rows]
                for c, f in enumerate(cols):
                    cell = base + own[f]
                    for k, weights in enumerate((g, h)):
                        sums[m][k, :, c] += np.bincount(cell, weights, size).astype(np.int64).reshape(-1, bins)
        task = TaskContext.get().partitionId()
        yield pd.DataFrame({"model": list(sums), "task": task, "sums": [s.tobytes() for s in sums.values()]})

    return rows.mapInPandas(add, "model int, task int, sums binary")


def _total(sums: pd.Series) -> np.ndarray:
    total = np.zeros(len(sums.iloc[0]) // 8, dtype=np.int64)
    for s in sums:
        total += np.frombuffer(s, dtype=np.int64)
    return total


def best_splits(g: np.ndarray, h: np.ndarray, params: Params) -> list[tuple[int, int, float, float, float, float, float]]:
    """Per node of sums (node, feature, bin): feature (-1: none), cut, gain, G and H of the node and of its left side."""

    def score(a, b):
        small = np.maximum(np.abs(a) - params.reg_alpha, 0)
        return np.divide(small * small, b + params.reg_lambda, out=np.zeros_like(small), where=b + params.reg_lambda > 0)

    out = []
    for node_g, node_h in zip(g, h, strict=True):
        whole_g, whole_h = node_g[0].sum(), node_h[0].sum()
        left_g, left_h = node_g.cumsum(axis=1)[:, :-1], node_h.cumsum(axis=1)[:, :-1]
        right_g, right_h = whole_g - left_g, whole_h - left_h
        gain = score(left_g, left_h) + score(right_g, right_h) - score(whole_g, whole_h)
        least = max(params.min_child_weight, 1 / UNIT)
        gain = np.where((left_h >= least) & (right_h >= least), gain, -np.inf)
        f, cut = np.unravel_index(int(gain.argmax()), gain.shape) if gain.size else (-1, 0)
        best = float(gain[f, cut]) if gain.size else -math.inf
        if best <= max(params.gamma, NO_GAIN):
            out.append((-1, 0, 0.0, float(whole_g), float(whole_h), 0.0, 0.0))
        else:
            out.append((int(f), int(cut), best, float(whole_g), float(whole_h), float(left_g[f, cut]), float(left_h[f, cut])))
    return out


def _weight(g: float, h: float, params: Params) -> float:
    if h + params.reg_lambda <= 0:
        return 0.0
    return -math.copysign(max(abs(g) - params.reg_alpha, 0.0), g) / (h + params.reg_lambda) * params.learning_rate


def _splits_of_level(rows: DataFrame, models: list[Model], growing: dict, n_features: int, bins: int, seed: int) -> dict[int, list]:
    sums = _histograms(rows, models, growing, n_features, bins, seed)
    tasks = rows.rdd.getNumPartitions()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [group.model.iloc[0]], "task": [group.task.iloc[0] // FAN_IN], "sums": [_total(group.sums).tobytes()]})

    while tasks > FAN_IN:
        some = F.floor(F.col("task") / FAN_IN).alias("some")
        sums = sums.groupBy("model", some).applyInPandas(merge, "model int, task int, sums binary")
        tasks = math.ceil(tasks / FAN_IN)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        m = int(group.model.iloc[0])
        _, level, cols = growing[m]
        g, h = _total(group.sums).reshape(2, 2**level, len(cols), bins) / UNIT
        found = best_splits(g, h, models[m].params)
        out = pd.DataFrame(found, columns=["feature", "cut", "gain", "g", "h", "left_g", "left_h"])
        out["feature"] = [cols[f] if f >= 0 else -1 for f in out.feature]
        return out.assign(model=m, node=range(len(out)))

    schema = "feature int, cut int, gain double, g double, h double, left_g double, left_h double, model int, node int"
    found: dict[int, list] = {}
    # Few bytes that take long to work on: a number of tasks that is asked for is not reduced for small sums.
    sums = sums.repartition(min(len(growing), rows.sparkSession.sparkContext.defaultParallelism), "model")
    # Some numbers per model and node.
    for r in sums.groupBy("model").applyInPandas(choose, schema).collect():
        found.setdefault(r.model, []).append(r)
    return found


def _with_margins(rows: DataFrame, models: list[Model], keep: list[int], n_features: int) -> DataFrame:
    """Stored again, with the margins of the kept models after all their trees."""

    sent = _unstored(models)

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, binned, before in _parts(batches, n_features, len(sent)):
            now = np.stack([_margin(sent[m], binned, before[:, m]) for m in keep], axis=1)
            yield part.assign(margins=[x.tobytes() for x in np.ascontiguousarray(now)])

    return stored(rows.mapInPandas(move, rows.schema), "boost-rows", _file_rows(len(keep)))


def grow(
    rows: DataFrame, models: list[Model], n_features: int, rounds: int, bins: int = BINS, seed: int = 42
) -> tuple[DataFrame, list[Model]]:
    """Add trees to all models until they have ``rounds``, or as many as their parameters ask for. Returns the rows with
    stored margins, and the models."""
    while True:
        open_models = [m for m, x in enumerate(models) if len(x.trees) < min(rounds, x.params.n_estimators)]
        if not open_models:
            return rows, models
        trees = {m: Tree.empty(models[m].params.max_depth) for m in open_models}
        columns = {m: models[m].columns(n_features, seed) for m in open_models}
        active = set(open_models)
        for level in range(max(models[m].params.max_depth for m in open_models)):
            growing = {m: (trees[m], level, columns[m]) for m in active if level < models[m].params.max_depth}
            if not growing:
                break
            active = set()
            for m, nodes in _splits_of_level(rows, models, growing, n_features, bins, seed).items():
                tree, params = trees[m], models[m].params
                for r in nodes:
                    i = 2**level - 1 + r.node
                    if not level:
                        tree.value[0] = _weight(r.g, r.h, params)
                    if r.feature < 0 or level and tree.feature[(i - 1) // 2] < 0:
                        continue
                    tree.feature[i], tree.cut[i], tree.gain[i] = r.feature, r.cut, r.gain
                    tree.value[2 * i + 1] = _weight(r.left_g, r.left_h, params)
                    tree.value[2 * i + 2] = _weight(r.g - r.left_g, r.h - r.left_h, params)
                    active.add(m)
        for m in open_models:
            models[m].trees.append(trees[m])
        more = any(len(x.trees) < min(rounds, x.params.n_estimators) for x in models)
        if more and any(len(x.trees) - x.stored >= STORE_EVERY for x in models):
            rows = _with_margins(rows, models, list(range(len(models))), n_features)
            for x in models:
                x.stored = len(x.trees)


def train(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    params: Params = Params(),
    seed: int = 42,
    bins: int = BINS,
    edges: list[list[float]] | None = None,
) -> BoostedTrees:
    """One model over all rows with a label. ``edges`` are those of a search over the same rows, else worked out."""
    edges = feature_edges(df, features, bins) if edges is None else edges
    rows = binned_rows(df, features, label, edges, key)
    _, (model,) = grow(rows, [Model(params)], len(features), params.n_estimators, bins, seed)
    return BoostedTrees(list(features), edges, model.trees, params)


def held_out_scores(rows: DataFrame, models: list[Model], names: list[int], n_features: int) -> DataFrame:
    """Stored ``candidate``, ``fold``, ``y``, ``score``: every row under the models that did not learn from it."""

    sent = _unstored(models)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, binned, before in _parts(batches, n_features, len(sent)):
            fold, y = part.fold.to_numpy(), part.y.to_numpy()
            for m, model in enumerate(sent):
                own = np.flatnonzero(fold == model.fold)
                margin = _margin(model, binned[:, own], before[own, m])
                yield pd.DataFrame({"candidate": names[m], "fold": model.fold, "y": y[own], "score": margin})

    return stored(rows.mapInPandas(read, "candidate int, fold int, y double, score double"), "boost-scores")


@dataclass
class Search:
    """Candidates with the rung they reached and their mean held-out AUC there, the best first; the cuts of the features."""

    table: list[tuple[int, Params, int, float]]
    scores: list[DataFrame]
    edges: list[list[float]]

    @property
    def best(self) -> Params:
        return self.table[0][1]


def search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Sequence[str],
    candidates: Sequence[Params],
    folds: int = 3,
    rungs: Sequence[int] = (),
    fold: Column | None = None,
    seed: int = 42,
    bins: int = BINS,
) -> Search:
    """Cross-validate all candidates in shared passes.

    Without ``rungs`` every candidate gets all its trees. With them, candidates are ranked by mean held-out AUC when they
    have that many trees, and the better half goes on. Ties go to the earlier candidate. A fold with one class counts
    half.
    """
    edges = feature_edges(df, features, bins)
    if fold is None:
        fold = F.pmod(F.xxhash64(F.lit("fold"), *[F.col(c).cast("string") for c in key]), F.lit(folds))
    rows = binned_rows(df, features, label, edges, key, fold, len(candidates) * folds)
    alive = list(range(len(candidates)))
    models = [Model(candidates[c], k) for c in alive for k in range(folds)]
    reached: dict[int, tuple[int, float]] = {}
    kept_scores = []
    for rung, rounds in enumerate([*rungs, max(p.n_estimators for p in candidates)]):
        rows, models = grow(rows, models, len(features), rounds, bins, seed)
        scores = held_out_scores(rows, models, [c for c in alive for _ in range(folds)], len(features))
        kept_scores.append(scores)
        areas = auc(scores, "score", "y", ["candidate", "fold"])
        means = areas.groupBy("candidate").agg(F.avg(F.coalesce("auc", F.lit(0.5))).alias("auc"))
        reached |= {r.candidate: (rung, r.auc) for r in means.collect()}
        alive.sort(key=lambda c: (-reached[c][1], c))
        if rung < len(rungs):
            before = {(id(m.params), m.fold): i for i, m in enumerate(models)}
            going = alive[: math.ceil(len(alive) / 2)]
            keep = [before[id(candidates[c]), k] for c in going for k in range(folds)]
            rows = _with_margins(rows, models, keep, len(features))
            models = [models[i] for i in keep]
            for x in models:
                x.stored = len(x.trees)
            alive = going
    order = sorted(reached, key=lambda c: (-reached[c][0], -reached[c][1], c))
    return Search([(c, candidates[c], *reached[c]) for c in order], kept_scores, edges)

