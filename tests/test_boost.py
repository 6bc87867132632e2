"""Boosted trees against a booster that walks through all rows, split by split."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import boost
from riskloom.operators import model as M
from riskloom.workload import training
from riskloom.workload.registry import QUERIES

FEATURES = ["a", "b", "c"]


def rows_of(n, seed=3):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        a, b = draw.gauss(0, 1), draw.randrange(6)
        c = draw.choice([None, draw.random()])
        out.append((i, a, float(b), c, int(a + 0.4 * b + (c or 0) + draw.gauss(0, 0.7) > 1)))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows_of(500), "id long, a double, b double, c double, y int").repartition(5)


def plain_booster(rows, edges, p, columns):
    """Trees as {node: (feature, edge, gain, value)}, by trying every cut on every row."""
    data = [({f: v for f, v in zip(FEATURES, r[1:4])}, r[4]) for r in rows]
    margin, trees = [0.0] * len(data), []
    units = lambda x: np.rint(x * boost.UNIT) / boost.UNIT
    shrink = lambda g: math.copysign(max(abs(g) - p.reg_alpha, 0), g)
    score = lambda g, h: shrink(g) ** 2 / (h + p.reg_lambda)
    for t in range(p.n_estimators):
        probs = [1 / (1 + math.exp(-m)) for m in margin]
        g = [units(q - y) for q, (_, y) in zip(probs, data)]
        h = [units(q * (1 - q)) for q in probs]
        tree, places = {}, {0: list(range(len(data)))}
        for i in range(2 ** (p.max_depth + 1) - 1):
            if i not in places:
                continue
            own = places[i]
            sums = lambda ids: (sum(g[k] for k in ids), sum(h[k] for k in ids))  # noqa: B023, E731
            whole, best = sums(own), (max(p.gamma, boost.NO_GAIN), None, None, None)
            for f in columns[t]:
                for edge in edges[f]:
                    goes = lambda k: (data[k][0][FEATURES[f]] is not None) and data[k][0][FEATURES[f]] > edge  # noqa: B023, E731
                    left, right = [k for k in own if not goes(k)], [k for k in own if goes(k)]
                    sl, sr = sums(left), sums(right)
                    if min(sl[1], sr[1]) < max(p.min_child_weight, 1 / boost.UNIT):
                        continue
                    gain = score(*sl) + score(*sr) - score(*whole)
                    if gain > best[0] + 1e-12:
                        best = (gain, f, edge, (left, right))
            value = -shrink(whole[0]) / (whole[1] + p.reg_lambda) * p.learning_rate
            deep = i >= 2**p.max_depth - 1
            if best[1] is None or deep:
                tree[i] = (None, None, 0.0, value)
                for k in own:
                    margin[k] += value
            else:
                tree[i] = (FEATURES[best[1]], best[2], best[0], value)
                places[2 * i + 1], places[2 * i + 2] = best[3]
        trees.append(tree)
    return trees, margin


@pytest.mark.parametrize(
    "params",
    [
        boost.Params(12, 2),
        boost.Params(4, 3, 0.3, reg_alpha=1.0, reg_lambda=2.0, gamma=0.1, min_child_weight=5),
        boost.Params(4, 3, 0.1, colsample_bytree=0.6, reg_lambda=0.0, min_child_weight=0),
    ],
    ids=["plain", "penalties", "columns"],
)
def test_trees_equal_a_plain_booster(table, params):
    model = boost.train(table, FEATURES, "y", ["id"], params, bins=16)
    rows = sorted(map(tuple, table.collect()))
    columns = [boost.Model(params, trees=[None] * t).columns(3, 42) for t in range(params.n_estimators)]
    want, margin = plain_booster(rows, model.edges, params, columns)
    got = [{} for _ in want]
    for t, node, feature, edge, gain, value in model.splits():
        got[t][node] = (feature, edge, gain, value)
    for mine, theirs in zip(got, want, strict=True):
        assert mine.keys() == theirs.keys()
        for node in mine:
            assert mine[node][:2] == theirs[node][:2]
            assert mine[node][2:] == pytest.approx(theirs[node][2:], rel=1e-6, abs=1e-9)
    scored = {r.id: r.m for r in model.scored(table, "m", probability=False).collect()}
    assert [scored[r[0]] for r in rows] == pytest.approx(margin, rel=1e-6, abs=1e-9)


def test_trees_do_not_depend_on_partitions(table):
    params = boost.Params(3, 3, 0.3, subsample=0.6, colsample_bytree=0.8)
    one = boost.train(table, FEATURES, "y", ["id"], params)
    two = boost.train(table.repartition(11), FEATURES, "y", ["id"], params)
    assert one == two == boost.BoostedTrees.from_json(one.to_json())
    assert one != boost.train(table, FEATURES, "y", ["id"], params, seed=1)


def test_messy_rows(spark, table):
    extra = spark.createDataFrame([(900, None, None, None, 1), (901, 1.0, 2.0, float("nan"), None)], table.schema)
    empty = table.withColumn("none", F.lit(None).cast("double")).limit(0)
    model = boost.train(table.unionAll(extra).withColumn("none", F.lit(None).cast("double")), [*FEATURES, "none"], "y", ["id"], boost.Params(2, 2))
    assert len(model.trees) == 2 and model.edges[3] == []
    nothing = boost.train(empty, [*FEATURES, "none"], "y", ["id"], boost.Params(1, 2))
    assert nothing.splits() == [] or nothing.trees[0].feature == [-1] * 7
    one_class = boost.train(table.where("y = 1"), FEATURES, "y", ["id"], boost.Params(2, 2))
    assert one_class.trees[0].value[0] > 0


def test_search_shares_passes_and_halves(spark, table):
    candidates = [boost.Params(6, d, r, reg_lambda=x) for d in (1, 2) for r in (0.01, 0.3) for x in (1.0, 2.0)]
    found = boost.search(table, FEATURES, "y", ["id"], candidates, folds=3, rungs=(2, 4))
    assert sorted(c for c, *_ in found.table) == list(range(8))
    assert [sum(r == k for _, _, r, _ in found.table) for k in (0, 1, 2)] == [4, 2, 2]
    # A model of the search is the model trained alone on the other folds.
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("id").cast("string")), F.lit(3))
    last = found.scores[-1].where("fold = 1")
    best = found.table[0][0]
    edges = boost.feature_edges(table, FEATURES)
    rows = boost.binned_rows(table, FEATURES, "y", edges, ["id"], fold)
    _, (alone,) = boost.grow(rows, [boost.Model(candidates[best], 1)], 3, 6)
    trees = boost.BoostedTrees(FEATURES, edges, alone.trees, candidates[best])
    expected = sorted(r.m for r in trees.scored(table.where(fold == 1), "m", probability=False).collect())
    assert sorted(r.score for r in last.where(f"candidate = {best}").collect()) == pytest.approx(expected)
    # The areas agree with SQL over the stored scores.
    scores = found.scores[0].toPandas()  # noqa: F841
    areas = duckdb.sql("""SELECT candidate, avg(area) FROM (SELECT a.candidate, a.fold,
        avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END) AS area
        FROM scores a JOIN scores b ON a.candidate = b.candidate AND a.fold = b.fold AND a.y = 1 AND b.y = 0 GROUP BY 1, 2) GROUP BY 1""")
    areas = dict(areas.fetchall())
    for c, _, rung, value in found.table:
        if rung == 0:
            assert value == pytest.approx(areas[c])
    worst_kept = min(areas[c] for c, _, rung, _ in found.table if rung)
    assert all(areas[c] <= worst_kept for c, _, rung, _ in found.table if not rung)


def test_edges_are_exact_quantiles_in_one_pass(spark):
    draw = random.Random(5)
    rows = [(draw.gauss(0, 1), draw.choice([None, -0.0, 0.0, 3.0, float("nan")]), draw.choice(["7", "x", "1e3"]), None) for _ in range(6000)]
    df = spark.createDataFrame(rows, "a double, few double, text string, none double").repartition(3)
    got = boost.feature_edges(df, ["a", "few", "text", "none"])

    def plain(values):
        values = sorted(values)
        cuts = {values[max(1, math.ceil(i / 32 * len(values))) - 1] for i in range(1, 32)}
        return sorted(c for c in cuts if c < values[-1])

    few = [r[1] for r in rows if r[1] is not None and not math.isnan(r[1])]
    assert got == [plain([r[0] for r in rows]), plain(few), plain([float(r[2]) for r in rows if r[2] != "x"]), []]
    # As few rows as fit in the brackets' whole range, and none at all.
    assert boost.feature_edges(df.limit(0), ["a", "few"]) == [[], []]
    some = [r[0] for r in df.limit(40).collect()]
    assert boost.feature_edges(spark.createDataFrame([(v,) for v in some], "a double"), ["a"]) == [plain(some)]


def test_stored_rows_are_cut_into_files_and_edges_found_once(spark, table, monkeypatch):
    monkeypatch.setattr(boost, "FILE_ROWS", 20)
    edges = boost.feature_edges(table, FEATURES)
    assert len(boost.binned_rows(table, FEATURES, "y", edges, ["id"]).inputFiles()) >= 500 / 20
    found = boost.search(table, FEATURES, "y", ["id"], [boost.Params(2, 1), boost.Params(2, 2)], folds=2)
    assert found.edges == edges
    monkeypatch.setattr(boost, "feature_edges", None)
    assert boost.train(table, FEATURES, "y", ["id"], found.best, edges=found.edges).edges == edges


def test_registered_search_gives_every_point_all_its_trees_in_every_fold(spark, monkeypatch):
    draw = random.Random(7)
    rows = [(f"l{i}", f"c{i}", "train" if i % 4 else "test", draw.gauss(0, 1), i) for i in range(120)]
    rows = spark.createDataFrame([(*r[:4], int(r[3] + draw.gauss(0, 1) > 0)) for r in rows], "loan_id string, Customer_ID string, split string, Annual_Income double, label int")
    rows = rows.withColumn("snapshot_date", F.lit("1997-01-01").cast("date"))
    monkeypatch.setattr(training, "_rows", lambda spark, sf: rows)
    whole, space = training.M.random_search, {"n_estimators": [2, 3], "max_depth": [1], "learning_rate": [0.1, 0.3]}
    asked, compared = [], []

    def small(*args, **options):
        asked.append(options)
        return whole(*args, **{**options, "space": space, "n": 4})

    def compare(rows, models, names, n_features, scores=boost.held_out_scores):
        compared.append(sorted((c, m.fold, len(m.trees) == m.params.n_estimators) for c, m in zip(names, models, strict=True)))
        return scores(rows, models, names, n_features)

    monkeypatch.setattr(training.M, "random_search", small)
    monkeypatch.setattr(boost, "held_out_scores", compare)
    assert QUERIES["m2_random_search"].run(spark, "").count() == 2
    # One comparison, of all points and folds with all their trees; draws, folds and space are those of the original.
    assert compared == [[(c, k, True) for c in range(4) for k in range(3)]]
    assert asked == [{}] and (M.SEARCH_DRAWS, M.FOLDS) == (100, 3)


def test_leaves_are_those_of_a_walk_row_by_row():
    draw = np.random.default_rng(2)
    tree = boost.Tree.empty(4)
    for i in range(15):
        if i == 0 or tree.feature[(i - 1) // 2] >= 0 and draw.random() < 0.8:
            tree.feature[i], tree.cut[i] = int(draw.integers(3)), int(draw.integers(30))
    bins = draw.integers(0, 32, (200, 3)).astype(np.uint8)
    for levels in range(5):
        got = tree.leaves(np.ascontiguousarray(bins.T), levels)
        for row, end in zip(bins, got, strict=True):
            at = 0
            for _ in range(levels):
                at = at if tree.feature[at] < 0 else 2 * at + 1 + int(row[tree.feature[at]] > tree.cut[at])
            assert at == end


def test_files_are_smaller_for_many_models(spark, table, monkeypatch):
    monkeypatch.setattr(boost, "FILE_MARGINS", 200)
    edges = boost.feature_edges(table, FEATURES)
    assert len(boost.binned_rows(table, FEATURES, "y", edges, ["id"], n_models=10).inputFiles()) >= 500 / 20


def test_trees_do_not_depend_on_how_often_sums_are_stored(table, monkeypatch):
    params, moved = boost.Params(5, 2, 0.3, subsample=0.8), []
    one = boost.train(table, FEATURES, "y", ["id"], params)
    kept = boost._with_margins
    monkeypatch.setattr(boost, "_with_margins", lambda *a: moved.append(1) or kept(*a))
    for every, times in ((2, 2), (5, 0)):
        monkeypatch.setattr(boost, "STORE_EVERY", every)
        moved.clear()
        assert boost.train(table, FEATURES, "y", ["id"], params) == one
        # Nothing is stored after the last tree.
        assert len(moved) == times
