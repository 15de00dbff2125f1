"""Boosted trees against a plain recursive search, and their Shapley values against all subsets."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricetide.operators import models as ML
from pricetide.operators import shapley as SH
from pricetide.operators import boosting as B
from pricetide.operators.boosting import BoostedModel, Boosting, Task, fit_side_by_side

NAMES = ["a", "b", "c"]
CUTS = [np.array([-1.0, -0.5, 0.0, 0.5, 1.0]), np.array([-0.7, 0.1, 0.8]), np.array([0.0])]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3)).round(3)
    y = (2 * x[:, 0] + np.where(x[:, 1] > 0.1, 3, -1) * (x[:, 0] > 0) + rng.normal(scale=0.2, size=600)).round(4)
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rows = [(i, *map(float, r), float(t), int(i % 4 == 3)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, part int").repartition(3).cache()


def pull(g, l1):
    return math.copysign(max(abs(g) - l1, 0), g)


def score(g, n, p):
    return pull(g, p.l1) ** 2 / (n + p.l2)


def best_cut(x, g, p):
    best = (0.0, None, None)
    for f, cuts in enumerate(CUTS):
        for cut in cuts:
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= p.least_rows:
                gain = score(g[left].sum(), left.sum(), p) + score(g[~left].sum(), (~left).sum(), p) - score(g.sum(), len(g), p)
                if gain > best[0] + 1e-7:
                    best = (gain, f, cut)
    return best


def one_by_one(x, g, p):
    """Values of the rows in a tree grown by taking one leaf after the other."""
    leaves = [(np.arange(len(g)), 0)]
    done = []
    while leaves and len(leaves) + len(done) < (p.max_leaves or 1 << 30):
        found = [(best_cut(x[r], g[r], p) if p.max_depth is None or d < p.max_depth else (0.0, None, None)) for r, d in leaves]
        k = max(range(len(leaves)), key=lambda i: found[i][0])
        if found[k][1] is None:
            break
        rows, depth = leaves.pop(k)
        left = x[rows, found[k][1]] <= found[k][2]
        leaves += [(rows[left], depth + 1), (rows[~left], depth + 1)]
    out = np.zeros(len(g))
    for rows, _ in leaves + done:
        out[rows] = -p.learning_rate * pull(g[rows].sum(), p.l1) / (len(rows) + p.l2)
    return out


def predictions(model, table):
    return np.array([r["prediction"] for r in model.transform(table).orderBy("id").select("prediction").collect()])


@pytest.mark.parametrize("preset", [
    Boosting(3, 0.3, "level", max_depth=3, least_rows=5, l1=0.1, l2=1.0),
    Boosting(3, 0.3, "leaf", max_depth=None, max_leaves=7, least_rows=5, l1=0.5, l2=2.0),
    Boosting(2, 0.3, "leaf", max_depth=2, max_leaves=50, least_rows=1)])
def test_against_plain_search(data, table, preset):
    x, y = data
    [model] = fit_side_by_side(table, NAMES, "y", "part", [Task(preset, 2)], cuts=CUTS)
    want = np.full(len(y), y.mean())
    for _ in range(preset.rounds):
        want = want + one_by_one(x, want - y, preset)
    assert np.allclose(predictions(model, table), want, atol=1e-9)
    assert all(t.rows[0] == len(y) for t in model.trees)


def test_common_cuts(data, table):
    x, y = data
    p = Boosting(1, 1.0, "same", max_depth=2, least_rows=0, l2=3.0)
    [model] = fit_side_by_side(table, NAMES, "y", "part", [Task(p, 2)], cuts=CUTS)
    g = y.mean() - y

    def total(groups):
        return sum(score(g[r].sum(), r.sum(), p) for r in groups)

    groups = [np.ones(len(y), bool)]
    for _ in range(2):
        options = [[r & s for r in groups for s in (x[:, f] <= c, x[:, f] > c)] for f in range(3) for c in CUTS[f]]
        groups = max(options, key=total)
    want = y.mean() + sum(r * (-pull(g[r].sum(), 0) / (r.sum() + 3.0)) for r in groups)
    assert np.allclose(predictions(model, table), want, atol=1e-9)


def test_models_side_by_side_equal_single_ones_and_resume(spark, table, tmp_path):
    presets = [Boosting(20, 0.2, "level", max_depth=3, row_share=0.7, column_share=0.6),
               Boosting(11, 0.2, "leaf", max_depth=None, max_leaves=6, l1=0.1),
               Boosting(5, 0.2, "same", max_depth=3, least_rows=0)]
    both = fit_side_by_side(table, NAMES, "y", "part", [Task(p, 1, 1) for p in presets], cut=False)
    for p, model in zip(presets, both):
        assert len(model.trees) == len(model.errors) == p.rounds
    [alone] = fit_side_by_side(table, NAMES, "y", "part", [Task(presets[0], 1, 1)], cuts=both[0].cuts, cut=False)
    assert np.allclose(predictions(alone, table), predictions(both[0], table), atol=1e-9)
    [again] = fit_side_by_side(table, NAMES, "y", "part", [Task(presets[0], 1, 1)], start=[both[0].cut(9)], cut=False)
    assert np.allclose(predictions(again, table), predictions(both[0], table), atol=1e-9) and len(again.errors) == 20
    held = table.filter("part = 1")
    curve = both[0].round_errors(held, "y").collect()
    assert [r["round"] for r in curve] == list(range(1, 21))
    assert np.allclose([(r["mae"], r["rmse"]) for r in curve], both[0].errors)
    both[1].save(spark, str(tmp_path / "m"))
    assert (predictions(BoostedModel.load(spark, str(tmp_path / "m")), table) == predictions(both[1], table)).all()
    assert both[0].importances().sum() == pytest.approx(1) and both[0].importances().argmax() == 0


def test_patience(table):
    p = Boosting(60, 1.0, "level", max_depth=6)
    [model] = fit_side_by_side(table, NAMES, "y", "part", [Task(p, 1, 1)], patience=4)
    errors = [e for e, _ in model.errors]
    assert len(model.trees) == int(np.argmin(errors)) + 1 and len(errors) == len(model.trees) + 4 < 60


def test_odd_tables(spark, table):
    p = Task(Boosting(2, 0.5, max_depth=2), 1, 1)
    odd = spark.createDataFrame([(1.0, None, 2.0, 0), (float("nan"), 1.0, 4.0, 0), (3.0, 1.0, None, 0), (3.0, 2.0, 9.0, None)],
                                "a double, b double, y double, part int")
    [model] = fit_side_by_side(odd, ["a", "b"], "y", "part", [p])
    assert model.base == 3.0 and model.transform(odd).filter("prediction is null").count() == 0
    [empty] = fit_side_by_side(odd.limit(0), ["a", "b"], "y", "part", [p])
    assert empty.trees == [] and [r["prediction"] for r in empty.transform(odd).collect()] == [0.0] * 4


def reached(tree, codes, subset, node=0):
    f = int(tree.feature[node])
    if f < 0:
        return tree.value[node]
    left, right = int(tree.left[node]), int(tree.right[node])
    if f in subset:
        return reached(tree, codes, subset, left if codes[f] <= tree.bin[node] else right)
    if not tree.rows[node]:  # both sides weigh half below a node without rows
        return (reached(tree, codes, subset, left) + reached(tree, codes, subset, right)) / 2
    return (tree.rows[left] * reached(tree, codes, subset, left) + tree.rows[right] * reached(tree, codes, subset, right)
            ) / tree.rows[node]


@pytest.mark.parametrize("growth", ["level", "leaf", "same"])
def test_tree_shapley_against_all_subsets(table, growth):
    p = Boosting(3, 0.5, growth, max_depth=4, max_leaves=9 if growth == "leaf" else None, least_rows=2)
    [model] = fit_side_by_side(table, NAMES, "y", "part", [Task(p, 2)], cuts=CUTS)
    some = table.filter("id % 40 = 7")
    got = {(r["id"], r["feature"]): r for r in SH.tree_shapley(model, some, "id").collect()}
    assert len(got) == some.count() * 3
    for r in some.collect():
        codes = model.codes([np.array([r[f]]) for f in NAMES])[:, 0]
        for i, name in enumerate(NAMES):
            others = [k for k in range(3) if k != i]
            want = sum(math.factorial(s) * math.factorial(2 - s) / 6 * sum(
                reached(t, codes, {*c, i}) - reached(t, codes, set(c)) for t in model.trees)
                for s in range(3) for c in itertools.combinations(others, s))
            assert got[r["id"], name]["contribution"] == pytest.approx(want, abs=1e-9)
        assert got[r["id"], "a"]["prediction"] == pytest.approx(
            model.margins([np.array([r[f]]) for f in NAMES])[0], abs=1e-9)


def test_pruning_by_median():
    values = {0: 1.0, 1: 5.0, 2: 5.0, 3: 5.0, 4: 9.0, 5: 6.0, 6: 4.0, 7: 5.5}
    assert ML.pruned_at(values) == {5, 7} and ML.pruned_at({6: 2.0}) == set()


def test_tuning_prunes_and_ranks(table):
    folded = table.withColumn("fold", F.col("id").cast("int") % 3)
    trials = [Boosting(2, r, max_depth=2) for r in (0.9, 0.5, 0.6, 0.7, 0.8, 0.01, 0.95)]
    got = ML.tune_time_series(folded, NAMES, "y", trials, folds=2).collect()
    by = {r["trial"]: r for r in got}
    assert by[5]["pruned_after"] == 1 and by[5]["mae"] is None and got[-1]["trial"] == 5
    kept = [r["mae"] for r in got if r["mae"] is not None]
    assert kept == sorted(kept) and by[6]["pruned_after"] is None


def test_leaf_patterns_are_looked_up(monkeypatch):
    """Contributions from tables equal those worked out row by row, which leaves of many features still take."""
    rng = np.random.default_rng(3)
    depth, n = 5, 2 ** 6 - 1
    inner = np.arange(n) < 2 ** depth - 1
    rows = np.zeros(n, np.int64)
    for k in range(n - 1, -1, -1):
        rows[k] = rows[2 * k + 1] + rows[2 * k + 2] if inner[k] else rng.integers(1, 50)
    tree = B.Tree(np.where(inner, rng.integers(0, 9, n), -1).astype(np.int16), rng.integers(0, 255, n).astype(np.int16),
                  np.where(inner, 2 * np.arange(n) + 1, -1), np.where(inner, 2 * np.arange(n) + 2, -1),
                  np.where(inner, 0.0, rng.normal(size=n)), rows, np.zeros(n))
    codes = rng.integers(0, 256, (9, 20_000)).astype(np.uint8)
    paths = SH._paths(tree)
    want, _ = SH._tree_contributions(paths, codes)
    tables, others = SH._lookups(paths)
    got = np.zeros(codes.shape)
    SH._add_lookups(got, tables, codes)
    assert not others and len(tables) == 2 ** depth and np.abs(got - want).max() < 1e-12
    monkeypatch.setattr(SH, "TABLE_FEATURES", 3)
    tables, others = SH._lookups(paths)
    SH._add_lookups(got := np.zeros(codes.shape), tables, codes)
    assert tables and others and np.abs(got + SH._tree_contributions(others, codes)[0] - want).max() < 1e-12


def test_blocks_hold_many_rows(spark):
    rows = spark.range(0, 150_000, 1, 1).select((F.col("id") % 100).cast("double").alias("a"),
                                                F.col("id").cast("double").alias("y"), F.lit(0).alias("part"))
    sizes = [len(r["role"]) // 2 for r in B._packed(rows, ["a"], "y", "part", [np.arange(99.0)], [0.0], [[]]).collect()]
    assert sum(sizes) == 150_000 and min(sizes[:-1]) >= B.BLOCK_ROWS


def test_marked_rows_train_the_same_model(spark):
    """One table with a mark for its validation rows, in place of two parts of it."""
    rows = spark.range(400).select((F.col("id") % 37).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"),
                                   F.sin(F.col("id") % 37).alias("y"), (F.col("id") % 5 == 0).alias("held"))
    preset = {"m": Boosting(6, 0.3, "level", max_depth=3, row_share=0.8)}
    one = ML.train_boosters_marked(rows, F.col("held"), ["a", "b"], "y", preset)["m"]
    two = ML.train_boosters(rows.filter("not held"), ["a", "b"], "y", preset, None, rows.filter("held"))["m"]
    assert len(one.errors) == 6 and np.allclose(one.errors, two.errors)
    assert [t.feature.tolist() for t in one.trees] == [t.feature.tolist() for t in two.trees]


def test_one_task_grows_what_jobs_per_level_grow(table, monkeypatch):
    presets = [Boosting(12, 0.2, "level", max_depth=4, row_share=0.7, column_share=0.7),
               Boosting(6, 0.2, "leaf", max_depth=None, max_leaves=9, l1=0.1, l2=1.0),
               Boosting(5, 0.2, "same", max_depth=3, least_rows=0, l2=3.0)]

    def both(**more):
        for most in (B.TASK_ROWS, -1):
            monkeypatch.setattr(B, "TASK_ROWS", most)
            yield fit_side_by_side(table, NAMES, "y", "part", [Task(p, 1, 1) for p in presets], cuts=CUTS, **more)
        monkeypatch.undo()

    for one, two in zip(*both(patience=3)):
        assert np.allclose(one.errors, two.errors, atol=1e-9) and len(one.trees) == len(two.trees)
        for s, t in zip(one.trees, two.trees):
            assert (s.feature == t.feature).all() and (s.bin == t.bin).all() and (s.rows == t.rows).all()
            assert np.allclose(s.value, t.value, atol=1e-9) and np.allclose(s.gain, t.gain, atol=1e-6)
    for one, two in zip(*both(cut=False, keep_trees=False)):
        assert one.trees == two.trees == [] and len(one.errors) and np.allclose(one.errors, two.errors, atol=1e-9)


def test_tables_of_a_tree_are_built_in_the_tasks(table, monkeypatch):
    """Of 500 trees of 128 leaves they would be some 450 MB, too much for the driver and for a job to carry."""
    [model] = fit_side_by_side(table, NAMES, "y", "part", [Task(Boosting(3, 0.3, max_depth=4), 2)], cuts=CUTS)

    def refused(paths):
        raise AssertionError("on the driver")

    monkeypatch.setattr(SH, "_lookups", refused)
    SH.tree_contributions(model, table, "id")  # only plans
    monkeypatch.undo()
    assert SH.tree_contributions(model, table, "id").filter("size(contributions) = 3").count() == 600
