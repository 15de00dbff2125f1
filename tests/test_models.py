from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricetide.operators import evaluation as E
from pricetide.operators import models as ML
from pricetide.operators import shapley as SH


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.5 + rng.normal(scale=0.01, size=300)
    return spark.createDataFrame([(f"r{i:03d}", *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                                 "id string, a double, b double, c double, y double").cache()


def test_linear_and_shapley(spark, table):
    model = ML.train_linear(table, ["a", "b", "c"], "y")
    coef = model.stages[-1].coefficients.toArray()
    assert coef == pytest.approx([3, -2, 0], abs=0.01)
    shap = SH.explain_model(model, table, table, ["a", "b", "c"], "id", background=20, explained=15, permutations=2).cache()
    assert shap.count() == 45
    total = shap.groupBy("id").agg((F.sum("contribution") - F.first("prediction") + F.first("base_value")).alias("gap"))
    assert max(abs(r["gap"]) for r in total.collect()) < 1e-9
    # of a linear model each contribution is the coefficient times the distance from the background mean
    bg = [r for r in SH.sample_n(table, "id", 20, 42).collect()]
    means = {f: np.mean([r[f] for r in bg]) for f in "abc"}
    for r in shap.collect():
        assert r["contribution"] == pytest.approx(coef["abc".index(r["feature"])] * (r["value"] - means[r["feature"]]), abs=1e-9)
    assert SH.global_importance(shap, 1).first()["feature"] == "a"
    assert SH.dependence_table(shap, 1).count() == 15
    last = SH.local_audit(shap, "id").filter("step = 3").collect()
    assert all(r["running"] == pytest.approx(r["prediction"]) for r in last)
    assert {r["feature"] for r in SH.importance_stability(shap, "id", share=0.9, top=1).collect()} == {"a"}


def test_boosting_stops_at_the_best_round(spark, table):
    assert ML.best_round([5, 4, 3, 3.5, 3.2, 2.9], patience=2) == 3
    assert ML.best_round([5, 4, 3, 3.5, 3.2, 2.9], patience=3) == 6
    preset = replace(ML.MARKET_BOOSTED, max_depth=3)
    model = ML.train_boosted(table, ["a", "b", "c"], "y", preset, 4, table)
    curve = ML.learning_curve(model, table, "y").collect()
    assert [r["round"] for r in curve] == [1, 2, 3, 4] and curve[-1]["rmse"] < curve[0]["rmse"]
    best = ML.top_k_features(ML.feature_importance(spark, model, ["a", "b", "c"]), 2).collect()
    assert {r["feature"] for r in best} == {"a", "b"} and best[0]["importance"] >= best[1]["importance"]


def test_stack_meets_optimality(spark):
    rng = np.random.default_rng(4)
    y = rng.normal(10, 3, 400)
    p = np.stack([y + rng.normal(0, 1, 400), 0.5 * y + rng.normal(0, 1, 400), -y + rng.normal(0, 0.5, 400),
                  rng.normal(size=400)], axis=1)
    df = spark.createDataFrame([(float(t), *map(float, r)) for t, r in zip(y, p)], "y double, m0 double, m1 double, m2 double, m3 double")
    names = ["m0", "m1", "m2", "m3"]
    stack = ML.stack_nonneg_ridge(df, names, "y")
    w = np.array([stack.weights[n] for n in names])
    x = p - p.mean(0)
    slope = 2 * (x.T @ x + np.eye(4)) @ w - 2 * x.T @ (y - y.mean())
    assert (w >= 0).all() and w[2] == 0
    assert np.allclose(slope[w > 0], 0, atol=1e-6) and (slope[w == 0] >= -1e-6).all()
    assert stack.intercept == pytest.approx(y.mean() - p.mean(0) @ w) and sum(stack.shares.values()) == pytest.approx(1)


def test_metrics_and_gate(spark):
    rows = [("m", 10.0, 10.0), ("m", 20.0, 21.0), ("m", 0.0, 0.5)]
    df = spark.createDataFrame(rows, "model string, actual double, predicted double")
    m = E.regression_metrics(df).first()
    assert m["mae"] == 0.5 and m["median_abs_error"] == 0.5
    assert m["mape"] == pytest.approx((0 + 0.05 + 50) / 3 * 100) and m["within_5pct"] == pytest.approx(200 / 3)
    assert m["r2"] == pytest.approx(1 - 1.25 / 200)
    gate = E.metric_gate(E.regression_metrics(df)).first()
    assert (gate["mae_ok"], gate["r2_ok"], gate["no_retrain"]) == (False, True, True)


def test_scalers(spark, table):
    scaled = E.apply_scale(table.withColumn("k", F.lit(7.0)), E.fit_standard(table.withColumn("k", F.lit(7.0)), ["a", "k"]), ["a", "k"])
    r = scaled.agg(F.avg("a"), F.stddev_pop("a"), F.max("k")).first()
    assert r[0] == pytest.approx(0, abs=1e-9) and r[1] == pytest.approx(1) and r[2] == 0
    r = E.apply_scale(table, E.fit_minmax(table, ["a"]), ["a"]).agg(F.min("a"), F.max("a")).first()
    assert tuple(r) == (0.0, 1.0)


def test_save_and_load(spark, table, tmp_path):
    model = ML.train_forest(table, ["a", "b", "c"], "y", {"trees": 3, "maxDepth": 3, "minInstancesPerNode": 1})
    ML.save_model(model, str(tmp_path / "m"))
    both = ML.predict(ML.load_model(str(tmp_path / "m")), ML.predict(model, table, "p1"), "p2")
    assert both.filter("p1 <> p2").count() == 0
    ML.save_metadata(spark.createDataFrame([(0.1,)], "mae double"), str(tmp_path / "meta"), ["a"], {"depth": 3}, "h")
    assert spark.read.json(str(tmp_path / "meta")).first()["feature_list"] == ["a"]


def test_trials_are_seeded():
    assert ML.draw_trials(3) == ML.draw_trials(3)
    assert all(200 <= t.rounds <= 1000 and 4 <= t.max_depth <= 10 and 0.01 <= t.learning_rate <= 0.3 for t in ML.draw_trials(20))


def test_the_market_model_has_the_rounds_of_its_preset(spark, monkeypatch):
    from checks import models as M
    seen = []

    def marked(rows, valid, features, target, presets, rounds=None, patience=ML.PATIENCE):
        seen.extend(rounds or p.rounds for p in presets.values())
        return {name: None for name in presets}

    few = spark.range(5).withColumn("split", F.lit("train"))
    monkeypatch.setattr(M, "once", lambda name, spark, folder, build: build())
    monkeypatch.setattr(M, "market_split", lambda spark, folder: few)
    monkeypatch.setattr(M.splits, "chrono_split", lambda df, *_: df.withColumn("split", F.lit("train")))
    monkeypatch.setattr(ML, "train_boosters_marked", marked)
    M.boosted(spark, "none")
    assert seen == [500]


def test_the_market_forest_has_the_trees_of_its_preset(spark, monkeypatch):
    from checks import models as M
    few = spark.range(40).select(F.when(F.col("id") % 4 > 0, "train").otherwise("test").alias("split"),
                                 *[(F.col("id") % 7).cast("double").alias(c) for c in [*M.MARKET_FEATURES, M.MARKET_TARGET]])
    grown = []
    monkeypatch.setattr(M, "market_split", lambda spark, folder: few)
    monkeypatch.setattr(M, "_report", lambda name, model, test: grown.append(model.stages[-1].getNumTrees))
    M.train_forest(spark, "none")
    assert grown == [200]


def test_tuning_has_all_trials_folds_and_rounds(monkeypatch):
    from checks import models as M
    seen = {}

    def tuned(folded, features, target, trials, fold="fold", folds=5, rounds=None):
        seen.update(trials=len(trials), folds=folds, rounds=[rounds or t.rounds for t in trials])

    monkeypatch.setattr(M, "market_split", lambda spark, folder: None)
    monkeypatch.setattr(ML, "tune_time_series", tuned)
    M.tune_time_series(None, "none")
    assert seen["trials"] == 50 and seen["folds"] == 5 and seen["rounds"] == [t.rounds for t in ML.draw_trials(50)]
