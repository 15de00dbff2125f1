"""Price models with MLlib: baselines, boosted presets, a non-negative stack, tuning and scoring."""

from __future__ import annotations

import itertools
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.functions.core import py_round
from pricetide.operators.boosting import (  # noqa: F401
    PATIENCE, BoostedModel, Boosting, Task, best_round, cut_points, fit_side_by_side)
from pricetide.session import cut_lineage

# Learner presets.
BOOSTED = {
    "xgb": Boosting(1000, 0.05, "level", max_depth=8, least_rows=3, l1=0.1, l2=1.0, row_share=0.8, column_share=0.8,
                    seed=42),
    "lgbm": Boosting(1000, 0.05, "leaf", max_depth=None, max_leaves=127, least_rows=20, l1=0.1, l2=1.0, row_share=0.8,
                     column_share=0.8, seed=42),
    "catboost": Boosting(1000, 0.05, "same", max_depth=8, least_rows=0, l2=3.0, seed=42),
}
MARKET_BOOSTED = Boosting(500, 0.05, "level", max_depth=7, row_share=0.8, column_share=0.8, seed=42)
FOREST = {"trees": 500, "maxDepth": 12, "minInstancesPerNode": 2}
# ``memory``: MB of the sums that a task holds, so that several tasks of 200 trees fit an executor; fewer nodes a pass.
MARKET_FOREST = {"trees": 200, "maxDepth": 12, "minInstancesPerNode": 5, "memory": 256}
RIDGE_ALPHA = 1.0
# Tuning ranges (trees, learning rate on a log scale, depth, row and column share).
TUNE_RANGES = {"rounds": (200, 1000), "learning_rate": (0.01, 0.3), "max_depth": (4, 10), "row_share": (0.6, 1.0),
               "column_share": (0.6, 1.0)}
# Fixed value: trials of a study.
TRIALS = 50
# Fixed value: trials that are never pruned.
STARTUP_TRIALS = 5
# Columns that are keys, targets or look into the future, and so never features.
NOT_FEATURES = {
    "invoice_no", "invoice_date", "customer_id", "description", "stock_code", "source", "dataset_year_range",
    "target_price", "target_demand_7d", "target_revenue_7d", "revenue", "unit_price", "week_year",
    "product_category", "h_mean", "h_std", "pct_price_change", "pct_demand_change", "country", "us", "split",
    "forward_demand_7d", "forward_revenue_7d", "optimal_price_historical",
}


def feature_names(df: DataFrame) -> list[str]:
    numeric = {"int", "bigint", "double", "float"}
    return [c for c, t in df.dtypes if t in numeric and c not in NOT_FEATURES]


def preparation(features: list[str], scale: bool = False) -> list:
    """Assemble, and scale to 0..1 where wanted."""
    if not scale:
        return [VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")]
    return [VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="error"),
            MinMaxScaler(inputCol="_raw", outputCol="features")]


def _fit(learner, train: DataFrame, features: list[str], scale: bool) -> PipelineModel:
    return Pipeline(stages=[*preparation(features, scale), learner]).fit(train)


def train_linear(train: DataFrame, features: list[str], target: str, scale: bool = False) -> PipelineModel:
    return _fit(LinearRegression(labelCol=target, predictionCol="prediction"), train, features, scale)


def train_forest(train: DataFrame, features: list[str], target: str, preset: dict = FOREST,
                 trees: int | None = None, scale: bool = False) -> PipelineModel:
    learner = RandomForestRegressor(
        labelCol=target, numTrees=trees or preset["trees"], maxDepth=preset["maxDepth"],
        minInstancesPerNode=preset["minInstancesPerNode"], seed=42, maxMemoryInMB=preset.get("memory", 1024))
    return _fit(learner, train, features, scale)


def train_boosters(train: DataFrame, features: list[str], target: str, presets: dict[str, Boosting],
                   rounds: int | None = None, validation: DataFrame | None = None,
                   patience: int = PATIENCE) -> dict[str, BoostedModel]:
    """Boosted models of one table, grown side by side.  With ``validation`` rows each ends at its best round, once
    their error has not fallen for ``patience`` rounds.  Trees cut by order alone, so no scaling is needed."""
    columns = [*features, target]
    rows = train.select(*columns, F.lit(0).alias("_part"))
    if validation is not None:
        rows = rows.unionByName(validation.select(*columns, F.lit(1).alias("_part")))
    return _boosters(rows, features, target, presets, rounds, validation is not None, patience)


def train_boosters_marked(marked: DataFrame, valid: Column, features: list[str], target: str, presets: dict[str, Boosting],
                          rounds: int | None = None, patience: int = PATIENCE) -> dict[str, BoostedModel]:
    """``train_boosters`` on one table whose rows are for validation where ``valid`` holds, so that sums and blocks read
    it once.  The approximate cut points depend on the order of the rows and are those of ``train_boosters``."""
    rows = marked.select(*features, target, F.coalesce(valid.cast("int"), F.lit(0)).alias("_part"))
    cuts = cut_points(rows.filter("_part = 0").unionByName(rows.filter("_part = 1")), features)
    return _boosters(rows, features, target, presets, rounds, True, patience, cuts)


def _boosters(rows, features, target, presets, rounds, watched, patience, cuts=None) -> dict[str, BoostedModel]:
    tasks = [Task(replace(p, rounds=rounds or p.rounds), 1, 1 if watched else None) for p in presets.values()]
    return dict(zip(presets, fit_side_by_side(rows, features, target, "_part", tasks, patience, cuts)))


def train_boosted(train: DataFrame, features: list[str], target: str, preset: Boosting, rounds: int | None = None,
                  validation: DataFrame | None = None, patience: int = PATIENCE) -> BoostedModel:
    return train_boosters(train, features, target, {"boosted": preset}, rounds, validation, patience)["boosted"]


def predict(model: PipelineModel | BoostedModel, df: DataFrame, out: str = "predicted") -> DataFrame:
    extra = [c for c in ("_raw", "features") if c not in df.columns]
    return model.transform(df).withColumnRenamed("prediction", out).drop(*extra)


def feature_importance(spark, model: PipelineModel | BoostedModel, features: list[str]) -> DataFrame:
    """One row per feature, most important first (ties by name)."""
    boosted = isinstance(model, BoostedModel)
    weights = model.importances() if boosted else model.stages[-1].featureImportances.toArray()
    table = spark.createDataFrame([(f, float(w)) for f, w in zip(features, weights)], "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def top_k_features(importance: DataFrame, k: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


def learning_curve(model: BoostedModel, validation: DataFrame, target: str) -> DataFrame:
    """Validation RMSE after each boosting round."""
    return model.round_errors(validation, target).select("round", "rmse")


# ---- stacking

def gram(df: DataFrame, predictions: list[str], target: str) -> DataFrame:
    """Centred second moments of the base predictions and the target, long form, from one aggregate."""
    names = [*predictions, target]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    n = F.count(F.lit(1))
    wide = df.agg(*[(F.covar_pop(a, b) * n).alias(f"{a}|{b}") for a, b in pairs],
                  *[F.avg(a).alias(f"_mean|{a}") for a in names])
    return wide.unpivot([], wide.columns, "cell", "value").select(
        F.split("cell", r"\|")[0].alias("a"), F.split("cell", r"\|")[1].alias("b"), "value")


@dataclass(frozen=True)
class Stack:
    weights: dict
    intercept: float

    @property
    def shares(self) -> dict:
        """Weights as shares of their sum."""
        total = sum(self.weights.values())
        return {k: (v / total if total else 0.0) for k, v in self.weights.items()}

    def column(self):
        return sum((F.col(k) * w for k, w in self.weights.items()), F.lit(self.intercept))


def stack_nonneg_ridge(df: DataFrame, predictions: list[str], target: str, alpha: float = RIDGE_ALPHA) -> Stack:
    """Ridge weights that are not negative, with an intercept.

    Spark reduces the rows to a matrix of the few base models; the best feasible set of active models is
    then found by trying each.
    """
    cells = {(r["a"], r["b"]): r["value"] for r in gram(df, predictions, target).collect()}
    k = len(predictions)
    g = np.array([[cells.get((a, b), cells.get((b, a))) for b in predictions] for a in predictions])
    c = np.array([cells[(a, target)] for a in predictions])
    ridge = g + alpha * np.eye(k)
    best, best_loss = np.zeros(k), 0.0
    for size in range(1, k + 1):
        for active in itertools.combinations(range(k), size):
            idx = list(active)
            w = np.zeros(k)
            w[idx] = np.linalg.solve(ridge[np.ix_(idx, idx)], c[idx])
            loss = w @ ridge @ w - 2 * c @ w
            if (w >= 0).all() and loss < best_loss:
                best, best_loss = w, loss
    means = np.array([cells[("_mean", a)] for a in predictions])
    return Stack(dict(zip(predictions, map(float, best))), float(cells[("_mean", target)] - best @ means))


# ---- tuning

def draw_trials(trials: int = TRIALS, seed: int = 42) -> list[Boosting]:
    rng = np.random.default_rng(seed)
    lo, hi = TUNE_RANGES["learning_rate"]
    return [Boosting(
        rounds=int(rng.integers(TUNE_RANGES["rounds"][0], TUNE_RANGES["rounds"][1] + 1)),
        learning_rate=float(np.exp(rng.uniform(np.log(lo), np.log(hi)))),
        max_depth=int(rng.integers(TUNE_RANGES["max_depth"][0], TUNE_RANGES["max_depth"][1] + 1)),
        row_share=float(rng.uniform(*TUNE_RANGES["row_share"])),
        column_share=float(rng.uniform(*TUNE_RANGES["column_share"]))) for _ in range(trials)]


def pruned_at(values: dict[int, float], startup: int = STARTUP_TRIALS) -> set[int]:
    """Trials whose value at a step is above the median of those of the trials drawn before them; the first ``startup``
    trials are kept."""
    order = sorted(values)
    return {t for i, t in enumerate(order) if t >= startup and i and values[t] > np.median([values[o] for o in order[:i]])}


def tune_time_series(folded: DataFrame, features: list[str], target: str, trials: list[Boosting],
                     fold: str = "fold", folds: int = 5, rounds: int | None = None) -> DataFrame:
    """Each trial's mean validation MAE over expanding folds, best first, and where it was pruned.

    All trials of a fold grow side by side on one stored table; before the next fold those are dropped whose mean so far
    is above the median of the earlier trials.  A pruned trial has no ``mae``, and its mean so far as ``last_mae``.
    """
    table = cut_lineage(folded.select(*features, target, fold), "folds")
    errors: dict[int, list[float]] = {i: [] for i in range(len(trials))}
    left, pruned = list(errors), {}
    for f in range(1, folds + 1):
        tasks = [Task(replace(trials[i], rounds=rounds or trials[i].rounds), f, f) for i in left]
        # no patience: a trial has as many rounds as were drawn
        models = fit_side_by_side(table.filter(F.col(fold) <= f), features, target, fold, tasks, 1 << 30, cut=False,
                                  keep_trees=False)
        for i, model in zip(left, models):
            errors[i].append(model.errors[-1][0])
        if f < folds:
            gone = pruned_at({i: float(np.mean(errors[i])) for i in left})
            pruned |= dict.fromkeys(gone, f)
            left = [i for i in left if i not in gone]
    out = [(i, None if i in pruned else float(np.mean(errors[i])), float(np.mean(errors[i])), pruned.get(i), p.rounds,
            p.learning_rate, p.max_depth, p.row_share, p.column_share) for i, p in enumerate(trials)]
    schema = ("trial int, mae double, last_mae double, pruned_after int, rounds int, learning_rate double, max_depth int, "
              "row_share double, column_share double")
    return folded.sparkSession.createDataFrame(out, schema).orderBy(F.col("mae").asc_nulls_last(), "trial")


# ---- scoring and storage

def base_predictions(models: dict[str, PipelineModel | BoostedModel], df: DataFrame) -> DataFrame:
    for name, model in models.items():
        df = predict(model, df, name)
    return df


def score_batch(requests: DataFrame, models: dict[str, PipelineModel | BoostedModel], stack: Stack) -> DataFrame:
    """Base predictions, their stack, business rules, bounds and interval for every request."""
    from pricetide.operators.pricing import recommend

    df = base_predictions(models, requests).withColumn("ensemble_prediction", stack.column())
    names = list(models)
    return recommend(df, "ensemble_prediction", names).withColumns({
        "model_predictions": F.struct(*[py_round(n, 2).alias(n) for n in names]),
        "ensemble_prediction": py_round("ensemble_prediction", 2)})


def save_model(model: PipelineModel | BoostedModel, path: str) -> None:
    if isinstance(model, BoostedModel):
        model.save(SparkSession.getActiveSession(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | BoostedModel:
    spark = SparkSession.getActiveSession()
    trees = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/trees")
    if trees.getFileSystem(spark._jsc.hadoopConfiguration()).exists(trees):
        return BoostedModel.load(spark, path)
    return PipelineModel.load(path)


def save_metadata(metrics: DataFrame, path: str, features: list[str], params: dict, data_hash: str) -> None:
    """One JSON record: when, with what, on what and how well."""
    row = metrics.withColumns({
        "training_date": F.current_timestamp(), "data_hash": F.lit(data_hash),
        "feature_list": F.array(*[F.lit(f) for f in features]),
        "best_params": F.create_map(*[F.lit(str(x)) for kv in params.items() for x in kv])})
    row.write.mode("overwrite").json(path)
