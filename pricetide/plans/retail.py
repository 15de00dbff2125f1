"""The retail job: sources to cleaned sales, features, targets, four models and their stack."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.config import SETTINGS, Settings
from pricetide.operators import evaluation, models
from pricetide.operators.boosting import BoostedModel
from pricetide.operators.cleaning import clean_sales
from pricetide.operators.pricing import request_features, split_valid, validate_model_requests
from pricetide.operators.profiling import data_fingerprint
from pricetide.operators.sales_features import KEY, build_features, product_stats, popularity_rank
from pricetide.operators.splits import time_split
from pricetide.operators.targets import create_target
from pricetide.operators.windows import heavy_keys
from pricetide.sources.readers import load_or_build, union_sources

MODEL_NAMES = ("xgb", "lgbm", "rf", "catboost")


def stages(spark: SparkSession, sources: list[DataFrame], competitors: DataFrame, folder: str,
           s: Settings = SETTINGS) -> dict[str, DataFrame]:
    """Every stage as Parquet under ``folder`` (shared storage); stages already there are read."""
    def stage(name, build):
        return load_or_build(spark, f"{folder}/{name}", build)

    raw = stage("raw_combined", lambda: union_sources(sources))
    clean = stage("cleaned", lambda: clean_sales(raw, s))
    heavy = heavy_keys(clean, KEY, s.heavy_rows)
    features = stage("features", lambda: build_features(clean, competitors, s, heavy))
    table = stage("features_with_targets", lambda: create_target(features, s, heavy))
    profile = stage("product_stats", lambda: popularity_rank(product_stats(clean)))
    return {"clean": clean, "features": features, "table": table, "profile": profile}


@dataclass
class Trained:
    models: dict[str, PipelineModel | BoostedModel]
    stack: models.Stack
    features: list[str]
    metrics: DataFrame


def train(table: DataFrame, valid_from: str, test_from: str, rounds: int | None = None, trees: int | None = None,
          target: str = "target_price") -> Trained:
    """Time split, four learners on scaled features, a stack on the validation part, metrics on the test part.

    Feature names leave out everything that looks ahead of the sale."""
    split = time_split(table, "invoice_date", valid_from, test_from)
    part = {name: split.filter(F.col("split") == name) for name in ("train", "valid", "test")}
    names = models.feature_names(table)
    fitted = models.train_boosters(part["train"], names, target, models.BOOSTED, rounds, part["valid"])
    fitted["rf"] = models.train_forest(part["train"], names, target, trees=trees, scale=True)
    fitted = {n: fitted[n] for n in MODEL_NAMES}
    stack = models.stack_nonneg_ridge(models.base_predictions(fitted, part["valid"]), list(fitted), target)
    scored = models.base_predictions(fitted, part["test"]).withColumn("stack", stack.column())
    long = scored.select(F.col(target).alias("actual"), *fitted, "stack").unpivot(
        ["actual"], [*fitted, "stack"], "model", "predicted")
    return Trained(fitted, stack, names, evaluation.regression_metrics(long))


def save(trained: Trained, table: DataFrame, folder: str) -> None:
    for name, model in trained.models.items():
        models.save_model(model, f"{folder}/{name}")
    digest = data_fingerprint(table).first()["shape_hash"]
    models.save_metadata(trained.metrics, f"{folder}/metadata", trained.features, trained.stack.weights, digest)


def price(requests: DataFrame, trained: Trained, profile: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Recommendations for the valid requests, and the others with the rules they break."""
    good, bad = split_valid(validate_model_requests(requests))
    return models.score_batch(request_features(good, profile, trained.features), trained.models, trained.stack), bad
