"""The marketplace job: star to features and a tuned, gated model; and price requests by rules."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.config import SETTINGS, Settings
from pricetide.functions.calendar import holidays_of
from pricetide.operators import evaluation, models
from pricetide.operators.boosting import BoostedModel
from pricetide.operators.feature_store import latest_valid, merge_live_context, wide_features
from pricetide.operators.marketplace import KEY, SEQ, TS, build_feature_base, build_market_features
from pricetide.operators.pricing import price_decision, request_context, split_valid, validate_rule_requests
from pricetide.operators.splits import chrono_split, time_series_folds
from pricetide.operators.windows import heavy_keys
from pricetide.sources.readers import load_or_build
from pricetide.sources.schemas import MARKET_FEATURES, MARKET_TARGET, validate_schema
from pricetide.sources.sinks import audit_log, price_update_messages


def features(spark: SparkSession, star: dict[str, DataFrame], folder: str,
             s: Settings = SETTINGS) -> DataFrame:
    base = load_or_build(spark, f"{folder}/base", lambda: build_feature_base(star))
    heavy = heavy_keys(base, KEY, s.heavy_rows)
    return load_or_build(spark, f"{folder}/features",
                         lambda: build_market_features(base, holidays_of(base, TS), heavy))


def train(table: DataFrame, trials: int = 50, folds: int = 5, rounds: int | None = None,
          s: Settings = SETTINGS) -> tuple[BoostedModel, DataFrame, DataFrame]:
    """Chronological 80/20, tuning over expanding folds, final fit, metrics and the worst categories.

    Raises where the error is above the retrain limit."""
    validate_schema(table, [*MARKET_FEATURES, MARKET_TARGET, "category", TS])
    split = chrono_split(table, TS, SEQ)
    train_rows, test_rows = (split.filter(F.col("split") == p).drop("split") for p in ("train", "test"))
    draws = models.draw_trials(trials)
    ranked = models.tune_time_series(time_series_folds(train_rows, TS, SEQ, folds), MARKET_FEATURES, MARKET_TARGET,
                                     draws, folds=folds, rounds=rounds)
    best = draws[ranked.first()["trial"]]
    model = models.train_boosted(train_rows, MARKET_FEATURES, MARKET_TARGET, best, rounds)
    scored = models.predict(model, test_rows).select(
        F.lit("boosted").alias("model"), "category", F.col(MARKET_TARGET).alias("actual"), "predicted")
    metrics = evaluation.regression_metrics(scored)
    mae = metrics.first()["mae"]
    if mae > s.retrain_mae:
        raise ValueError(f"test error {mae:.4f} is above the limit {s.retrain_mae}")
    return model, metrics, evaluation.category_mae(scored)


def price(requests: DataFrame, log: DataFrame, as_of: Column, model: BoostedModel,
          s: Settings = SETTINGS) -> tuple[DataFrame, DataFrame]:
    """Validated requests with live features over their own values, a model price and the price rules.

    Also returns the requests that break a rule."""
    good, bad = split_valid(validate_rule_requests(requests))
    live = wide_features(latest_valid(log, as_of))
    context = merge_live_context(request_context(good), live)
    priced = models.predict(model, context, "base_price")
    return price_decision(priced, s).withColumn("timestamp", as_of), bad


def deliver(decisions: DataFrame, audit_path: str, fmt: str = "kafka", run: str | None = None, **options) -> None:
    """Audit log and price-update records.  A run that is repeated under its name replaces its part of the log."""
    rows = decisions.select("sku_id", "base_price", "final_price", "multipliers_applied", "reasoning", "timestamp")
    audit_log(rows, audit_path, run or uuid.uuid4().hex)
    price_update_messages(rows).write.format(fmt).mode("append").options(**options).save()
