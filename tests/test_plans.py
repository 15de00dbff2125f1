"""The jobs from source tables to prices on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from pricetide.config import Settings
from pricetide.plans import market, retail
from pricetide.sources.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_retail_job(spark, tmp_path):
    w = Warehouse(spark, FOLDER)
    # the heaviest products take the sliced way
    s = Settings(heavy_rows=20)
    out = retail.stages(spark, [w.two_sources()], w.competitor_prices(), str(tmp_path / "stages"), s)
    plain = retail.stages(spark, [w.two_sources()], w.competitor_prices(), str(tmp_path / "plain"))
    names = sorted(out["table"].columns)
    assert out["table"].select(names).exceptAll(plain["table"].select(names)).count() == 0
    assert out["table"].count() == plain["table"].count() > 0
    trained = retail.train(out["table"], "2000-01-01", "2001-01-01", rounds=2, trees=2)
    assert not {"forward_demand_7d", "optimal_price_historical", "target_price"} & set(trained.features)
    assert {r["model"] for r in trained.metrics.collect()} == {*retail.MODEL_NAMES, "stack"}
    retail.save(trained, out["table"], str(tmp_path / "models"))
    good, bad = retail.price(w.model_requests(), trained, out["profile"])
    total = w.model_requests().count()
    assert good.count() + bad.count() == total and bad.count() > 0
    row = good.first()
    assert row["confidence_low"] <= row["recommended_price"] <= row["confidence_high"]


def test_market_job(spark, tmp_path):
    w = Warehouse(spark, FOLDER)
    table = market.features(spark, w.star(), str(tmp_path / "stages"))
    with pytest.raises(ValueError, match="above the limit"):
        market.train(table, trials=1, folds=1, rounds=1, s=Settings(retrain_mae=0.0))
    model, metrics, worst = market.train(table, trials=1, folds=1, rounds=1, s=Settings(retrain_mae=1e9))
    assert metrics.first()["mae"] > 0 and worst.count() == 5
    log = w.feature_log().withColumn("ttl_seconds", F.col("ttl_seconds") * 3600)
    as_of = F.lit("2024-01-15 12:00:00").cast("timestamp")
    good, bad = market.price(w.rule_requests(), log, as_of, model)
    assert good.count() + bad.count() == w.rule_requests().count()
    low, high = F.col("cost") * 1.05, F.col("msrp") * 1.5
    assert good.filter((F.col("final_price") < low) | (F.col("final_price") > high)).count() == 0
    market.deliver(good, str(tmp_path / "audit"), "json", path=str(tmp_path / "updates"))
    assert spark.read.json(str(tmp_path / "updates")).count() == good.count()
