"""Windowed demand over event streams.  Every function takes a batch or a streaming frame with ``ts``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.config import SETTINGS, Settings
from pricetide.functions.core import exact_sum
from pricetide.functions.rules import live_inventory_ratio

# Sliding demand window.
WINDOW, SLIDE = "5 minutes", "1 minute"


def parse_time(column) -> Column:
    """ISO text, with ``Z``, an offset or neither, as a timestamp; anything else is NULL."""
    return F.try_to_timestamp(F.col(column) if isinstance(column, str) else column)


def typed_events(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Parsed records with event time and defaults: quantity 1, price 0.  Rows without key or time go."""
    key = "stock_code" if "stock_code" in df.columns else "sku_id"
    out = df.withColumn("ts", parse_time(time)).drop(time)
    defaults = {"quantity": F.lit(1), "price": F.lit(0.0)}
    out = out.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items() if c in out.columns})
    return out.filter(F.col(key).isNotNull() & F.col("ts").isNotNull())


def late_after(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """Event time with the engine's tolerance for late rows (no effect on a batch frame)."""
    return df.withWatermark("ts", s.watermark) if df.isStreaming else df


def sliding_demand(events: DataFrame) -> DataFrame:
    """Orders, revenue and mean price per SKU in 5-minute windows that slide by a minute.

    Rows combine per window and SKU before the shuffle, so a hot SKU costs one row per task and window.
    """
    price = F.coalesce("price", F.lit(0.0))
    out = late_after(events).withColumn("price", price).groupBy(F.window("ts", WINDOW, SLIDE), "sku_id").agg(
        F.count(F.lit(1)).alias("order_count"), exact_sum("price").alias("revenue"))
    return out.select("window", "sku_id", F.col("window.end").alias("window_end"), "order_count", "revenue",
                      (F.col("revenue") / F.col("order_count")).alias("avg_price"))


def click_demand(events: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Distinct click times per SKU over the days before ``as_of``."""
    recent = events.filter((F.col("ts") > as_of - F.expr(f"interval {days} days")) & (F.col("ts") <= as_of))
    return recent.groupBy("sku_id").agg(F.countDistinct("ts").alias("demand_score_7d"))


def click_days(events: DataFrame) -> DataFrame:
    """Distinct click times per SKU and day, as batch or stream: a click is in one bucket, and each bucket's state goes
    once the watermark has passed its day.  Days end with midnight itself, so that seven of them are the 7 days of
    ``click_demand``."""
    once = late_after(events).dropDuplicates(["sku_id", "ts"])
    return once.groupBy(F.window("ts", "1 day", startTime="1 microsecond"), "sku_id").agg(
        F.count(F.lit(1)).alias("clicks")).select(
        F.timestamp_micros(F.unix_micros("window.end") - 1).alias("day_end"), "sku_id", "clicks")


def click_demand_of_days(days: DataFrame, as_of: Column, n: int = 7) -> DataFrame:
    """``click_demand`` as of a midnight, from the buckets that end in the last ``n`` days."""
    recent = days.filter((F.col("day_end") > as_of - F.expr(f"interval {n} days")) & (F.col("day_end") <= as_of))
    return recent.groupBy("sku_id").agg(F.sum("clicks").alias("demand_score_7d"))


def order_counter(events: DataFrame) -> DataFrame:
    return events.groupBy("sku_id").agg(F.count(F.lit(1)).alias("demand_orders"))


def inventory_latest(events: DataFrame, as_of: Column | None = None, s: Settings = SETTINGS,
                     ttl: int | None = None) -> DataFrame:
    """The last inventory ratio of each SKU; with ``as_of`` only those still alive then."""
    if as_of is not None:
        events = events.filter(F.col("ts") <= as_of)
    ratio = live_inventory_ratio("current_stock", "avg_daily_demand")
    last = F.max_by(F.struct(ratio.alias("inventory_ratio"), "ts"), F.struct("ts", "event_id")).alias("_r")
    out = events.groupBy("sku_id").agg(last).select("sku_id", "_r.*")
    if as_of is None:
        return out
    life = (s.ttl_inventory if ttl is None else ttl) * 1_000_000
    return out.filter(F.unix_micros("ts") + life > F.unix_micros(as_of))
