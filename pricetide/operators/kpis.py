"""Operations panels over decisions; the same functions serve batch tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricetide.functions.core import exact_sum


def decision_panels(decisions: DataFrame, width: str = "1 minute") -> DataFrame:
    """Revenue, mean margin, decisions, flash sales and cache hits per tumbling window."""
    margin = F.try_divide(F.col("final_price") - F.col("cost"), F.col("final_price")) * 100
    return decisions.groupBy(F.window("ts", width)).agg(
        exact_sum("final_price").alias("revenue"), F.avg(margin).alias("mean_margin_pct"),
        F.count(F.lit(1)).alias("decisions"), F.count_if("is_flash_sale").alias("flash_sales"),
        (F.count_if("cached") / F.count(F.lit(1)) * 100).alias("cache_hit_pct"),
    ).select(F.col("window.start").alias("window_start"), "revenue", "mean_margin_pct", "decisions", "flash_sales",
             "cache_hit_pct")


def hourly_error(decisions: DataFrame, width: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Mean absolute error of the model over the last hour, sliding."""
    return decisions.groupBy(F.window("ts", width, slide)).agg(
        F.avg(F.abs(F.col("actual_price") - F.col("final_price"))).alias("mae")).select(
        F.col("window.end").alias("window_end"), "mae")
