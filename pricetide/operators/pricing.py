"""Price decisions over request tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.config import SETTINGS, Settings
from pricetide.functions import rules as R
from pricetide.functions.calendar import calendar_flags, calendar_parts
from pricetide.functions.core import fixed, flag, py_round, ratio

# Stand-ins for model inputs that a request does not carry.
PLACEHOLDERS = {"freight_value": 15.0, "hour_sin": 0.5, "hour_cos": 0.8, "day_sin": 0.7, "day_cos": 0.7,
                "is_weekend": 0, "is_month_end": 0, "is_holiday": 0, "days_since_last_order": 2.0,
                "demand_velocity": 0.05, "price_percentile_in_category": 0.5, "competitor_delta": 0.0,
                "review_elasticity": 1.0}


# Fixed value: what a request without quantity asks for; without country it comes from the home country.
DEFAULT_QUANTITY = 1


# ---- validation

def _broken(checks: dict[str, Column]) -> Column:
    """Names of the rules a row breaks; a missing value breaks its rule."""
    named = [F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()]
    return F.filter(F.array(*named), lambda n: n.isNotNull())


def validate_rule_requests(df: DataFrame) -> DataFrame:
    return df.withColumn("broken_rules", _broken({
        "inventory_level": F.col("inventory_level").between(0, 1),
        "demand_score": F.col("demand_score").between(0, 1000),
        "customer_segment": F.col("customer_segment").between(0, 4),
        "cost_price": F.col("cost_price").isNotNull(), "msrp": F.col("msrp").isNotNull()}))


def validate_model_requests(df: DataFrame) -> DataFrame:
    return df.withColumn("broken_rules", _broken({
        "current_price": (F.col("current_price") > 0) & (F.col("current_price") < 10000),
        "quantity": F.coalesce("quantity", F.lit(DEFAULT_QUANTITY)) >= 1, "stock_code": F.col("stock_code").isNotNull()}))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = F.size("broken_rules") == 0
    return df.filter(good).drop("broken_rules"), df.filter(~good)


def batch_sizes(df: DataFrame, batch: str, s: Settings = SETTINGS) -> DataFrame:
    """Size of each request batch and whether it is within the limit."""
    sizes = df.groupBy(batch).agg(F.count(F.lit(1)).alias("requests"))
    return sizes.withColumn("accepted", F.col("requests") <= s.batch_limit)


# ---- rule pricing

def request_context(requests: DataFrame) -> DataFrame:
    """A request as model inputs, with stand-ins for what it does not say."""
    return requests.withColumns({
        "inventory_ratio": F.col("inventory_level"), "demand_score_7d": F.col("demand_score"),
        "demand_score_30d": F.col("demand_score") * 3, "price": F.col("msrp") * 0.8,
        "cost": F.col("cost_price"), **{k: F.lit(v) for k, v in PLACEHOLDERS.items()}})


def price_decision(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """Inventory, demand, competitor, flash sale, segment and guardrails, in this order.

    Needs base_price, inventory_ratio, demand_score_7d, competitor_price, is_flash_sale,
    customer_segment, cost and msrp; a missing cost or msrp is taken from the base price.
    """
    base, flash = F.col("base_price"), F.coalesce("is_flash_sale", F.lit(False))
    df = df.withColumns({
        "_inv": R.inventory_multiplier("inventory_ratio", s), "_dem": R.demand_multiplier("demand_score_7d"),
        "_seg": R.segment_multiplier(F.coalesce("customer_segment", F.lit(2)))})
    df = df.withColumn("_p", base * F.col("_inv") * F.col("_dem"))
    df = df.withColumn("_p", R.competitor_blend("_p", "competitor_price", s))
    df = df.withColumn("_p", F.col("_p") * R.flash_multiplier(flash, s) * F.col("_seg"))
    df = df.withColumn("final_price", R.guardrails(
        "_p", F.coalesce(F.col("cost"), base * 0.7), F.coalesce(F.col("msrp"), base * 1.5), s))
    shown = py_round("_dem", 3)
    guarded = F.col("final_price") != F.col("_p")
    multipliers = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("inventory").alias("key"), F.col("_inv").alias("value")),
        F.struct(F.lit("demand").alias("key"), shown.alias("value")),
        F.when(flash, F.struct(F.lit("flash_sale").alias("key"), F.lit(s.flash_factor).alias("value"))),
        F.struct(F.lit("segment").alias("key"), F.col("_seg").alias("value"))), lambda e: e.isNotNull()))

    def note(label: str, factor: Column) -> Column:
        text = F.concat(F.lit(f"{label} adjustment: "), factor.cast("string"), F.lit("x. "))
        return F.when(factor != 1.0, text).otherwise("")

    reasoning = F.concat(
        F.format_string("Base ML: INR %s. ", fixed(base, 2)), note("Inventory", F.col("_inv")), note("Demand", shown),
        F.when(flash, "Flash sale boost applied. ").otherwise(""), note("Segment", F.col("_seg")),
        F.when(guarded, "Guardrails applied.").otherwise(""))
    return df.withColumns({
        "multipliers_applied": multipliers, "reasoning": reasoning, "applied_guardrail": guarded,
        "confidence_interval": F.struct((F.col("final_price") * 0.95).alias("low"),
                                        (F.col("final_price") * 1.05).alias("high")),
    }).drop("_inv", "_dem", "_seg", "_p")


def engine_price(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """The short pipeline: blend with the competitor, then guardrails around the current price."""
    df = df.withColumn("blended_price", R.competitor_blend("ml_price", "competitor_price", s))
    cost, msrp = F.coalesce("cost", F.col("price") * 0.8), F.coalesce("msrp", F.col("price") * 1.2)
    return df.withColumn("final_price", R.guardrails("blended_price", cost, msrp, s)).withColumn(
        "applied_guardrail", F.col("final_price") != F.col("blended_price"))


# ---- model pricing

def product_lookup(requests: DataFrame, stats: DataFrame) -> DataFrame:
    """Requests with their product's statistics, where known.  Neither side is assumed small; the
    run-time size check decides the join."""
    return requests.join(stats, "stock_code", "left")


def request_features(requests: DataFrame, stats: DataFrame, names: list[str], now: Column | None = None,
                     s: Settings = SETTINGS) -> DataFrame:
    """Model inputs of each request; unknown products get defaults around the current price and inputs
    nobody knows become 0.  The product's own price range stays apart, as known_price_min and _max."""
    when = F.coalesce("timestamp", now if now is not None else F.current_timestamp())
    df = product_lookup(requests, stats).withColumn("_t", when)
    df = df.withColumns({
        **calendar_parts("_t"), **calendar_flags("_t"),
        "known_price_min": F.col("product_price_min"), "known_price_max": F.col("product_price_max"),
        "product_avg_price_global": F.coalesce("product_avg_price_global", "current_price"),
        "product_price_std": F.coalesce("product_price_std", F.lit(0.1)),
        "product_popularity_rank": F.coalesce("product_popularity_rank", F.lit(1)),
        "is_bulk": flag(F.coalesce("quantity", F.lit(DEFAULT_QUANTITY)) >= s.bulk_quantity),
        "is_uk": flag(F.coalesce("country", F.lit(s.home_country)) == s.home_country),
    }).withColumn("price_vs_product_mean", ratio("current_price", "product_avg_price_global"))
    inputs = {n: F.coalesce(F.col(n), F.lit(0)) if n in df.columns else F.lit(0.0) for n in names}
    return df.withColumns(inputs).drop("_t")


def recommend(df: DataFrame, ensemble: str, predictions: list[str], low: str = "known_price_min",
              high: str = "known_price_max", s: Settings = SETTINGS) -> DataFrame:
    """Adjust, bound and round an ensemble price, with its interval, notes and reason."""
    price = R.bound_and_round(R.business_price(ensemble), low, high, "current_price", s)
    df = df.withColumn("recommended_price", price).withColumn("_sd", R.ensemble_spread(predictions))
    return df.withColumns({
        "price_change_pct": py_round(R.change_pct("recommended_price", "current_price"), 2),
        "confidence_low": py_round(F.col("recommended_price") - F.col("_sd") * 1.96, 2),
        "confidence_high": py_round(F.col("recommended_price") + F.col("_sd") * 1.96, 2),
        "adjustments_applied": R.business_notes(), "reasoning": R.business_reason()}).drop("_sd")


# ---- explanation and surge

def explain(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("sku_id").alias("sku"), F.round("old_price", 2).alias("old_price"),
        F.round("new_price", 2).alias("new_price"),
        R.explain_price("sku_id", "old_price", "new_price", "demand_score", "inventory_ratio",
                        "competitor_delta").alias("explanation"),
        F.lit(0.94).alias("confidence"))


def surge_price(df: DataFrame, category_stats: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """All surge factors, the final price, its band by the category's deviation, floor and ceiling."""
    factors = R.surge_factors("inventory_ratio", "demand_score", "is_flash_sale", "weather", "fleet", s)
    df = df.withColumns(factors)
    price = F.col("ml_price")
    for name in factors:
        price = price * F.col(name)
    df = df.withColumn("final_price", price).join(category_stats, "category", "left")
    p = F.col("final_price")
    return df.withColumns({"band_low": p - F.col("std"), "band_high": p + F.col("std"),
                           "price_floor": p * 0.85, "price_ceiling": p * 1.5})


def adjustment_breakdown(df: DataFrame, key: str = "sku_id") -> DataFrame:
    """One row per step: its value and its impact in whole percent (truncated)."""
    def impact(c: str) -> Column:
        pct = ((F.col(c) - 1) * 100).cast("int")
        return F.concat(F.when(F.col(c) > 1, "+").otherwise(""), pct.cast("string"), F.lit("%"))

    def step(name: str, value: Column, effect) -> Column:
        return F.struct(F.lit(name).alias("step"), value.alias("value"),
                        (effect if isinstance(effect, Column) else F.lit(effect)).alias("impact"))

    def money(c: str) -> Column:
        return F.concat(F.lit("₹"), fixed(c, 2))

    def times(c: str) -> Column:
        return F.concat(F.lit("x"), F.col(c).cast("string"))

    steps = F.array(
        step("Base ML Price", money("ml_price"), "-"),
        step("Inventory Mult.", times("inventory_mult"), impact("inventory_mult")),
        step("Demand Mult.", times("demand_mult"), impact("demand_mult")),
        step("Flash Sale", times("flash_mult"), impact("flash_mult")),
        step("Weather Surge", times("weather_mult"), impact("weather_mult")),
        step("Fleet Surge", F.concat(F.lit("x"), fixed("fleet_mult", 2)), impact("fleet_mult")),
        step("Final Price", money("final_price"), "Total Recommendation"))
    return df.select(key, F.posexplode(steps).alias("position", "_s")).select(key, "position", "_s.*")


def demand_curve(stats: DataFrame, points: int = 50) -> DataFrame:
    """Estimated demand over a price grid around each product's mean: a logistic with its midpoint there.

    A midpoint of 12 gives the grid 5..20 and the curve 200 / (1 + e^{(p - 12) / 2}).
    """
    mid = F.col("product_avg_price_global")
    grid = stats.select("stock_code", mid, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    price = mid * (F.lit(5.0) + F.lit(15.0) * F.col("point") / F.lit(float(points - 1))) / F.lit(12.0)
    return grid.withColumn("price", price).withColumn(
        "demand", F.lit(200.0) / (F.lit(1.0) + F.exp(F.lit(6.0) * (F.col("price") / mid - 1)))).drop(
        "product_avg_price_global")
