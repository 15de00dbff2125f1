"""Price rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricetide.config import SETTINGS, Settings
from pricetide.functions.core import clip, col, fixed, py_round, ratio

# Multiplier per customer segment, surge per weather, sigmoid of the demand multiplier.
SEGMENT_FACTORS = {0: 0.95, 1: 0.98, 2: 1.00, 3: 1.05, 4: 1.10}
WEATHER_FACTORS = {"Clear": 1.0, "Rain": 1.05, "Heavy Rain/Snow": 1.15, "Extreme": 1.30}
DEMAND_LOW, DEMAND_HIGH, DEMAND_MIDPOINT, DEMAND_STEEPNESS = 0.90, 1.35, 500, 0.005

# Sentences of the price explanation.
SURGE_TEXT = (
    "The price for %s was %s by %s%% to balance exceptionally high demand against critically low inventory "
    "levels (%s%% remaining). This proactive adjustment prevents imminent stockouts while optimizing revenue "
    "capture during the demand surge.")
COMPETITOR_TEXT = (
    "We %s the price of %s by %s%% to directly address aggressive competitor actions. Key competitors recently "
    "dropped their prices by %s%%, and this adjustment ensures we retain our market share while respecting "
    "margin floors.")
OVERSTOCK_TEXT = (
    "The price was strategically %s by %s%% to stimulate sales velocity for slow-moving stock. With inventory "
    "sitting at %s%%, this promotional pricing prevents capital lock-up and reduces holding costs.")
STABLE_TEXT = (
    "The algorithm gently %s the price of %s by %s%% based on routine predictive modeling. Current inventory and "
    "demand signals are highly stable, allowing for slight margin optimization without risking conversion drop-offs.")


def _lookup(table: dict, key: Column, default: float) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key),
                      F.lit(default))


# ---- rule pricing

def inventory_multiplier(level, s: Settings = SETTINGS) -> Column:
    x = col(level)
    return F.when(x < 0.1, 1.20).when(x < 0.3, 1.10).when(x > 0.9, s.excess_factor).otherwise(1.0)


def demand_multiplier(score) -> Column:
    """A sigmoid between the low and high factor."""
    spread = DEMAND_HIGH - DEMAND_LOW
    return F.lit(DEMAND_LOW) + F.lit(spread) / (
        F.lit(1.0) + F.exp(F.lit(-DEMAND_STEEPNESS) * (col(score) - DEMAND_MIDPOINT)))


def competitor_blend(own, rival, s: Settings = SETTINGS) -> Column:
    own, rival = col(own), col(rival)
    mixed = own * (1.0 - s.competitor_share) + rival * s.competitor_share
    return F.when(rival.isNull() | F.isnan(rival), own).otherwise(mixed)


def flash_multiplier(is_flash, s: Settings = SETTINGS) -> Column:
    return F.when(col(is_flash), s.flash_factor).otherwise(1.0)


def segment_multiplier(segment) -> Column:
    return _lookup(SEGMENT_FACTORS, col(segment), 1.0)


def guardrails(price, cost, msrp, s: Settings = SETTINGS) -> Column:
    return clip(price, col(cost) * s.floor_margin, col(msrp) * s.ceiling_factor)


def blend_models(first, second) -> Column:
    return col(first) * 0.7 + col(second) * 0.3


# ---- model pricing

def business_price(price, factors="adjustment_factors") -> Column:
    """The three business adjustments in order; a missing factor leaves the price alone."""
    f = col(factors)
    p = col(price)
    p = F.when(f["stockout_risk"] > 0.7, p * (F.lit(1.0) + f["stockout_risk"] * 0.2)).otherwise(p)
    p = F.when(f["flash_sale"], p * 0.85).otherwise(p)
    return F.when(f["inventory_excess"] > 0.7, p * (F.lit(1.0) - f["inventory_excess"] * 0.15)).otherwise(p)


def business_notes(factors="adjustment_factors") -> Column:
    f = col(factors)
    notes = F.array(
        F.when(f["stockout_risk"] > 0.7, F.format_string("Stockout Risk (+%s%%)", fixed(f["stockout_risk"] * 20, 1))),
        F.when(f["flash_sale"], F.lit("Flash Sale (-15%)")),
        F.when(f["inventory_excess"] > 0.7, F.format_string("Inventory Excess (-%s%%)", fixed(f["inventory_excess"] * 15, 1))))
    return F.filter(notes, lambda n: n.isNotNull())


def business_reason(factors="adjustment_factors") -> Column:
    f = col(factors)
    return F.concat(
        F.lit("Base ML recommendation based on ensemble of 4 models."),
        F.when(f["stockout_risk"] > 0.7, " Price increased due to high stockout risk.").otherwise(""),
        F.when(f["flash_sale"], " Applied discount to drive volume during flash sale.").otherwise(""),
        F.when(f["inventory_excess"] > 0.7, " Price lowered to clear excess inventory.").otherwise(""))


def bound_and_round(price, low, high, current, s: Settings = SETTINGS) -> Column:
    """Half the lowest to one and a half times the highest known price, on the 0.05 grid (halves to even)."""
    low = F.coalesce(col(low), col(current) * 0.5)
    high = F.coalesce(col(high), col(current) * 1.5)
    return F.bround(clip(price, low * 0.5, high * 1.5) * s.price_grid) / F.lit(float(s.price_grid))


def change_pct(new, old) -> Column:
    return ratio(col(new) - col(old), old) * 100


def ensemble_spread(predictions: list) -> Column:
    """Population standard deviation of a few prediction columns."""
    n = float(len(predictions))
    cols = [col(p) for p in predictions]
    mean = sum(cols[1:], cols[0]) / n
    return F.sqrt(sum(((c - mean) * (c - mean) for c in cols[1:]), (cols[0] - mean) * (cols[0] - mean)) / n)


# ---- explanation

def explain_price(sku, old, new, demand, inventory, rival_delta) -> Column:
    sku, old, new = col(sku), col(old), col(new)
    demand, inventory, delta = col(demand), col(inventory), col(rival_delta)
    way = F.when(new > old, "increased").otherwise("decreased")
    pct = fixed(F.abs((new - old) / F.greatest(old, F.lit(1.0))) * 100, 1)
    level = fixed(inventory * 100, 0)
    return (F.when((demand > 300) & (inventory < 0.3), F.format_string(SURGE_TEXT, sku, way, pct, level))
            .when(delta < -0.05, F.format_string(COMPETITOR_TEXT, way, sku, pct, fixed(F.abs(delta * 100), 1)))
            .when((inventory > 0.8) & (demand < 100), F.format_string(OVERSTOCK_TEXT, way, pct, level))
            .otherwise(F.format_string(STABLE_TEXT, way, sku, pct)))


def price_zone(price, cost, msrp, s: Settings = SETTINGS) -> Column:
    p = col(price)
    return (F.when(p < col(cost) * s.floor_margin, "below_floor").when(p <= col(msrp), "target")
            .otherwise("above_msrp"))


# ---- surge breakdown

def surge_factors(inventory, demand, is_flash, weather, fleet, s: Settings = SETTINGS) -> dict[str, Column]:
    return {
        "inventory_mult": F.when(col(inventory) < 0.2, 1.10).otherwise(1.0),
        "demand_mult": F.when(col(demand) > 500, 1.05).otherwise(1.0),
        "flash_mult": flash_multiplier(is_flash, s),
        "weather_mult": _lookup(WEATHER_FACTORS, col(weather), 1.0),
        "fleet_mult": F.lit(1.0) + (F.lit(1.0) - col(fleet)) * 0.4,
    }


# ---- spikes and stock

def severity(spike_ratio) -> Column:
    r = col(spike_ratio)
    return F.when(r >= 5.0, "CRITICAL").when(r >= 3.0, "HIGH").when(r >= 2.0, "MEDIUM").otherwise("LOW")


def spike_multiplier(spike_ratio) -> Column:
    return F.least(F.lit(1.0) + F.ln(col(spike_ratio)) * 0.1, F.lit(1.40))


def live_inventory_ratio(stock, daily_demand) -> Column:
    return py_round(col(stock) / (F.greatest(col(daily_demand), F.lit(1.0)) * 7), 4)
