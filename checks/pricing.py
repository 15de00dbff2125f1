"""Queries on price rules, requests and the feature store."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sales as Q
from checks.registry import ORACLES, register, with_ctes
from pricetide.functions import rules as R
from pricetide.operators import feature_store as FS
from pricetide.operators import pricing as P
from pricetide.operators import sales_features as S
from pricetide.operators.profiling import top_k
from pricetide.sources.warehouse import Warehouse

RULES = """
rule_requests as (select 'P' || p_partkey as sku_id, (p_size - 1) / 48::double as inventory_level,
  p_partkey / 1.9::double as demand_score, cast(p_partkey % 6 as int) as customer_segment,
  p_brand = 'Brand#1' as is_flash_sale, p_retailprice * 1.5 as cost_price, p_retailprice * 2.5 as msrp,
  p_retailprice * 2 as base_price, case when p_type <> 'SMALL' then p_retailprice * 2.25 end as competitor_price,
  p_type, p_size, p_partkey from part)
"""
MODELS = """
model_requests as (select 'P' || p_partkey as stock_code, p_retailprice * (p_size - 1) as current_price,
  case when p_size <> 5 then p_size - 2 end as quantity, case when p_type = 'PROMO' then 'United Kingdom'
  when p_brand <> 'Brand#2' then 'NATION_1' end as country,
  timestamp '2001-01-01 00:00:00' + to_hours(p_size * 9) as ts,
  case when p_type <> 'LARGE' then p_size / 50::double end as risk, p_type <> 'LARGE' and p_brand = 'Brand#2' as flash,
  case when p_type <> 'LARGE' then 1.0::double - p_size / 50::double end as excess from part)
"""


def rules_of(spark, folder):
    w = Warehouse(spark, folder)
    part = w.table("part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("sku_id"), "p_type", "p_size", "p_partkey",
        (F.col("p_retailprice") * 2).alias("base_price"),
        F.when(F.col("p_type") != "SMALL", F.col("p_retailprice") * 2.25).alias("competitor_price"))
    return w.rule_requests().join(part, "sku_id")


def _pick(name, sql, **columns):
    @register(name, with_ctes(RULES, f"select sku_id, {sql} from rule_requests"))
    def run(spark, folder):
        return rules_of(spark, folder).select("sku_id", *[c().alias(n) for n, c in columns.items()])
    return run


_pick("inventory_multiplier", """case when inventory_level < 0.1 then 1.2::double when inventory_level < 0.3 then 1.1::double
when inventory_level > 0.9 then 0.85::double else 1::double end as multiplier""",
      multiplier=lambda: R.inventory_multiplier("inventory_level"))
_pick("demand_multiplier", """round(0.9::double + 0.45::double / (1 + exp(-0.005::double * (demand_score - 500))), 9) as multiplier""",
      multiplier=lambda: F.round(R.demand_multiplier("demand_score"), 9))
_pick("competitor_blend", """case when competitor_price is null then base_price
else base_price * 0.7::double + competitor_price * 0.3::double end as blended""",
      blended=lambda: R.competitor_blend("base_price", "competitor_price"))
_pick("flash_multiplier", "case when is_flash_sale then 1.25::double else 1::double end as multiplier",
      multiplier=lambda: R.flash_multiplier("is_flash_sale"))
_pick("segment_multiplier", """case customer_segment when 0 then 0.95::double when 1 then 0.98::double when 2 then
1::double when 3 then 1.05::double when 4 then 1.1::double else 1::double end as multiplier""",
      multiplier=lambda: R.segment_multiplier("customer_segment"))
_pick("guardrails", """greatest(least(base_price, msrp * 1.5::double), cost_price * 1.05::double) as bounded,
greatest(least(base_price, msrp * 1.5::double), cost_price * 1.05::double) <> base_price as applied""",
      bounded=lambda: R.guardrails("base_price", "cost_price", "msrp"),
      applied=lambda: R.guardrails("base_price", "cost_price", "msrp") != F.col("base_price"))
_pick("blend_models", "base_price * 0.7::double + msrp * 0.3::double as blended",
      blended=lambda: R.blend_models("base_price", "msrp"))
_pick("price_zone", """(base_price - competitor_price) / competitor_price as competitor_delta,
case when base_price < cost_price * 1.05::double then 'below_floor' when base_price <= msrp then 'target'
else 'above_msrp' end as zone""",
      competitor_delta=lambda: (F.col("base_price") - F.col("competitor_price")) / F.col("competitor_price"),
      zone=lambda: R.price_zone("base_price", "cost_price", "msrp"))


@register("validate_requests", with_ctes(RULES, """select sku_id, array_to_string(list_filter([
case when not (inventory_level between 0 and 1) then 'inventory_level' end,
case when not (demand_score between 0 and 1000) then 'demand_score' end,
case when not (customer_segment between 0 and 4) then 'customer_segment' end], lambda x: x is not null), ',') as broken
from rule_requests"""))
def validate_requests(spark, folder):
    df = P.validate_rule_requests(Warehouse(spark, folder).rule_requests())
    return df.select("sku_id", F.concat_ws(",", "broken_rules").alias("broken"))


@register("validate_model_requests", with_ctes(MODELS, """select stock_code, array_to_string(list_filter([
case when not (current_price > 0 and current_price < 10000) then 'current_price' end,
case when coalesce(quantity, 1) < 1 then 'quantity' end], lambda x: x is not null), ',') as broken from model_requests"""))
def validate_model_requests(spark, folder):
    df = P.validate_model_requests(Warehouse(spark, folder).model_requests())
    return df.select("stock_code", F.concat_ws(",", "broken_rules").alias("broken"))


@register("batch_sizes", with_ctes(MODELS, """select country as batch, count(*) as requests, count(*) <= 500 as accepted
from model_requests group by country"""))
def batch_sizes(spark, folder):
    return P.batch_sizes(Warehouse(spark, folder).model_requests().withColumnRenamed("country", "batch"), "batch")


@register("request_context", with_ctes(RULES, """select sku_id, inventory_level as inventory_ratio,
demand_score as demand_score_7d, demand_score * 3 as demand_score_30d, msrp * 0.8::double as price, cost_price as cost,
15::double as freight_value, 2::double as days_since_last_order, 0.05::double as demand_velocity, 0 as is_holiday
from rule_requests"""))
def request_context(spark, folder):
    return P.request_context(Warehouse(spark, folder).rule_requests()).select(
        "sku_id", "inventory_ratio", "demand_score_7d", "demand_score_30d", "price", "cost", "freight_value",
        "days_since_last_order", "demand_velocity", "is_holiday")


DECIDED = RULES + """,
factors as (select *, case when inventory_level < 0.1 then 1.2::double when inventory_level < 0.3 then 1.1::double
  when inventory_level > 0.9 then 0.85::double else 1::double end as inv,
  0.9::double + 0.45::double / (1 + exp(-0.005::double * (demand_score - 500))) as dem,
  case customer_segment when 0 then 0.95::double when 1 then 0.98::double when 3 then 1.05::double
    when 4 then 1.1::double else 1::double end as seg from rule_requests),
scaled as (select *, base_price * inv * dem as p0 from factors),
blended as (select *, case when competitor_price is null then p0 else p0 * 0.7::double + competitor_price * 0.3::double
  end * case when is_flash_sale then 1.25::double else 1 end * seg as p1 from scaled),
decided as (select *, greatest(least(p1, msrp * 1.5::double), cost_price * 1.05::double) as final_price from blended)
"""


def decisions_of(spark, folder):
    df = rules_of(spark, folder).withColumnsRenamed(
        {"inventory_level": "inventory_ratio", "demand_score": "demand_score_7d", "cost_price": "cost"})
    return P.price_decision(df)


@register("price_decision", with_ctes(DECIDED, """select sku_id, base_price, round(final_price, 6) as final_price,
inv as inventory, round(dem, 3) as demand, seg as segment, case when is_flash_sale then 1.25::double end as flash_sale,
round(final_price * 0.95::double, 6) as low, round(final_price * 1.05::double, 6) as high,
printf('Base ML: INR %.2f. ', base_price)
|| case when inv <> 1 then 'Inventory adjustment: ' || cast(inv as varchar) || 'x. ' else '' end
|| case when round(dem, 3) <> 1 then 'Demand adjustment: ' || cast(round(dem, 3) as varchar) || 'x. ' else '' end
|| case when is_flash_sale then 'Flash sale boost applied. ' else '' end
|| case when seg <> 1 then 'Segment adjustment: ' || cast(seg as varchar) || 'x. ' else '' end
|| case when final_price <> p1 then 'Guardrails applied.' else '' end as reasoning from decided"""))
def price_decision(spark, folder):
    m = F.col("multipliers_applied")
    return decisions_of(spark, folder).select(
        "sku_id", "base_price", F.round("final_price", 6).alias("final_price"), m["inventory"].alias("inventory"),
        m["demand"].alias("demand"), m["segment"].alias("segment"), m["flash_sale"].alias("flash_sale"),
        F.round("confidence_interval.low", 6).alias("low"), F.round("confidence_interval.high", 6).alias("high"),
        "reasoning")


@register("engine_price", with_ctes(RULES, """eng as (select *, case when competitor_price is null then base_price else
base_price * 0.7::double + competitor_price * 0.3::double end as blended_price from rule_requests)""", """select sku_id,
blended_price, greatest(least(blended_price, base_price * 1.2::double * 1.5::double), base_price * 0.8::double * 1.05::double)
as final_price, greatest(least(blended_price, base_price * 1.2::double * 1.5::double), base_price * 0.8::double * 1.05::double)
<> blended_price as applied_guardrail from eng"""))
def engine_price(spark, folder):
    none = F.lit(None).cast("double")
    df = rules_of(spark, folder).withColumns({"ml_price": F.col("base_price"), "price": F.col("base_price"),
                                              "cost": none, "msrp": none})
    return P.engine_price(df).select("sku_id", "blended_price", "final_price", "applied_guardrail")


# ---- model pricing

PRICED = Q.STATS + "," + MODELS + """,
asked as (select m.*, s.product_avg_price_global as mean, s.product_price_min as low, s.product_price_max as high
  from model_requests m left join stats s using (stock_code) where current_price > 0 and current_price < 10000),
adjusted as (select *, (current_price * 0.7::double + coalesce(mean, current_price) * 0.3::double)
  * case when risk > 0.7 then 1 + risk * 0.2::double else 1 end * case when flash then 0.85::double else 1 end
  * case when excess > 0.7 then 1 - excess * 0.15::double else 1 end as p from asked),
grid as (select *, round_even(greatest(least(p, coalesce(high, current_price * 1.5::double) * 1.5::double),
  coalesce(low, current_price * 0.5::double) * 0.5::double) * 20, 0) / 20 as recommended_price from adjusted)
"""


def asked_of(spark, folder):
    w = Warehouse(spark, folder)
    stats = S.product_stats(Q.clean_of(spark, folder))
    good, _ = P.split_valid(P.validate_model_requests(w.model_requests()).withColumn(
        "broken_rules", F.filter("broken_rules", lambda r: r == "current_price")))
    df = P.product_lookup(good, stats)
    mean = F.coalesce("product_avg_price_global", "current_price")
    return df.withColumns({"mean": mean, "ensemble": F.col("current_price") * 0.7 + mean * 0.3})


@register("product_lookup", with_ctes(Q.STATS, MODELS, """select stock_code, current_price, product_avg_price_global,
product_price_min, product_price_max from model_requests left join stats using (stock_code)"""))
def product_lookup(spark, folder):
    stats = S.product_stats(Q.clean_of(spark, folder))
    return P.product_lookup(Warehouse(spark, folder).model_requests(), stats).select(
        "stock_code", "current_price", "product_avg_price_global", "product_price_min", "product_price_max")


@register("business_adjust", with_ctes(PRICED, """select stock_code, p as adjusted_price,
array_to_string(list_filter([case when risk > 0.7 then printf('Stockout Risk (+%.1f%%)', risk * 20) end,
case when flash then 'Flash Sale (-15%)' end, case when excess > 0.7 then printf('Inventory Excess (-%.1f%%)', excess * 15)
end], lambda x: x is not null), '; ') as notes, 'Base ML recommendation based on ensemble of 4 models.'
|| case when risk > 0.7 then ' Price increased due to high stockout risk.' else '' end
|| case when flash then ' Applied discount to drive volume during flash sale.' else '' end
|| case when excess > 0.7 then ' Price lowered to clear excess inventory.' else '' end as reasoning from grid"""))
def business_adjust(spark, folder):
    return asked_of(spark, folder).select(
        "stock_code", R.business_price("ensemble").alias("adjusted_price"),
        F.concat_ws("; ", R.business_notes()).alias("notes"), R.business_reason().alias("reasoning"))


@register("bound_and_round", with_ctes(PRICED, """select stock_code, recommended_price,
round((recommended_price - current_price) / current_price * 100, 6) as price_change_pct from grid"""))
def bound_and_round(spark, folder):
    df = asked_of(spark, folder).withColumn("recommended_price", R.bound_and_round(
        R.business_price("ensemble"), "product_price_min", "product_price_max", "current_price"))
    return df.select("stock_code", "recommended_price", F.round(
        R.change_pct("recommended_price", "current_price"), 6).alias("price_change_pct"))


@register("ensemble_interval", with_ctes(PRICED, """spread as (select *, (current_price + coalesce(mean, current_price) + coalesce(low, current_price)
+ coalesce(high, current_price)) / 4 as m from grid), dev as (select *, sqrt(((current_price - m) * (current_price - m)
+ (coalesce(mean, current_price) - m) * (coalesce(mean, current_price) - m)
+ (coalesce(low, current_price) - m) * (coalesce(low, current_price) - m)
+ (coalesce(high, current_price) - m) * (coalesce(high, current_price) - m)) / 4) as sd from spread)""",
                                             """select stock_code, round(recommended_price - sd * 1.96::double, 5) as low,
round(recommended_price + sd * 1.96::double, 5) as high from dev"""))
def ensemble_interval(spark, folder):
    df = asked_of(spark, folder).withColumns({
        "a": F.coalesce("product_price_min", "current_price"), "b": F.coalesce("product_price_max", "current_price")})
    df = df.withColumn("r", R.bound_and_round(R.business_price("ensemble"), "product_price_min", "product_price_max",
                                              "current_price"))
    sd = R.ensemble_spread(["current_price", "mean", "a", "b"]) * 1.96
    return df.select("stock_code", F.round(F.col("r") - sd, 5).alias("low"), F.round(F.col("r") + sd, 5).alias("high"))


@register("request_features", with_ctes(Q.STATS, MODELS, """select stock_code, cast(hour(ts) as int) as hour,
cast(isodow(ts) - 1 as int) as day_of_week, cast(day(ts) as int) as day_of_month, cast(month(ts) as int) as month,
cast(day(ts) >= 28 as int) as is_month_end, coalesce(product_avg_price_global, current_price) as product_avg_price_global,
current_price / nullif(coalesce(product_avg_price_global, current_price), 0) as price_vs_product_mean,
cast(coalesce(quantity, 1) >= 12 as int) as is_bulk,
cast(coalesce(country, 'United Kingdom') = 'United Kingdom' as int) as is_uk, 0::double as rolling_demand_7d
from model_requests left join stats using (stock_code)"""))
def request_features(spark, folder):
    stats = S.popularity_rank(S.product_stats(Q.clean_of(spark, folder)))
    df = P.request_features(Warehouse(spark, folder).model_requests(), stats, ["hour", "rolling_demand_7d"])
    return df.select("stock_code", "hour", "day_of_week", "day_of_month", "month", "is_month_end",
                     "product_avg_price_global", "price_vs_product_mean", "is_bulk", "is_uk", "rolling_demand_7d")


# ---- explanation, surge, curves

def _say(template: str, *args: str) -> str:
    return f"printf('{template}', {', '.join(args)})"


_PCT, _LEVEL = "printf('%.1f', pct)", "printf('%.0f', inventory_level * 100)"
EXPLAIN_SQL = f"""case when demand_score > 300 and inventory_level < 0.3 then
  {_say(R.SURGE_TEXT, "sku_id", "way", _PCT, _LEVEL)}
when delta < -0.05 then {_say(R.COMPETITOR_TEXT, "way", "sku_id", _PCT, "printf('%.1f', abs(delta * 100))")}
when inventory_level > 0.8 and demand_score < 100 then {_say(R.OVERSTOCK_TEXT, "way", _PCT, _LEVEL)}
else {_say(R.STABLE_TEXT, "way", "sku_id", _PCT)} end"""


@register("explain_price", with_ctes(RULES, """told as (select *, base_price * (0.8::double + p_size / 100::double) as new_price,
(p_size - 25) / 100::double as delta from rule_requests)""", """phrased as (select *, case when new_price > base_price
then 'increased' else 'decreased' end as way, abs((new_price - base_price) / greatest(base_price, 1)) * 100 as pct
from told)""", f"""select sku_id as sku, round(base_price, 2) as old_price, round(new_price, 2) as new_price,
{EXPLAIN_SQL} as explanation, 0.94::double as confidence from phrased"""))
def explain_price(spark, folder):
    df = rules_of(spark, folder).withColumns({
        "old_price": F.col("base_price"), "new_price": F.col("base_price") * (F.lit(0.8) + F.col("p_size") / F.lit(100.0)),
        "inventory_ratio": F.col("inventory_level"), "competitor_delta": (F.col("p_size") - 25) / F.lit(100.0)})
    return P.explain(df)


SURGE = RULES + """,
cat_stats as (select p_type as category, avg(p_retailprice) as mean, stddev_samp(p_retailprice) as std from part group by 1),
surged as (select *, case when inventory_level < 0.2 then 1.1::double else 1::double end as inventory_mult,
  case when demand_score > 500 then 1.05::double else 1::double end as demand_mult,
  case when is_flash_sale then 1.25::double else 1::double end as flash_mult,
  case p_type when 'SMALL' then 1.05::double when 'PROMO' then 1.15::double when 'LARGE' then 1.3::double
    else 1::double end as weather_mult, 1 + (1 - inventory_level) * 0.4::double as fleet_mult from rule_requests),
priced as (select *, base_price * inventory_mult * demand_mult * flash_mult * weather_mult * fleet_mult as final_price
  from surged)
"""


def surge_of(spark, folder):
    weather = (F.when(F.col("p_type") == "SMALL", "Rain").when(F.col("p_type") == "PROMO", "Heavy Rain/Snow")
               .when(F.col("p_type") == "LARGE", "Extreme").otherwise("Clear"))
    df = rules_of(spark, folder).withColumns({
        "ml_price": F.col("base_price"), "inventory_ratio": F.col("inventory_level"), "weather": weather,
        "fleet": F.col("inventory_level"), "category": F.col("p_type")})
    stats = Warehouse(spark, folder).table("part").groupBy(F.col("p_type").alias("category")).agg(
        F.avg("p_retailprice").alias("mean"), F.stddev_samp("p_retailprice").alias("std"))
    return P.surge_price(df, stats)


@register("surge_multipliers", with_ctes(SURGE, """select sku_id, inventory_mult, demand_mult, flash_mult, weather_mult,
fleet_mult, final_price, round(final_price - std, 6) as band_low,
round(final_price + std, 6) as band_high, final_price * 0.85::double as price_floor,
final_price * 1.5::double as price_ceiling from priced join cat_stats on p_type = category"""))
def surge_multipliers(spark, folder):
    return surge_of(spark, folder).select(
        "sku_id", "inventory_mult", "demand_mult", "flash_mult", "weather_mult", "fleet_mult", "final_price",
        "price_floor", "price_ceiling", *[F.round(n, 6).alias(n) for n in ("band_low", "band_high")])


def _impact(c):
    return (f"case when {c} > 1 then '+' else '' end || cast(cast(trunc(({c} - 1) * 100) as int) as varchar) || '%'")


@register("adjustment_breakdown", with_ctes(SURGE, " union all ".join([
    "select sku_id, 0 as position, 'Base ML Price' as step, printf('₹%.2f', base_price) as value, '-' as impact from priced",
    *[f"select sku_id, {i}, '{n}', 'x' || cast({c} as varchar), {_impact(c)} from priced" for i, n, c in (
        (1, "Inventory Mult.", "inventory_mult"), (2, "Demand Mult.", "demand_mult"), (3, "Flash Sale", "flash_mult"),
        (4, "Weather Surge", "weather_mult"))],
    f"select sku_id, 5, 'Fleet Surge', printf('x%.2f', fleet_mult), {_impact('fleet_mult')} from priced",
    "select sku_id, 6, 'Final Price', printf('₹%.2f', final_price), 'Total Recommendation' from priced"])))
def adjustment_breakdown(spark, folder):
    return P.adjustment_breakdown(surge_of(spark, folder))


@register("demand_curve", with_ctes(Q.STATS, """points as (select stock_code, product_avg_price_global as mid, i as point,
product_avg_price_global * (5 + 15 * i / 49::double) / 12 as price from stats, range(50) r(i))""", """
select stock_code, cast(point as int) as point, round(price, 6) as price,
round(200 / (1 + exp(6 * (price / mid - 1))), 6) as demand from points"""))
def demand_curve(spark, folder):
    return P.demand_curve(S.product_stats(Q.clean_of(spark, folder))).withColumns(
        {"price": F.round("price", 6), "demand": F.round("demand", 6)})


@register("top_products", with_ctes(Q.STATS, """select stock_code, product_total_revenue from stats
order by product_total_revenue desc, stock_code limit 10"""))
def top_products(spark, folder):
    stats = S.product_stats(Q.clean_of(spark, folder)).select("stock_code", "product_total_revenue")
    return top_k(stats, 10, F.desc("product_total_revenue"), F.col("stock_code"))


# ---- feature store; life times in hours on these sparse events

AS_OF = "2024-01-15 12:00:00"
LOG = """
log as (select cast(user_id as varchar) as sku_id, case when event_type in ('click', 'view') then 'demand_score_7d'
  when event_type in ('signup', 'error') then 'inventory_ratio' else 'competitor_price' end as feature, value,
  ts as event_ts, case when event_type in ('click', 'view') then 30 when event_type in ('signup', 'error') then 60
  else 300 end * 360 as ttl_seconds, event_id from events)
"""
VALID = f"""
valid as (select * from (select * from log where event_ts <= timestamp '{AS_OF}' qualify row_number() over
  (partition by sku_id, feature order by event_ts desc, event_id desc) = 1)
  where event_ts + to_seconds(ttl_seconds) > timestamp '{AS_OF}'),
wide as (select sku_id, max(value) filter (feature = 'demand_score_7d') as demand_score_7d,
  max(value) filter (feature = 'inventory_ratio') as inventory_ratio,
  max(value) filter (feature = 'competitor_price') as competitor_price from valid group by sku_id),
skus as (select distinct cast(user_id as varchar) as sku_id from events)
"""


def log_of(spark, folder):
    log = Warehouse(spark, folder).feature_log()
    return log.withColumn("ttl_seconds", F.col("ttl_seconds") * 360)


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def skus_of(spark, folder):
    return Warehouse(spark, folder).events().select(F.col("user_id").cast("string").alias("sku_id")).distinct()


@register("feature_upsert", with_ctes(LOG, VALID, "select sku_id, feature, value, event_ts from valid"))
def feature_upsert(spark, folder):
    return FS.latest_valid(log_of(spark, folder), as_of()).select("sku_id", "feature", "value", "event_ts")


@register("feature_invalidate", with_ctes(LOG.replace("log as", "writes as"), """
marks as (select cast(user_id as varchar) as sku_id, ts, event_id from events where event_type = 'error')""", """
log as (select sku_id, feature, value, event_ts, ttl_seconds, event_id, 0 as deleted from writes
  union all select sku_id, unnest(['demand_score_7d', 'inventory_ratio', 'competitor_price']), null, ts, 0, event_id, 1
  from marks)""", VALID.replace("where event_ts + to_seconds", "where value is not null and event_ts + to_seconds").replace(
      "event_id desc)", "event_id desc, deleted desc)"), "select sku_id, feature, value, event_ts from valid"))
def feature_invalidate(spark, folder):
    """Every error event wipes the features of its SKU, its own write of inventory_ratio as well."""
    errors = Warehouse(spark, folder).events().filter(F.col("event_type") == "error").select(
        F.col("user_id").cast("string").alias("sku_id"), F.col("ts").alias("event_ts"), "event_id")
    return FS.latest_valid(log_of(spark, folder).unionByName(FS.tombstones(errors)), as_of()).select(
        "sku_id", "feature", "value", "event_ts")


@register("feature_invalidate_all_writes", ORACLES["feature_invalidate"])
def feature_invalidate_all_writes(spark, folder):
    """The same under its earlier name."""
    return feature_invalidate(spark, folder)


@register("feature_lookup", with_ctes(LOG, VALID, """select sku_id, coalesce(demand_score_7d, 0) as demand_score_7d,
coalesce(inventory_ratio, 0.5::double) as inventory_ratio, competitor_price from skus left join wide using (sku_id)"""))
def feature_lookup(spark, folder):
    return FS.feature_lookup(skus_of(spark, folder), log_of(spark, folder), as_of())


@register("merge_live_context", with_ctes(LOG, VALID, """context as (select sku_id, 12.5::double as demand_score_7d,
case when length(sku_id) > 1 then 0.25::double end as inventory_ratio from skus)""", """select sku_id,
coalesce(w.demand_score_7d, c.demand_score_7d, 0) as demand_score_7d,
coalesce(w.inventory_ratio, c.inventory_ratio, 0.5::double) as inventory_ratio, competitor_price
from context c left join wide w using (sku_id)"""))
def merge_live_context(spark, folder):
    context = skus_of(spark, folder).select("sku_id", F.lit(12.5).alias("demand_score_7d"),
                                            F.when(F.length("sku_id") > 1, 0.25).alias("inventory_ratio"))
    live = FS.wide_features(FS.latest_valid(log_of(spark, folder), as_of()))
    return FS.merge_live_context(context, live).select(
        "sku_id", "demand_score_7d", "inventory_ratio", "competitor_price")


def _asof(feature: str) -> str:
    short = feature[0]
    return f"""{short}0 as (select a.event_id, case when l.event_ts + to_seconds(l.ttl_seconds) > a.ts then l.value end as v
  from asks a asof left join (select * from log where feature = '{feature}') l
  on a.sku_id = l.sku_id and a.ts >= l.event_ts)"""


@register("feature_asof", with_ctes(LOG, """asks as (select cast(user_id as varchar) as sku_id, ts, event_id from events
where event_type in ('purchase', 'signup'))""", _asof("demand_score_7d"), _asof("inventory_ratio"),
                                  _asof("competitor_price"), """select a.event_id, a.sku_id,
coalesce(d.v, 0) as demand_score_7d, coalesce(i.v, 0.5::double) as inventory_ratio, c.v as competitor_price
from asks a join d0 d using (event_id) join i0 i using (event_id) join c0 c using (event_id)"""))
def feature_asof(spark, folder):
    e = Warehouse(spark, folder).events()
    asks = e.filter(F.col("event_type").isin("purchase", "signup")).select(
        F.col("user_id").cast("string").alias("sku_id"), "ts", "event_id")
    return FS.feature_asof(asks, log_of(spark, folder)).drop("ts")


@register("latest_decision", f"""select cast(user_id as varchar) as sku_id, value as final_price, ts as "timestamp", event_id
from events where event_type = 'purchase' and ts <= timestamp '{AS_OF}' and ts + interval 36 hour > timestamp '{AS_OF}'
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def latest_decision(spark, folder):
    d = Warehouse.orders_of(Warehouse(spark, folder).events()).select(
        "sku_id", F.col("price").alias("final_price"), F.col("ts").alias("timestamp"), "event_id")
    return FS.latest_decision(d, as_of(), ttl=36 * 3600)
