"""The eight feature groups of the online-retail price model.

All per-product windows share one exchange on the product (``add_demand_features`` and
``add_inventory_features``); everything that is one value per product is aggregated first and joined once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.config import MICROS_PER_DAY, SETTINGS, Settings
from pricetide.functions.calendar import calendar_flags, calendar_parts, days_to_christmas, time_of_day
from pricetide.functions.core import clip, exact_avg, exact_sum, flag, major, micros, minor, ratio
from pricetide.functions.text import CATEGORY_WORDS, OTHER_CATEGORY, categorise, word_count
from pricetide.operators.quantiles import group_quantile
from pricetide.operators.windows import SLICE, heavy_keys, numbered, rolling_sums, shift_rows
from pricetide.session import cut_lineage

KEY, TS, US = "stock_code", "invoice_date", "us"
# After the dedup a line is unique by these columns, which therefore break every tie in time.
SEQ = ["invoice_no", "quantity", "unit_price"]


# ---- group 1: time

def add_temporal_features(df: DataFrame) -> DataFrame:
    return df.withColumns({**calendar_parts(TS), **calendar_flags(TS),
                           "days_to_christmas": days_to_christmas(TS), "time_of_day": time_of_day(TS)})


# ---- group 2: product

def product_stats(df: DataFrame) -> DataFrame:
    """One row per product."""
    return df.groupBy(KEY).agg(
        exact_avg("unit_price").alias("product_avg_price_global"),
        F.coalesce(F.stddev_samp("unit_price"), F.lit(0.0)).alias("product_price_std"),
        F.min("unit_price").alias("product_price_min"), F.max("unit_price").alias("product_price_max"),
        exact_sum("revenue").alias("product_total_revenue"),
        F.count("invoice_no").alias("product_transaction_count"),
        F.avg("quantity").alias("product_avg_quantity"),
    ).withColumn("product_price_range", F.col("product_price_max") - F.col("product_price_min"))


def popularity_rank(stats: DataFrame, count: str = "product_transaction_count",
                    out: str = "product_popularity_rank") -> DataFrame:
    """Quintile 1..5 of the product's count; five equal widths where quintile edges coincide.

    Products are grouped by count first: n rows have at most about sqrt(2 n) different counts.
    """
    freq = stats.groupBy(F.col(count).alias("_c")).agg(F.count(F.lit(1)).alias("_k"))
    edges = freq.agg(F.expr("percentile(_c, array(0, 0.2, 0.4, 0.6, 0.8, 1), _k)")).scalar()
    e = [F.col("_edges")[i] for i in range(6)]
    width = (e[5] - e[0]) / F.lit(5.0)
    repeated = F.size(F.array_distinct("_edges")) < 6

    def steps(bounds) -> Column:
        return sum((flag(F.col(count) > b) for b in bounds), F.lit(1))

    rank = (F.when(e[0] == e[5], 3)
            .when(repeated, steps([e[0] + width * i for i in range(1, 5)]))
            .otherwise(steps(e[1:5])))
    return stats.withColumn("_edges", edges).withColumn(out, rank.cast("int")).drop("_edges")


def label_encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Position of the value among the sorted distinct ones.

    The join of the distinct table is left to the run-time size check.
    """
    labels = df.select(column).distinct().filter(F.col(column).isNotNull())
    ids = numbered(labels, [column], out, "labels")
    return df.join(ids.withColumn(out, F.col(out).cast("int")), column, "left")


def category_ids(df: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Category of the description and its id among the categories present in ``among`` (default: df).

    The categories are the few fixed rule groups, so the set of those present is a scalar and the id
    needs no join.
    """
    df = df.withColumn("product_category", categorise("description"))
    names = sorted([*CATEGORY_WORDS, OTHER_CATEGORY])
    seen = (df if among is None else among).select(categorise("description").alias("_c")).agg(F.collect_set("_c"))
    ids = F.when(F.lit(False), F.lit(0))
    for i, n in enumerate(names):
        below = sum((F.array_contains("_seen", m).cast("int") for m in names[:i]), F.lit(0))
        ids = ids.when(F.col("product_category") == n, below)
    return (df.withColumn("_seen", seen.scalar())
            .withColumn("product_category_id", ids.cast("int")).drop("_seen"))


def add_product_features(df: DataFrame, profile: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Category columns, and the product profile joined once."""
    df = category_ids(df, among).withColumn("product_name_length", word_count("description"))
    df = df.join(profile, KEY, "left")
    return df.withColumn("price_vs_product_mean", ratio("unit_price", "product_avg_price_global"))


# ---- group 3: demand

def daily_demand(df: DataFrame) -> DataFrame:
    return df.groupBy(KEY, F.to_date(TS).alias("date")).agg(F.sum("quantity").alias("daily_qty"))


def trend_slope(df: DataFrame, days: int = SETTINGS.trend_days) -> DataFrame:
    """Least-squares slope of the last active days of each product (one row per product and day goes in)."""
    back = Window.partitionBy(KEY).orderBy(F.desc("date"))
    last = daily_demand(df).withColumn("_i", F.row_number().over(back)).filter(F.col("_i") <= days)
    # counting from the newest day turns the sign
    slope = F.coalesce(F.regr_slope("daily_qty", -F.col("_i")), F.lit(0.0))
    return last.groupBy(KEY).agg(slope.alias("demand_trend_slope"))


def add_rolling(df: DataFrame, s: Settings = SETTINGS, heavy: DataFrame | None = None) -> DataFrame:
    """Rolling demand, revenue, transactions and mean price that end at the previous sale; row lags;
    running units.  One exchange on the product."""
    heavy = heavy_keys(df, KEY, s.heavy_rows) if heavy is None else heavy
    with_us = df.withColumn(US, micros(TS))
    spans = {f"{d}d": d * MICROS_PER_DAY for d in s.demand_days}
    measures = {"r_demand": F.col("quantity"), "r_revenue": minor("revenue"), "r_transactions": F.lit(1),
                "r_price": minor("unit_price")}
    rolled = rolling_sums(with_us, KEY, US, SEQ, measures, {**spans, "all": None}, heavy=heavy)
    shifts = {f"p_{m}_{span}": (f"{m}_{span}", 1) for m in measures for span in spans}
    shifts |= {f"price_lag_{n}": ("unit_price", n) for n in s.lag_rows}
    shifts |= {f"demand_lag_{n}": ("quantity", n) for n in s.lag_rows}
    shifts["_prev_us"] = (US, 1)
    rows = shift_rows(rolled, KEY, US, SEQ, shifts, heavy=heavy)
    out = {"cumulative_units_sold": F.col("r_demand_all")}
    for span in spans:
        n = F.col(f"p_r_transactions_{span}")
        out |= {
            f"rolling_demand_{span}": F.coalesce(f"p_r_demand_{span}", F.lit(0)),
            f"rolling_revenue_{span}": F.coalesce(major(F.col(f"p_r_revenue_{span}")), F.lit(0.0)),
            f"rolling_transactions_{span}": F.coalesce(n, F.lit(0)),
            f"rolling_avg_price_{span}": major(F.col(f"p_r_price_{span}")) / n,
        }
    lags = [f"price_lag_{n}" for n in s.lag_rows] + [f"demand_lag_{n}" for n in s.lag_rows]
    return rows.withColumns(out).select(*df.columns, US, "_prev_us", SLICE, *out, *lags)


def units_today(df: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Units of the product on the row's date, on the exchange of ``add_rolling`` (its slices are hours of UTC, the
    zone of dates too).  The hours of a heavy product are added up to days in a table of one row per hour."""
    day = F.to_date(TS)
    inside = df.withColumn("units_sold_today", F.sum("quantity").over(Window.partitionBy(KEY, SLICE, day)))
    cut = df.filter(F.col(SLICE).isNotNull())
    if heavy is not None:  # without heavy keys this reads nothing
        cut = cut.join(F.broadcast(heavy.toDF(KEY)), KEY, "left_semi")
    hours = cut.groupBy(KEY, SLICE, day.alias("_day")).agg(F.sum("quantity").alias("_q"))
    days = hours.select(KEY, SLICE, F.sum("_q").over(Window.partitionBy(KEY, "_day")).alias("_units"))
    return inside.join(days, [KEY, SLICE], "left").select(
        *[c for c in df.columns if c != SLICE], F.coalesce("_units", "units_sold_today").alias("units_sold_today"))


def days_since_last_sale(previous_us: str = "_prev_us") -> Column:
    gap = F.floor((F.col(US) - F.col(previous_us)) / F.lit(MICROS_PER_DAY))
    return clip(F.coalesce(gap, F.lit(0)), 0, 90).cast("int")


def demand_acceleration(days: int) -> Column:
    return clip(F.coalesce(ratio("rolling_demand_7d", f"rolling_demand_{days}d"), F.lit(0.0)), 0.0, 10.0)


def add_demand_features(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """Defaults and ratios after the product profile is joined."""
    mean = F.col("product_avg_price_global")
    df = df.withColumns({f"rolling_avg_price_{d}d": F.coalesce(f"rolling_avg_price_{d}d", mean)
                         for d in s.demand_days})
    df = df.withColumns({f"demand_acceleration_{d}d": demand_acceleration(d) for d in s.demand_days if d != 7})
    return df.withColumns({
        **{f"price_lag_{n}": F.coalesce(f"price_lag_{n}", F.lit(0.0)) for n in s.lag_rows},
        **{f"demand_lag_{n}": F.coalesce(f"demand_lag_{n}", F.lit(0)) for n in s.lag_rows},
        "demand_trend_slope": F.coalesce("demand_trend_slope", F.lit(0.0))})


# ---- group 4: elasticity

def raw_elasticity(df: DataFrame) -> DataFrame:
    """Demand change over price change against 30 days, bounded to -10..0; NULL where undefined."""
    mean, month = F.col("rolling_avg_price_30d"), F.col("rolling_demand_30d") / F.lit(4.0)
    df = df.withColumns({"pct_price_change": ratio(F.col("unit_price") - mean, mean),
                         "pct_demand_change": ratio(F.col("rolling_demand_7d") - month, month)})
    return df.withColumn("price_elasticity_30d",
                         clip(ratio("pct_demand_change", "pct_price_change"), -10.0, 0.0))


def fill_elasticity(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """Gaps take the category's median, then the default; flag and price estimate follow."""
    medians = group_quantile(df, ["product_category"], "price_elasticity_30d", 0.5, "_median")
    # one row per rule category
    df = df.join(F.broadcast(medians), "product_category", "left")
    df = df.withColumn("price_elasticity_30d",
                       F.coalesce("price_elasticity_30d", "_median", F.lit(s.default_elasticity))).drop("_median")
    return df.withColumns({"is_price_elastic": flag(F.col("price_elasticity_30d") < -1),
                           "optimal_price_elasticity_estimate": elasticity_price()})


def elasticity_price() -> Column:
    e, low = F.col("price_elasticity_30d"), F.col("product_price_min")
    raw = F.col("unit_price") * ratio(e, e + 1)
    return F.when(e == -1, low).otherwise(clip(raw, low, F.col("product_price_max") * 1.5))


# ---- group 5: customer and country

def country_stats(df: DataFrame) -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy("country").agg(exact_avg("unit_price").alias("country_avg_price"),
                                      F.count("invoice_no").alias("_n"))
            .withColumn("country_demand_share", F.col("_n") / total).drop("_n"))


def customer_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("customer_id").agg(
        exact_sum("revenue").alias("customer_lifetime_value"),
        F.countDistinct(TS).alias("customer_purchase_frequency"),
        F.avg("quantity").alias("customer_avg_basket_size"),
        F.coalesce(F.stddev_samp("unit_price"), F.lit(0.0)).alias("customer_price_sensitivity"))


def add_customer_features(df: DataFrame, countries: DataFrame, customers: DataFrame,
                          s: Settings = SETTINGS) -> DataFrame:
    df = df.join(countries, "country", "left").join(customers, "customer_id", "left")
    return df.withColumns({
        "is_uk": flag(F.col("country") == s.home_country),
        "is_wholesale_customer": flag((F.col("is_bulk") == 1)
                                      | (F.col("customer_avg_basket_size") > s.wholesale_basket))})


# ---- group 6: inventory

def add_inventory_features(df: DataFrame) -> DataFrame:
    monthly = F.col("rolling_demand_30d") / F.lit(30.0)
    pace = F.col("units_sold_today") / F.when(monthly == 0, 1.0).otherwise(monthly)
    df = df.withColumn("units_sold_vs_30d_avg", pace)
    risk = (F.col("demand_acceleration_30d") * 0.5
            + clip("units_sold_vs_30d_avg", 0.0, 5.0) / 5 * 0.3
            + F.lit(1.0) / (F.col("days_since_last_sale") + 1) * 0.2)
    return df.withColumn("stockout_risk_raw", risk)


def global_minmax(df: DataFrame, column: str, out: str) -> DataFrame:
    """Scale to 0..1 by the column's own extremes, read as a scalar."""
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    return (df.withColumn("_e", ends)
            .withColumn(out, F.coalesce(ratio(F.col(column) - F.col("_e.lo"), F.col("_e.hi") - F.col("_e.lo")),
                                        F.lit(0.0))).drop("_e"))


# ---- group 7: competitors

def add_competitor_features(df: DataFrame, prices: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    df = df.join(prices, KEY, "left")
    df = df.withColumns({c: clip(c, s.min_price, s.max_price)
                         for c in ("competitor_price_1", "competitor_price_2")})
    mean = (F.col("competitor_price_1") + F.col("competitor_price_2")) / F.lit(2.0)
    df = df.withColumn("competitor_avg_price", mean)
    return df.withColumns({
        "price_vs_competitor": ratio("unit_price", "competitor_avg_price"),
        "competitor_price_gap": F.col("unit_price") - F.col("competitor_avg_price"),
    }).withColumn("is_price_competitive", flag(F.col("price_vs_competitor") <= 1.05))


# ---- group 8: unusual hours and discounts

def hourly_demand(df: DataFrame) -> DataFrame:
    return df.groupBy(KEY, F.hour(TS).alias("hour")).agg(
        F.avg("quantity").alias("h_mean"), F.stddev_samp("quantity").alias("h_std"))


def hourly_profile(df: DataFrame) -> DataFrame:
    """The same per product, as maps over its at most 24 hours, to join on the product alone."""
    return hourly_demand(df).groupBy(KEY).agg(
        F.map_from_entries(F.collect_list(F.struct("hour", F.struct("h_mean", "h_std")))).alias("_hours"))


def add_flash_features(df: DataFrame) -> DataFrame:
    stats = F.try_element_at("_hours", F.hour(TS))
    df = df.withColumns({"h_mean": stats["h_mean"], "h_std": stats["h_std"]}).drop("_hours")
    return df.withColumns({
        "hourly_demand_zscore": (F.col("quantity") - F.col("h_mean"))
        / F.when(F.col("h_std") == 0, 1.0).otherwise(F.col("h_std")),
        "price_discount_pct": ratio(F.col("product_avg_price_global") - F.col("unit_price"),
                                    "product_avg_price_global") * 100,
    }).withColumns({"is_flash_sale_window": flag(F.col("hourly_demand_zscore") > 2.5),
                    "is_discounted": flag(F.col("price_discount_pct") > 5)})


# ---- all together

def product_profile(df: DataFrame) -> DataFrame:
    """All that is one row per product: statistics, popularity, trend, hours."""
    return (popularity_rank(product_stats(df)).join(trend_slope(df), KEY, "left")
            .join(hourly_profile(df), KEY, "left"))


def null_cleanup(df: DataFrame) -> DataFrame:
    """Missing numbers become 0 (divisions give NULL here, never infinity)."""
    numeric = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint")]
    return df.na.fill(0, subset=numeric)


def build_features(clean: DataFrame, competitors: DataFrame, s: Settings = SETTINGS,
                   heavy: DataFrame | None = None, stage=cut_lineage) -> DataFrame:
    """Every feature group on the cleaned sales (a stored stage: several aggregates read it).

    The medians and the scaling each read the rows again, so the windowed rows are written once as a
    stage; those passes then scan two columns of it.
    """
    heavy = heavy_keys(clean, KEY, s.heavy_rows) if heavy is None else heavy
    df = units_today(add_rolling(clean, s, heavy), heavy)
    df = df.withColumn("days_since_last_sale", days_since_last_sale()).drop("_prev_us")
    df = add_product_features(df, product_profile(clean), clean)
    df = add_temporal_features(df)
    df = raw_elasticity(add_demand_features(df, s))
    df = stage(add_flash_features(add_inventory_features(df)), "features")
    df = fill_elasticity(df, s)
    df = add_customer_features(df, country_stats(clean), customer_stats(clean), s)
    df = add_competitor_features(df, competitors, s)
    df = global_minmax(df, "stockout_risk_raw", "stockout_risk_score").drop("stockout_risk_raw")
    return null_cleanup(df)
