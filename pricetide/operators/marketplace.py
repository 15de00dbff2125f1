"""The marketplace star: master table, exploration reports and the 17 model features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricetide.config import MICROS_PER_DAY
from pricetide.functions.calendar import add_holiday_flag, cyclic, marketplace_flags
from pricetide.functions.core import clip, exact_avg, exact_sum, micros, ratio
from pricetide.functions.text import category_label
from pricetide.operators.quantiles import group_quantile, rank_shares, value_counts
from pricetide.operators.windows import drop_internal, rolling_sums, shift_rows
from pricetide.session import cut_lineage
from pricetide.sources.schemas import MARKET_FEATURES, MARKET_TARGET

TS, US, KEY = "order_purchase_timestamp", "us", "product_id"
SEQ = ["order_id", "order_item_id", "seller_id", "price", "freight_value"]


# ---- joins

def first_review(reviews: DataFrame) -> DataFrame:
    """The earliest review of each order; a minimum, so it combines before the shuffle."""
    first = F.min(F.struct("review_time", "review_score")).alias("_r")
    return reviews.groupBy("order_id").agg(first).select("order_id", F.col("_r.review_score").alias("review_score"))


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(exact_sum("payment_value").alias("payment_value"))


def _with_category(df: DataFrame, star: dict[str, DataFrame]) -> DataFrame:
    """Products and translations meet first: the small tables are joined before the fact is touched."""
    named = star["products"].join(star["translations"], "product_category_name", "left")
    return df.join(named, KEY, "left")


def build_master(star: dict[str, DataFrame]) -> DataFrame:
    """Items with order, product, category, review, customer, seller and payments, all left joins.

    Order-level tables are joined to each other first (one row per order), so the items are shuffled
    once on the order.
    """
    orders = (star["orders"].join(first_review(star["reviews"]), "order_id", "left")
              .join(payments_per_order(star["payments"]), "order_id", "left")
              .join(star["customers"], "customer_id", "left"))
    df = star["order_items"].join(orders, "order_id", "left").join(star["sellers"], "seller_id", "left")
    df = _with_category(df, star)
    return df.withColumn("category", F.coalesce("product_category_name_english", "product_category_name"))


def build_feature_base(star: dict[str, DataFrame]) -> DataFrame:
    """Items with purchase time, category label and review score (missing scores: the median score)."""
    orders = (star["orders"].select("order_id", "order_status", TS)
              .join(first_review(star["reviews"]), "order_id", "left"))
    df = _with_category(star["order_items"].join(orders, "order_id", "left"), star)
    df = df.withColumn("category", category_label("product_category_name_english", "product_category_name"))
    return df.drop("product_category_name", "product_category_name_english")


def fill_review_score(df: DataFrame) -> DataFrame:
    """Scores take few values: their counts carry the median."""
    counts = df.groupBy("review_score").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("review_score").isNotNull())
    median = counts.agg(F.expr("percentile(review_score, 0.5, _n)")).scalar()
    return df.withColumn("review_score", F.coalesce(F.col("review_score").cast("double"), median))


# ---- exploration

def orders_by_month(master: DataFrame) -> DataFrame:
    month = F.trunc(F.to_date(TS), "month")
    return master.groupBy(month.alias("month")).agg(F.countDistinct("order_id").alias("orders"))


def top_categories(master: DataFrame, k: int = 20) -> DataFrame:
    sums = master.filter(F.col("category").isNotNull()).groupBy("category").agg(exact_sum("price").alias("revenue"))
    return sums.orderBy(F.desc("revenue"), "category").limit(k)


def avg_price_by_category(master: DataFrame, k: int = 5) -> DataFrame:
    means = master.filter(F.col("category").isNotNull()).groupBy("category").agg(exact_avg("price").alias("mean_price"))
    return means.orderBy(F.desc("mean_price"), "category").limit(k)


def sku_velocity(master: DataFrame, k: int | None = None) -> DataFrame:
    """Distinct orders per day of each SKU over the whole days the data spans."""
    span = master.agg(F.floor((F.max(micros(TS)) - F.min(micros(TS))) / F.lit(MICROS_PER_DAY))).scalar()
    out = (master.groupBy(KEY).agg(F.countDistinct("order_id").alias("orders"))
           .withColumn("orders_per_day", ratio(F.col("orders").cast("double"), span)))
    return out if k is None else out.orderBy(F.desc("orders_per_day"), KEY).limit(k)


def score_distribution(master: DataFrame) -> DataFrame:
    return (master.filter(F.col("review_score").isNotNull()).groupBy("review_score")
            .agg(F.count(F.lit(1)).alias("row_count")).orderBy("review_score"))


def histogram(df: DataFrame, value: Column, bins: int = 50) -> DataFrame:
    """Counts of equal-width bins between the extremes; the last bin is closed on both sides."""
    vals = df.select(value.alias("_v")).filter(F.col("_v").isNotNull())
    ends = vals.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    place = F.coalesce(ratio((F.col("_v") - F.col("_e.lo")) * bins, F.col("_e.hi") - F.col("_e.lo")), F.lit(0.0))
    binned = vals.withColumn("_e", ends).select(
        F.least(F.floor(place), F.lit(bins - 1)).cast("int").alias("bin"), "_e")
    return (binned.groupBy("bin").agg(F.count(F.lit(1)).alias("row_count"), F.first("_e").alias("_e"))
            .select("bin", (F.col("_e.lo") + (F.col("_e.hi") - F.col("_e.lo")) * F.col("bin") / bins).alias("bin_start"),
                    "row_count"))


def log_price_histogram(master: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(master, F.log1p("price"), bins)


def data_quality(master: DataFrame, low: int = 5) -> DataFrame:
    """Repeated order ids, and SKUs with few rows, in one row."""
    orders = master.agg((F.count("order_id") - F.countDistinct("order_id")).alias("duplicate_order_rows")).scalar()
    skus = master.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    return skus.agg(F.count_if(F.col("_n") < low).alias("low_volume_skus"), F.count(F.lit(1)).alias("skus")).select(
        orders.alias("duplicate_order_rows"), "low_volume_skus", "skus",
        (F.col("low_volume_skus") / F.col("skus")).alias("low_volume_share"))


def price_outliers(df: DataFrame, column: str = "price", sigmas: float = 3.0) -> DataFrame:
    limit = df.agg(F.avg(column) + F.lit(sigmas) * F.stddev_samp(column)).scalar()
    return df.filter(F.col(column) > limit)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlations of all column pairs, long form; rows with a missing value are left out.

    Lazy: the means as a scalar, then the centred products of every pair in one aggregate.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).na.drop()
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    means = rows.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    centred = rows.withColumn("_m", means).select(*[(F.col(c) - F.col(f"_m.{c}")).alias(f"x{i}") for i, c in
                                                    enumerate(columns)])
    moments = centred.agg(*[F.expr(f"sum(x{i} * x{j})").alias(f"s{i}_{j}") for i, j in pairs])
    own = ", ".join(f"s{i}_{i}" for i in range(len(columns)))
    listed = moments.select(F.expr(f"array({own})").alias("_own"), F.expr(
        f"stack({len(pairs)}, " + ", ".join(f"{i}, {j}, s{i}_{j}" for i, j in pairs) + ") as (_i, _j, _s)"))
    i, j, names = F.col("_i"), F.col("_j"), F.array(*[F.lit(c) for c in columns])
    value = F.when(i == j, F.when(F.col("_s").isNotNull(), F.lit(1.0))).otherwise(
        ratio(F.col("_s"), F.sqrt(F.get("_own", i) * F.get("_own", j))))
    cell, mirrored = F.struct(i.alias("_a"), j.alias("_b")), F.struct(j.alias("_a"), i.alias("_b"))
    sides = F.when(i == j, F.array(cell)).otherwise(F.array(cell, mirrored))
    cells = listed.select(value.alias("correlation"), F.inline(sides).alias("_a", "_b"))
    return cells.select(F.get(names, F.col("_a")).alias("a"), F.get(names, F.col("_b")).alias("b"), "correlation")


# ---- features

def temporal_features(df: DataFrame, holidays: DataFrame) -> DataFrame:
    hour_sin, hour_cos = cyclic(F.hour(TS), 24.0)
    day_sin, day_cos = cyclic(F.weekday(TS), 7.0)
    df = df.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos, "day_sin": day_sin, "day_cos": day_cos,
                         **marketplace_flags(TS)})
    return add_holiday_flag(df, TS, holidays)


def demand_scores(df: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Items of the product in the last 7 and 30 days, the row included, and days since its previous item."""
    df = df.withColumn(US, micros(TS))
    df = rolling_sums(df, KEY, US, SEQ, {"n": F.lit(1)},
                      {"7d": 7 * MICROS_PER_DAY, "30d": 30 * MICROS_PER_DAY}, heavy=heavy)
    df = shift_rows(df, KEY, US, SEQ, {"_prev": (US, 1)}, heavy=heavy)
    gap = (F.col(US) - F.col("_prev")) / F.lit(float(MICROS_PER_DAY))
    df = df.withColumns({"demand_score_7d": F.col("n_7d").cast("double"),
                         "demand_score_30d": F.col("n_30d").cast("double"),
                         "days_since_last_order": F.coalesce(gap, F.lit(-1.0))})
    return drop_internal(df).drop("n_7d", "n_30d", "_prev")


def demand_velocity(week="demand_score_7d", month="demand_score_30d") -> Column:
    w, m = F.col(week), F.col(month)
    return F.coalesce((w - m / 4) / F.when(m == 0, 1.0).otherwise(m), F.lit(0.0))


def inventory_proxy(week="demand_score_7d") -> Column:
    return clip(F.lit(1.0) / (F.col(week) + 1), 0.1, 1.0)


def review_elasticity() -> Column:
    return clip(F.lit(1.0) + (F.col("review_score") - 3.0) * 0.05, 0.85, 1.15)


def category_median(df: DataFrame, out: str = "category_median") -> DataFrame:
    return group_quantile(df, ["category"], "price", 0.5, out)


def optimal_price() -> Column:
    raw = F.col("price") * (F.lit(1.0) + F.col("demand_velocity") * 0.1) * F.col("review_elasticity")
    return clip(raw, F.col("price") * 0.85, F.col("price") * 1.35)


def price_table(df: DataFrame) -> DataFrame:
    """Rank share and distance to the category median of every distinct (category, price).

    Both come from the stored counts of the distinct ones, so the rows are read and shuffled once.
    """
    counts = cut_lineage(value_counts(df, "category", "price", "rows"), "prices")
    ranks = rank_shares(counts, "category", "price", "price_percentile_in_category", "rows")
    medians = group_quantile(counts, ["category"], "price", 0.5, "category_median", weight="rows")
    # one row per category: its join is decided by the size seen at run time
    table = ranks.join(medians, "category", "left")
    delta = ratio(F.col("price") - F.col("category_median"), "category_median")
    return table.withColumn("competitor_delta", delta).drop("category_median")


def build_market_features(base: DataFrame, holidays: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Ids, the 17 features and the target from the feature base.  Pass the base as a stored stage: the
    median score, the category medians and the ranks each read it again, two columns at a time."""
    df = demand_scores(fill_review_score(base), heavy)
    df = df.withColumns({"demand_velocity": demand_velocity(), "inventory_ratio": inventory_proxy(),
                         "review_elasticity": review_elasticity()})
    df = temporal_features(df, holidays)
    df = df.join(price_table(base), ["category", "price"], "left")
    df = df.withColumn(MARKET_TARGET, optimal_price())
    return df.select("order_id", KEY, "category", TS, *MARKET_FEATURES, MARKET_TARGET, "order_item_id", "seller_id")


def feature_projection(df: DataFrame) -> DataFrame:
    return df.select("order_id", KEY, "category", TS, *MARKET_FEATURES, MARKET_TARGET)


def ensure_columns(df: DataFrame, columns: list[str] = MARKET_FEATURES, target: str = MARKET_TARGET) -> DataFrame:
    """Missing feature columns as 0.0; rows without a target are dropped."""
    absent = {c: F.lit(0.0) for c in columns if c not in df.columns}
    return (df.withColumns(absent) if absent else df).na.drop(subset=[target])


# ---- reports on the feature table

def last_rows_by_category(df: DataFrame, n: int = 30) -> DataFrame:
    """The newest n rows of every category.  Spark keeps n candidates per category and task before the
    shuffle, so a large category does not travel."""
    back = Window.partitionBy("category").orderBy(F.desc(TS), *[F.desc(c) for c in SEQ])
    return df.withColumn("position", F.row_number().over(back)).filter(F.col("position") <= n)


def category_price_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(F.avg(MARKET_TARGET).alias("mean"), F.stddev_samp(MARKET_TARGET).alias("std"))


def competitor_category_price(df: DataFrame) -> DataFrame:
    """Median price of each category, to two places."""
    return category_median(df, "market_price").withColumn("market_price", F.round("market_price", 2))


def nearest_to_quantiles(df: DataFrame, column: str = MARKET_TARGET, low: float = 0.05, high: float = 0.95,
                         sigmas: float = 3.0) -> DataFrame:
    """Three profile rows: nearest to the low and the high quantile, and the first far outlier in time."""
    order = [TS, *SEQ]
    keyed = df.select(column, *order).withColumn("_o", F.struct(*order))
    ends = group_quantile(df, [], column, low, "lo").agg(F.max("lo")).scalar()
    tops = group_quantile(df, [], column, high, "hi").agg(F.max("hi")).scalar()
    limit = df.agg(F.avg(column) + F.lit(sigmas) * F.stddev_samp(column)).scalar()

    def nearest(name: str, goal: Column) -> DataFrame:
        best = F.min(F.struct(F.abs(F.col(column) - F.col("_g")).alias("_d"), "_o", column)).alias("_b")
        return keyed.withColumn("_g", goal).agg(best).select(F.lit(name).alias("profile"), "_b._o.*", f"_b.{column}")

    first = F.min(F.struct("_o", column)).alias("_b")
    outlier = keyed.filter(F.col(column) > limit).agg(first).filter(F.col("_b").isNotNull()).select(
        F.lit("outlier").alias("profile"), "_b._o.*", f"_b.{column}")
    return nearest("high", tops).unionByName(nearest("low", ends)).unionByName(outlier)
