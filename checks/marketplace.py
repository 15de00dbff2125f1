"""Queries on the marketplace star: joins, exploration, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import register, staged, with_ctes
from pricetide.config import MICROS_PER_DAY as DAY
from pricetide.functions import calendar
from pricetide.functions.text import category_label
from pricetide.operators import marketplace as M
from pricetide.operators import profiling as P
from pricetide.operators import splits
from pricetide.session import shared_folder
from pricetide.sources import readers
from pricetide.sources.schemas import MARKET_FEATURES, MARKET_TARGET
from pricetide.sources.warehouse import Warehouse

CENTS = ("((2 * cast(round(l_extendedprice * 100) as bigint) + cast(l_quantity as bigint)) "
         "// (2 * cast(l_quantity as bigint)))")
STAR = f"""
order_items as (select cast(l_orderkey as varchar) as order_id, l_linenumber as order_item_id,
  cast(l_partkey as varchar) as product_id, cast(l_suppkey as varchar) as seller_id, {CENTS} / 100::double as price,
  ({CENTS} * cast(round(l_tax * 100) as bigint) // 100) / 100::double as freight_value from lineitem),
shop_orders as (select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
  o_orderstatus as order_status, bought as order_purchase_timestamp, bought + interval 1 hour as order_approved_at,
  case when o_orderstatus <> 'P' then bought + interval 2 day end as order_delivered_carrier_date,
  case when o_orderstatus = 'F' then bought + interval 7 day end as order_delivered_customer_date,
  bought + interval 21 day as order_estimated_delivery_date
  from (select *, o_orderdate + to_minutes(cast((o_orderkey * 37) % 1440 as int)) as bought from orders)),
products as (select cast(p_partkey as varchar) as product_id,
  case when p_size <> 50 then p_type end as product_category_name from part),
translations as (select distinct p_type as product_category_name, lower(p_type) || '_goods' as
  product_category_name_english from part where p_type <> 'PROMO'),
reviews as (select cast(o_orderkey as varchar) as order_id, cast(o_orderkey % 5 + 1 as int) as review_score,
  o_orderdate as review_time from orders where o_orderstatus <> 'P' union all
  select cast(l_orderkey as varchar), 1, l_shipdate from lineitem where l_returnflag = 'R'),
payments as (select cast(o_orderkey as varchar) as order_id, o_totalprice as payment_value from orders),
customers as (select cast(c_custkey as varchar) as customer_id, n_name as customer_state
  from customer join nation on c_nationkey = n_nationkey),
sellers as (select cast(s_suppkey as varchar) as seller_id, n_name as seller_state
  from supplier join nation on s_nationkey = n_nationkey),
geolocation as (select n_name as geolocation_state, r_name as geolocation_region
  from nation join region on n_regionkey = r_regionkey),
first_reviews as (select order_id, review_score from reviews qualify row_number() over (partition by order_id
  order by review_time, review_score) = 1),
paid as (select order_id, cast(sum(cast(round(payment_value * 10000) as bigint)) as double) / 10000 as payment_value
  from payments group by order_id)
"""
MASTER = STAR + """,
master as (select i.*, o.* exclude (order_id), p.product_category_name, t.product_category_name_english,
  r.review_score, c.customer_state, s.seller_state, y.payment_value,
  coalesce(t.product_category_name_english, p.product_category_name) as category
  from order_items i left join shop_orders o using (order_id) left join products p using (product_id)
  left join translations t using (product_category_name) left join first_reviews r using (order_id)
  left join customers c using (customer_id) left join sellers s using (seller_id) left join paid y using (order_id))
"""
SEQ = "order_id, order_item_id, seller_id, price, freight_value"
ORDER = f"order_purchase_timestamp, {SEQ}"


def count_back(days: int) -> str:
    return (f"cast(count(*) over (partition by product_id order by us range between {days * DAY - 1} preceding and "
            f"current row) - count(*) over (partition by product_id, us order by {SEQ} rows between 1 following and "
            "unbounded following) as double)")


HOLIDAY = """
years as (select distinct year(order_purchase_timestamp) as y from shop_orders),
easter0 as (select y, y % 19 as a, y // 100 as b, y % 100 as c from years),
easter1 as (select *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 as h from easter0),
easter2 as (select *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 as l from easter1),
easter3 as (select *, (a + 11 * h + 22 * l) // 451 as m from easter2),
holidays as (
  select make_date(y, mm, dd) as holiday from years, (values (1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2),
    (11, 15), (12, 25)) v(mm, dd) union select make_date(y, 11, 20) from years where y >= 2024
  union select make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) - 2 from easter3)
"""
FEATURES = STAR + "," + HOLIDAY + f""",
base0 as (select i.*, o.order_status, o.order_purchase_timestamp, epoch_us(o.order_purchase_timestamp) as us,
  r.review_score as score, coalesce(t.product_category_name_english, p.product_category_name, 'unknown') as category
  from order_items i left join shop_orders o using (order_id) left join products p using (product_id)
  left join translations t using (product_category_name) left join first_reviews r using (order_id)),
base as (select *, coalesce(cast(score as double), (select quantile_cont(score, 0.5) from base0)) as review_score
  from base0),
scored as (select *, {count_back(7)} as demand_score_7d, {count_back(30)} as demand_score_30d,
  coalesce((us - lag(us) over (partition by product_id order by us, {SEQ})) / {DAY}::double, -1)
    as days_since_last_order,
  (rank() over (partition by category order by price) + (count(*) over (partition by category, price) - 1) / 2::double)
    / count(*) over (partition by category) as price_percentile_in_category from base),
medians as (select category, quantile_cont(price, 0.5) as med from base group by category),
shaped as (select s.*, med, (demand_score_7d - demand_score_30d / 4) / demand_score_30d as demand_velocity,
  greatest(least(1 / (demand_score_7d + 1), 1), 0.1::double) as inventory_ratio, (price - med) / med as competitor_delta,
  greatest(least(1 + (review_score - 3) * 0.05::double, 1.15::double), 0.85::double) as review_elasticity,
  sin(2 * pi() * hour(order_purchase_timestamp) / 24) as hour_sin,
  cos(2 * pi() * hour(order_purchase_timestamp) / 24) as hour_cos,
  sin(2 * pi() * (isodow(order_purchase_timestamp) - 1) / 7) as day_sin,
  cos(2 * pi() * (isodow(order_purchase_timestamp) - 1) / 7) as day_cos,
  cast(isodow(order_purchase_timestamp) >= 6 as int) as is_weekend,
  cast(cast(order_purchase_timestamp as date) = last_day(order_purchase_timestamp) as int) as is_month_end,
  cast(cast(order_purchase_timestamp as date) in (select holiday from holidays) as int) as is_holiday
  from scored s join medians using (category)),
features as (select *, greatest(least(price * (1 + demand_velocity * 0.1::double) * review_elasticity,
  price * 1.35::double), price * 0.85::double) as optimal_price from shaped)
"""
FLOATS = ["hour_sin", "hour_cos", "day_sin", "day_cos", "demand_velocity", "competitor_delta", "review_elasticity",
          "inventory_ratio", "days_since_last_order"]


def star_of(spark, folder):
    return Warehouse(spark, folder).star()


def master_of(spark, folder):
    return M.build_master(star_of(spark, folder))


def base_of(spark, folder):
    """The joined feature base as a stored stage; ``build_feature_base`` itself runs the joins."""
    return staged("market-base", spark, folder, lambda: M.build_feature_base(star_of(spark, folder)))


def features_of(spark, folder):
    w = Warehouse(spark, folder)
    return M.build_market_features(base_of(spark, folder), calendar.holidays_of(base_of(spark, folder), M.TS),
                                   heavy=w.heavy_market_products())


TABLES = {"order_items": "order_items", "orders": "shop_orders", "products": "products",
          "translations": "translations", "reviews": "reviews", "payments": "payments", "customers": "customers",
          "sellers": "sellers", "geolocation": "geolocation"}
NULLABLE = {"orders": ["order_delivered_carrier_date", "order_delivered_customer_date"],
            "products": ["product_category_name"]}
WIDTH = {"order_items": 6, "orders": 8, "products": 2, "translations": 2, "reviews": 3, "payments": 2,
         "customers": 2, "sellers": 2, "geolocation": 2}


PROFILE_SQL = with_ctes(STAR, " union all ".join(
    f"select '{n}' as table_name, count(*) as row_count, {WIDTH[n]}::int as column_count, "
    + (" + ".join(f"count(*) filter ({c} is null)" for c in NULLABLE.get(n, [])) or "0::bigint")
    + f" as null_cells from {t}" for n, t in TABLES.items()))


@register("table_profile", PROFILE_SQL)
def table_profile(spark, folder):
    return P.table_profile(star_of(spark, folder))


@register("load_star", PROFILE_SQL)
def load_star(spark, folder):
    """The nine tables as CSV files, read back under their schemas."""
    base = shared_folder(spark, "star")
    paths = {}
    for name, df in star_of(spark, folder).items():
        paths[name] = f"{base}/{name}"
        df.write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(paths[name])
    return P.table_profile(readers.load_star(spark, paths))


@register("build_master", with_ctes(MASTER, f"""select {SEQ}, customer_id, order_status, order_purchase_timestamp,
order_delivered_customer_date, review_score, customer_state, seller_state, payment_value, category from master"""))
def build_master(spark, folder):
    return master_of(spark, folder).select(
        "order_id", "order_item_id", "seller_id", "price", "freight_value", "customer_id", "order_status",
        "order_purchase_timestamp", "order_delivered_customer_date", "review_score", "customer_state",
        "seller_state", "payment_value", "category")


@register("build_feature_base", with_ctes(FEATURES, f"""select {ORDER}, product_id, category, review_score from base"""))
def build_feature_base(spark, folder):
    return M.fill_review_score(M.build_feature_base(star_of(spark, folder))).select(
        "order_purchase_timestamp", "order_id", "order_item_id", "seller_id", "price", "freight_value", "product_id",
        "category", "review_score")


@register("category_label", with_ctes(STAR, """select product_id, coalesce(product_category_name_english,
product_category_name, 'unknown') as category from products left join translations using (product_category_name)"""))
def category_label_query(spark, folder):
    s = star_of(spark, folder)
    return s["products"].join(s["translations"], "product_category_name", "left").select(
        "product_id", category_label("product_category_name_english", "product_category_name").alias("category"))


@register("first_review", with_ctes(STAR, "select * from first_reviews"))
def first_review(spark, folder):
    return M.first_review(star_of(spark, folder)["reviews"])


@register("payments_per_order", with_ctes(STAR, "select * from paid"))
def payments_per_order(spark, folder):
    return M.payments_per_order(star_of(spark, folder)["payments"])


@register("orders_by_month", with_ctes(MASTER, """select cast(date_trunc('month', order_purchase_timestamp) as date) as
month, count(distinct order_id) as orders from master group by 1"""))
def orders_by_month(spark, folder):
    return M.orders_by_month(master_of(spark, folder))


@register("top_categories_by_revenue", with_ctes(MASTER, """select category,
cast(sum(cast(round(price * 10000) as bigint)) as double) / 10000 as revenue from master where category is not null
group by category order by revenue desc, category limit 20"""))
def top_categories(spark, folder):
    return M.top_categories(master_of(spark, folder))


@register("avg_price_by_category", with_ctes(MASTER, """select category,
cast(sum(cast(round(price * 10000) as bigint)) as double) / 10000 / count(*) as mean_price from master
where category is not null group by category order by mean_price desc, category limit 5"""))
def avg_price_by_category(spark, folder):
    return M.avg_price_by_category(master_of(spark, folder))


@register("sku_velocity", with_ctes(MASTER, f"""select product_id, count(distinct order_id) as orders,
count(distinct order_id)::double / (select (epoch_us(max(order_purchase_timestamp))
- epoch_us(min(order_purchase_timestamp))) // {DAY} from master) as orders_per_day from master group by product_id"""))
def sku_velocity(spark, folder):
    return M.sku_velocity(master_of(spark, folder))


@register("top_sku_velocity", with_ctes(MASTER, f"""select product_id, count(distinct order_id) as orders,
count(distinct order_id)::double / (select (epoch_us(max(order_purchase_timestamp))
- epoch_us(min(order_purchase_timestamp))) // {DAY} from master) as orders_per_day from master group by product_id
order by orders_per_day desc, product_id limit 5"""))
def top_sku_velocity(spark, folder):
    return M.sku_velocity(master_of(spark, folder), 5)


@register("score_distribution", with_ctes(MASTER, """select review_score, count(*) as row_count from master
where review_score is not null group by review_score"""))
def score_distribution(spark, folder):
    return M.score_distribution(master_of(spark, folder))


@register("log_price_histogram", with_ctes(MASTER, """vals as (select ln(1 + price) as v from master), ends as (
select min(v) as lo, max(v) as hi from vals)""", """select cast(least(floor((v - lo) * 50 / (hi - lo)), 49) as int) as bin,
round(any_value(lo + (hi - lo) * least(floor((v - lo) * 50 / (hi - lo)), 49) / 50), 6) as bin_start,
count(*) as row_count from vals, ends group by 1"""))
def log_price_histogram(spark, folder):
    return M.log_price_histogram(master_of(spark, folder)).withColumn("bin_start", F.round("bin_start", 6))


@register("data_quality", with_ctes(MASTER, """skus as (select product_id, count(*) as n from master group by 1)""",
                                    """select (select count(*) - count(distinct order_id) from master) as
duplicate_order_rows, count(*) filter (n < 5) as low_volume_skus, count(*) as skus,
count(*) filter (n < 5) / count(*)::double as low_volume_share from skus"""))
def data_quality(spark, folder):
    return M.data_quality(master_of(spark, folder))


@register("price_outliers", with_ctes(MASTER, f"""select {SEQ} from master where price > (select avg(price)
+ 3 * stddev_samp(price) from master)"""))
def price_outliers(spark, folder):
    return M.price_outliers(master_of(spark, folder)).select(
        "order_id", "order_item_id", "seller_id", "price", "freight_value")


THREE = ["price", "review_score", "freight_value"]


def corr_sql(columns, table, where="true"):
    one = "case when isnan(c) then null else round(c, 6) end"
    return " union all ".join(
        f"select '{a}' as a, '{b}' as b, " + ("1.0::double" if a == b else one)
        + f" as correlation from (select corr({a}, {b}) as c from {table} where {where})" for a in columns for b in columns)


@register("price_review_correlation", with_ctes(MASTER, corr_sql(THREE, "master", " and ".join(
    f"{c} is not null" for c in THREE))))
def price_review_correlation(spark, folder):
    return M.correlation_matrix(master_of(spark, folder), THREE).withColumn("correlation", F.round("correlation", 6))


@register("correlation_matrix", with_ctes(FEATURES, corr_sql([*MARKET_FEATURES, MARKET_TARGET], "features")))
def correlation_matrix(spark, folder):
    table = staged("market-features", spark, folder, lambda: features_of(spark, folder))  # read twice
    return M.correlation_matrix(table, [*MARKET_FEATURES, MARKET_TARGET]).withColumn(
        "correlation", F.round("correlation", 6))


@register("cyclic_encode", with_ctes(FEATURES, f"""select {ORDER}, round(hour_sin, 9) as hour_sin,
round(hour_cos, 9) as hour_cos, round(day_sin, 9) as day_sin, round(day_cos, 9) as day_cos from features"""))
def cyclic_encode(spark, folder):
    base = base_of(spark, folder)
    s, c = calendar.cyclic(F.hour(M.TS), 24.0)
    ds, dc = calendar.cyclic(F.weekday(M.TS), 7.0)
    return base.select(M.TS, *M.SEQ, F.round(s, 9).alias("hour_sin"), F.round(c, 9).alias("hour_cos"),
                       F.round(ds, 9).alias("day_sin"), F.round(dc, 9).alias("day_cos"))


@register("marketplace_flags", with_ctes(FEATURES, f"select {ORDER}, is_weekend, is_month_end from features"))
def marketplace_flags(spark, folder):
    base = base_of(spark, folder)
    flags = calendar.marketplace_flags(M.TS)
    return base.withColumns(flags).select(M.TS, *M.SEQ, *flags)


@register("holiday_flag", with_ctes(FEATURES, f"select {ORDER}, is_holiday from features"))
def holiday_flag(spark, folder):
    base = base_of(spark, folder)
    days = calendar.holidays_of(base, M.TS)
    return calendar.add_holiday_flag(base, M.TS, days).select(M.TS, *M.SEQ, "is_holiday")


@register("days_since_last_order", with_ctes(FEATURES, f"select {ORDER}, product_id, days_since_last_order from features"))
def days_since_last_order(spark, folder):
    w = Warehouse(spark, folder)
    df = M.demand_scores(base_of(spark, folder), w.heavy_market_products())
    return df.select(M.TS, *M.SEQ, "product_id", "days_since_last_order")


@register("demand_scores", with_ctes(FEATURES, f"""select {ORDER}, product_id, demand_score_7d, demand_score_30d,
demand_velocity, inventory_ratio from features"""))
def demand_scores(spark, folder):
    w = Warehouse(spark, folder)
    df = M.demand_scores(base_of(spark, folder), w.heavy_market_products())
    return df.select(M.TS, *M.SEQ, "product_id", "demand_score_7d", "demand_score_30d",
                     M.demand_velocity().alias("demand_velocity"), M.inventory_proxy().alias("inventory_ratio"))


@register("price_percentile", with_ctes(FEATURES, f"""select {ORDER}, category, price_percentile_in_category
from features"""))
def price_percentile(spark, folder):
    base = base_of(spark, folder)
    ranks = M.rank_shares(base, "category", "price", "price_percentile_in_category")
    return base.join(ranks, ["category", "price"]).select(M.TS, *M.SEQ, "category", "price_percentile_in_category")


@register("category_median", with_ctes(FEATURES, "select category, med as category_median from medians"))
def category_median(spark, folder):
    return M.category_median(base_of(spark, folder))


@register("competitor_delta", with_ctes(FEATURES, f"""select {ORDER}, competitor_delta, round(review_elasticity, 9) as
review_elasticity from features"""))
def competitor_delta(spark, folder):
    base = M.fill_review_score(base_of(spark, folder))
    return base.join(M.price_table(base), ["category", "price"]).select(
        M.TS, *M.SEQ, "competitor_delta", F.round(M.review_elasticity(), 9).alias("review_elasticity"))


_ROUND = ", ".join(f"round({c}, 9) as {c}" for c in FLOATS)


@register("market_features", with_ctes(FEATURES, f"""select {SEQ}, product_id, category, order_purchase_timestamp,
is_weekend, is_month_end, is_holiday, demand_score_7d, demand_score_30d, price_percentile_in_category,
round(optimal_price, 9) as optimal_price, {_ROUND} from features"""))
def market_features(spark, folder):
    """Ids, the 17 features and the target price."""
    df = features_of(spark, folder)
    return df.withColumns({**{c: F.round(c, 9) for c in FLOATS}, MARKET_TARGET: F.round(MARKET_TARGET, 9)})


@register("feature_projection", with_ctes(FEATURES, "select order_id, product_id, category, order_purchase_timestamp, "
          + ", ".join(c if c not in FLOATS else f"round({c}, 9) as {c}" for c in MARKET_FEATURES)
          + ", round(optimal_price, 9) as optimal_price from features"))
def feature_projection(spark, folder):
    df = M.feature_projection(features_of(spark, folder))
    return df.withColumns({**{c: F.round(c, 9) for c in FLOATS}, MARKET_TARGET: F.round(MARKET_TARGET, 9)})


@register("optimal_price", with_ctes(FEATURES, f"""select {ORDER}, round(optimal_price, 9) as optimal_price from features"""))
def optimal_price(spark, folder):
    w = Warehouse(spark, folder)
    df = M.fill_review_score(base_of(spark, folder))
    df = M.demand_scores(df, w.heavy_market_products())
    df = df.withColumns({"demand_velocity": M.demand_velocity(), "review_elasticity": M.review_elasticity()})
    return df.select(M.TS, *M.SEQ, F.round(M.optimal_price(), 9).alias("optimal_price"))


@register("last_30_by_category", with_ctes(FEATURES, f"""select {ORDER}, category, cast(position as int) as position from
(select *, row_number() over (partition by category order by order_purchase_timestamp desc, order_id desc,
order_item_id desc, seller_id desc, price desc, freight_value desc) as position from base) where position <= 30"""))
def last_30_by_category(spark, folder):
    return M.last_rows_by_category(base_of(spark, folder)).select(
        M.TS, *M.SEQ, "category", "position")


@register("category_price_stats", with_ctes(FEATURES, """select category, round(avg(optimal_price), 6) as mean,
round(stddev_samp(optimal_price), 6) as std from features group by category"""))
def category_price_stats(spark, folder):
    return M.category_price_stats(features_of(spark, folder)).withColumns(
        {"mean": F.round("mean", 6), "std": F.round("std", 6)})


@register("competitor_category_price", with_ctes(FEATURES, """select category, round(med, 2) as market_price
from medians"""))
def competitor_category_price(spark, folder):
    return M.competitor_category_price(base_of(spark, folder))


@register("nearest_to_quantile", with_ctes(FEATURES, """goals as (select quantile_cont(price, 0.95) as hi,
quantile_cont(price, 0.05) as lo, avg(price) + 3 * stddev_samp(price) as far from base)""", f"""
select * from (select 'high' as profile, {ORDER} from base, goals order by abs(price - hi), {ORDER} limit 1) union all
select * from (select 'low' as profile, {ORDER} from base, goals order by abs(price - lo), {ORDER} limit 1) union all
select * from (select 'outlier' as profile, {ORDER} from base, goals where price > far order by {ORDER} limit 1)"""))
def nearest_to_quantile(spark, folder):
    base = base_of(spark, folder).select(M.TS, *M.SEQ)
    return M.nearest_to_quantiles(base.withColumn("value", F.col("price")), "value").drop("value")


@register("ensure_columns", with_ctes(FEATURES, """select order_id, order_item_id, product_id, price,
0::double as not_there from base where price >= 50"""))
def ensure_columns(spark, folder):
    """A missing feature becomes 0, rows without a target go."""
    base = base_of(spark, folder).withColumn("aim", F.when(F.col("price") >= 50, F.col("price")))
    return M.ensure_columns(base, ["price", "not_there"], "aim").select("order_id", "order_item_id", "product_id", "price",
                                                                        "not_there")


@register("chrono_split_80_20", with_ctes(FEATURES, f"""select {ORDER}, product_id, case when
row_number() over (order by us, {SEQ}) - 1 < floor(0.8 * count(*) over ()) then 'train' else 'test' end as split
from base"""))
def chrono_split(spark, folder):
    base = base_of(spark, folder).select(M.TS, *M.SEQ, "product_id")
    return splits.chrono_split(base, M.TS, M.SEQ)


@register("time_series_folds", with_ctes(FEATURES, f"""ranked as (select *, row_number() over (order by us, {SEQ}) - 1 as i,
count(*) over () as n from base)""", f"""select {ORDER}, product_id, cast(greatest(0, 6 - ceil((n - i) / (n // 6)::double)) as int)
as fold from ranked"""))
def time_series_folds(spark, folder):
    base = base_of(spark, folder).select(M.TS, *M.SEQ, "product_id")
    return splits.time_series_folds(base, M.TS, M.SEQ)


KEYED = "('0x' || substr(md5(order_id || ':42'), 1, 13))::bigint"


@register("random_split", with_ctes(STAR, f"""select case when {KEYED} % 100 < 80 then 'train' else 'test' end as split,
count(*) as "count" from order_items group by 1"""))
def random_split(spark, folder):
    return splits.random_split(base_of(spark, folder), "order_id").groupBy("split").count()


@register("sample_n", with_ctes(STAR, f"select * from shop_orders order by {KEYED}, order_id limit 200"))
def sample_n(spark, folder):
    return P.sample_n(star_of(spark, folder)["orders"], "order_id", 200)


@register("sample_fraction", with_ctes(STAR, f"select * from shop_orders where {KEYED} % 1000000 < 200000"))
def sample_fraction(spark, folder):
    return P.sample_fraction(star_of(spark, folder)["orders"], "order_id", 0.2)


