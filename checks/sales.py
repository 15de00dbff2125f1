"""Queries on the transaction log: sources, cleaning, feature groups, targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ORACLES, register, staged, with_ctes
from pricetide.config import MICROS_PER_DAY, SETTINGS
from pricetide.functions import calendar, text
from pricetide.functions.core import exact_avg, flag, micros
from pricetide.operators import cleaning as C
from pricetide.operators import profiling as P
from pricetide.operators import sales_features as S
from pricetide.operators import targets as T
from pricetide.operators.splits import time_split
from pricetide.operators.windows import drop_internal, heavy_keys, rolling_sums
from pricetide.session import cut_lineage, shared_folder
from pricetide.sources import sinks
from pricetide.sources.schemas import validate_schema
from pricetide.sources.warehouse import Warehouse

# ------------------------------------------------------------------ SQL building blocks

LINES = """
lines as (
  select l_linestatus,
    case when l_returnflag = 'R' then 'C' else '' end || l_orderkey as invoice_no,
    case when l_partkey = 0 then 'post' when l_partkey = 1 then 'ab' else ' p' || l_partkey end as stock_code,
    case when p_size = 50 then null when p_size = 49 then 'Samples' else p_name || ' ' || case p_type
      when 'ECONOMY' then 'STORAGE BOX' when 'MEDIUM' then 'CANDLE HOLDER' when 'SMALL' then 'GIFT TAG'
      when 'PROMO' then 'CHRISTMAS CARD' when 'STANDARD' then 'GARDEN PLANT' when 'LARGE' then 'CUSHION COVER' end
      end as description,
    cast(l_quantity as int) as quantity,
    o_orderdate + to_minutes(cast((l_orderkey * 37) % 1440 as int)) as invoice_date,
    ((2 * cast(round(l_extendedprice * 100) as bigint) + cast(l_quantity as bigint))
      // (2 * cast(l_quantity as bigint))) / 100::double as unit_price,
    case when o_orderstatus <> 'P' then cast(o_custkey as varchar) end as customer_id,
    case when n_nationkey = 0 then 'United Kingdom' else n_name end as country
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
    join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)
"""
SALES = LINES + """,
sales as (
  select * exclude (l_linestatus), case when l_linestatus = 'O' then 'retail_i' else 'retail_ii' end as source,
    case when l_linestatus = 'O' then '2010-2011' else '2009-2011' end as dataset_year_range
  from lines)
"""
BAD_TEXT = "regexp_matches(upper(description), 'POSTAGE|BANK CHARGES|MANUAL|SAMPLES|AMAZON FEE')"
BAD_CODE = ("(regexp_full_match(upper(trim(stock_code)), '[A-Z]{1,2}') or upper(trim(stock_code)) in "
            "('POST', 'D', 'M', 'BANK CHARGES', 'PADS', 'DOT'))")
CLEAN = SALES + f""",
kept as (
  select invoice_no, upper(trim(stock_code)) as stock_code, description, quantity, invoice_date, unit_price,
    coalesce(customer_id, 'GUEST_' || invoice_no) as customer_id, country, source, dataset_year_range
  from sales
  where invoice_no not like 'C%' and quantity > 0 and unit_price between 0.01 and 5000 and quantity between 1 and 10000
    and length(trim(description)) >= 3 and not {BAD_TEXT} and not {BAD_CODE}),
clean as (
  select * exclude (copy), quantity * unit_price as revenue, cast(quantity >= 12 as int) as is_bulk,
    epoch_us(invoice_date) as us
  from (select *, row_number() over (partition by invoice_no, stock_code, quantity, unit_price
          order by invoice_date, description, customer_id, country, source) as copy from kept)
  where copy = 1)
"""
SEQ = "invoice_no, quantity, unit_price"
DAY = MICROS_PER_DAY


def minor(c: str) -> str:
    return f"cast(round({c} * 10000) as bigint)"


def avg_of(c: str) -> str:
    return f"cast(sum({minor(c)}) as double) / 10000 / count({c})"


def sum_of(c: str) -> str:
    return f"cast(sum({minor(c)}) as double) / 10000"


def clip_sql(c: str, low: str, high: str) -> str:
    return f"case when {c} is not null then greatest(least({c}, {high}), {low}) end"


def roll(c: str, days: int) -> str:
    """Range frame up to the row's instant without the later ties: another way than the engine's."""
    return (f"cast(sum({c}) over (partition by stock_code order by us range between {days * DAY - 1} preceding "
            f"and current row) - coalesce(sum({c}) over (partition by stock_code, us order by {SEQ} rows between "
            "1 following and unbounded following), 0) as bigint)")


ROLL_COLUMNS = ",\n".join(
    f"{roll('quantity', d)} as d{d}, {roll(minor('revenue'), d)} as r{d}, {roll('1', d)} as n{d}, "
    f"{roll(minor('unit_price'), d)} as p{d}" for d in (7, 14, 30))
LAGGED = ",\n".join(
    f"coalesce(lag(d{d}) over w, 0) as rolling_demand_{d}d, coalesce(lag(r{d}) over w / 10000::double, 0) as "
    f"rolling_revenue_{d}d, coalesce(lag(n{d}) over w, 0) as rolling_transactions_{d}d, "
    f"lag(p{d}) over w / 10000::double / lag(n{d}) over w as raw_avg_price_{d}d" for d in (7, 14, 30))
LAGS = ",\n".join(f"lag(unit_price, {n}) over w as price_lag_{n}, lag(quantity, {n}) over w as demand_lag_{n}"
                  for n in (1, 7, 14, 30))
STATS = CLEAN + f""",
stats as (
  select stock_code, {avg_of('unit_price')} as product_avg_price_global,
    coalesce(stddev_samp(unit_price), 0) as product_price_std, min(unit_price) as product_price_min,
    max(unit_price) as product_price_max, {sum_of('revenue')} as product_total_revenue,
    count(invoice_no) as product_transaction_count, cast(sum(quantity) as double) / count(*) as product_avg_quantity,
    max(unit_price) - min(unit_price) as product_price_range
  from clean group by stock_code)
"""
ROLLED = STATS + f""",
rolls as (select *, {ROLL_COLUMNS} from clean),
rolled as (
  select * exclude (d7, r7, n7, p7, d14, r14, n14, p14, d30, r30, n30, p30), {LAGGED}, {LAGS},
    lag(us) over w as prev_us,
    cast(sum(quantity) over (partition by stock_code order by us, {SEQ} rows unbounded preceding) as bigint)
      as cumulative_units_sold,
    cast(sum(quantity) over (partition by stock_code, cast(invoice_date as date)) as bigint) as units_sold_today
  from rolls window w as (partition by stock_code order by us, {SEQ})),
demand as (
  select r.*, s.* exclude (stock_code),
    coalesce(raw_avg_price_7d, product_avg_price_global) as rolling_avg_price_7d,
    coalesce(raw_avg_price_14d, product_avg_price_global) as rolling_avg_price_14d,
    coalesce(raw_avg_price_30d, product_avg_price_global) as rolling_avg_price_30d,
    greatest(least(coalesce(rolling_demand_7d / nullif(rolling_demand_14d, 0), 0), 10), 0) as demand_acceleration_14d,
    greatest(least(coalesce(rolling_demand_7d / nullif(rolling_demand_30d, 0), 0), 10), 0) as demand_acceleration_30d,
    cast(greatest(least(coalesce((us - prev_us) // {DAY}, 0), 90), 0) as int) as days_since_last_sale
  from rolled r join stats s using (stock_code))
"""
CATEGORY = """case
  when regexp_matches(upper(description), 'DECORATION|DECOR|ORNAMENT|CANDLE|HOLDER|FRAME|MIRROR') then 'HOME_DECOR'
  when regexp_matches(upper(description), 'MUG|CUP|PLATE|BOWL|JAR|BOTTLE|KITCHEN|STORAGE') then 'KITCHEN'
  when regexp_matches(upper(description), 'CARD|WRAP|PAPER|PEN|NOTEBOOK|LABEL|STAMP') then 'STATIONERY'
  when regexp_matches(upper(description), 'GIFT|BOX|PACK|BAG|WRAP|RIBBON|TAG') then 'GIFT'
  when regexp_matches(upper(description), 'CHRISTMAS|XMAS|EASTER|HALLOWEEN|HEART|VALENTINE') then 'SEASONAL'
  when regexp_matches(upper(description), 'CUSHION|BLANKET|TOWEL|FABRIC|CLOTH|BAG') then 'TEXTILE'
  when regexp_matches(upper(description), 'GARDEN|PLANT|OUTDOOR|BIRD') then 'GARDEN' else 'OTHER' end"""
ELASTIC = ROLLED + f""",
raw_elastic as (
  select *, {CATEGORY} as product_category,
    (unit_price - rolling_avg_price_30d) / nullif(rolling_avg_price_30d, 0) as pct_price_change,
    (rolling_demand_7d - rolling_demand_30d / 4) / nullif(rolling_demand_30d / 4, 0) as pct_demand_change
  from demand),
gap_elastic as (select *, {clip_sql('pct_demand_change / nullif(pct_price_change, 0)', '-10', '0')} as e0
  from raw_elastic),
medians as (select product_category, quantile_cont(e0, 0.5) as med from gap_elastic group by product_category),
filled as (select g.*, coalesce(e0, med, -1.5) as price_elasticity_30d
  from gap_elastic g join medians using (product_category)),
elastic as (
  select *, cast(price_elasticity_30d < -1 as int) as is_price_elastic,
    case when price_elasticity_30d = -1 then product_price_min else greatest(least(
      unit_price * (price_elasticity_30d / nullif(price_elasticity_30d + 1, 0)), product_price_max * 1.5),
      product_price_min) end as optimal_price_elasticity_estimate
  from filled)
"""
RISK = ELASTIC + """,
paced as (select *, units_sold_today / case when rolling_demand_30d = 0 then 1 else rolling_demand_30d / 30 end
  as units_sold_vs_30d_avg from elastic),
risky as (select *, demand_acceleration_30d * 0.5 + greatest(least(units_sold_vs_30d_avg, 5), 0) / 5 * 0.3
  + 1.0::double / (days_since_last_sale + 1) * 0.2 as risk from paced),
risk_ends as (select min(risk) as lo, max(risk) as hi from risky)
"""
WEEKS = CLEAN + f""",
weeks as (
  select stock_code, weekofyear(invoice_date) || '_' || year(invoice_date) as week_year,
    {sum_of('revenue')} as week_revenue, {avg_of('unit_price')} as week_price
  from clean group by all)
"""
BEST = """
week_limit as (select stock_code, quantile_cont(week_revenue, 0.75) as q from weeks group by stock_code),
best as (
  select stock_code, list_reduce(list(week_price order by week_year), lambda a, b: a + b) / count(*)
    as optimal_price_historical
  from weeks join week_limit using (stock_code) where week_revenue >= q group by stock_code)
"""
LINE_KEY = "stock_code, invoice_no, quantity, unit_price"
KEY = ["stock_code", "invoice_no", "quantity", "unit_price"]


def clean_of(spark, folder):
    """The cleaned stage; the query ``clean_sales`` itself runs all its steps."""
    w = Warehouse(spark, folder)
    return staged("clean", spark, folder, lambda: C.clean_sales(w.sales()))


def heavy_of(spark, folder):
    return Warehouse(spark, folder).heavy_products()


def lift(sql_type: str, *names: str) -> str:
    return ", ".join(f"cast({n} as {sql_type}) as {n}" for n in names)


# ------------------------------------------------------------------ sources and profiles

SALE_COLUMNS = ("invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country, "
                "source, dataset_year_range")


@register("load_source", with_ctes(SALES, f"select {SALE_COLUMNS} from sales where source = 'retail_i'"))
def load_source(spark, folder):
    from pricetide.sources.readers import standardise
    return standardise(Warehouse(spark, folder).source_one(), "retail_i", "2010-2011")


@register("union_sources", with_ctes(SALES, f"select {SALE_COLUMNS} from sales"))
def union_of_sources(spark, folder):
    return Warehouse(spark, folder).two_sources()


@register("dataset_summary", with_ctes(SALES, """
select count(*) as row_count, min(invoice_date) as first_date, max(invoice_date) as last_date,
  count(distinct stock_code) as products, count(distinct customer_id) as customers from sales"""))
def dataset_summary(spark, folder):
    return P.dataset_summary(Warehouse(spark, folder).sales())


FINGERPRINT = ("invoice_no,stock_code,description,quantity,invoice_date,unit_price,customer_id,country,source,"
               "dataset_year_range,revenue,is_bulk")


@register("data_fingerprint", with_ctes(CLEAN, f"""select count(*) as row_count, md5('{FINGERPRINT}_' || count(*) || '_'
|| {len(FINGERPRINT.split(","))}) as shape_hash from clean"""))
def data_fingerprint(spark, folder):
    return P.data_fingerprint(clean_of(spark, folder)).drop("content_hash")


@register("content_fingerprint")
def content_fingerprint(spark, folder):
    return P.data_fingerprint(clean_of(spark, folder))


# ------------------------------------------------------------------ cleaning steps

def _step(name, fn, where="true", columns=SALE_COLUMNS):
    @register(name, with_ctes(SALES, f"select {columns} from sales where {where}"))
    def run(spark, folder):
        return fn(Warehouse(spark, folder).sales())
    return run


_step("drop_cancellations", C.drop_cancellations, "invoice_no not like 'C%' and quantity > 0")
_step("filter_price", C.filter_price, "unit_price >= 0.01 and unit_price <= 5000")
_step("filter_quantity", C.filter_quantity, "quantity >= 1 and quantity <= 10000")
_step("filter_description", C.filter_description, f"length(trim(description)) >= 3 and not {BAD_TEXT}")
_step("guest_customer", C.guest_customer, columns=SALE_COLUMNS.replace(
    "customer_id", "coalesce(customer_id, 'GUEST_' || invoice_no) as customer_id"))
_step("normalise_code", C.normalise_code, f"not {BAD_CODE}", SALE_COLUMNS.replace(
    "stock_code", "upper(trim(stock_code)) as stock_code"))
_step("add_revenue", C.add_revenue, columns=SALE_COLUMNS + ", quantity * unit_price as revenue")
_step("bulk_flag", C.bulk_flag, columns=SALE_COLUMNS + ", cast(quantity >= 12 as int) as is_bulk")
_step("final_cast", C.final_cast)


@register("dedup_sales", with_ctes(SALES, f"""select {SALE_COLUMNS} from (
  select *, row_number() over (partition by invoice_no, stock_code, quantity, unit_price order by invoice_date,
    description, customer_id, country, source) as copy from
    (select * from sales union all select * from sales where source = 'retail_ii')) where copy = 1"""))
def dedup_sales(spark, folder):
    """With every line of one source present twice."""
    sales = Warehouse(spark, folder).sales()
    return C.dedup_sales(sales.unionByName(sales.filter(F.col("source") == "retail_ii")))


@register("clean_sales", with_ctes(CLEAN, f"select {SALE_COLUMNS}, revenue, is_bulk from clean"))
def clean_sales(spark, folder):
    return C.clean_sales(Warehouse(spark, folder).sales())


@register("clean_report", with_ctes(SALES, f"""
select count(*) as rows_in,
  count(*) filter (why = 'cancelled') as removed_cancelled, count(*) filter (why = 'price') as removed_price,
  count(*) filter (why = 'quantity') as removed_quantity,
  count(*) filter (why = 'description') as removed_description, count(*) filter (why = 'code') as removed_code,
  count(*) filter (why = 'ok') - count(distinct case when why = 'ok' then line end) as removed_duplicate,
  count(distinct case when why = 'ok' then line end) as rows_out
from (select case when invoice_no like 'C%' or quantity <= 0 then 'cancelled'
    when unit_price not between 0.01 and 5000 then 'price' when quantity not between 1 and 10000 then 'quantity'
    when description is null or length(trim(description)) < 3 or {BAD_TEXT} then 'description'
    when {BAD_CODE} then 'code' else 'ok' end as why,
  row(invoice_no, upper(trim(stock_code)), quantity, unit_price) as line from sales)"""))
def clean_report(spark, folder):
    return C.clean_report(Warehouse(spark, folder).sales())


@register("describe_sales", with_ctes(CLEAN, " union all ".join(
    f"select '{c}' as \"column\", count({c}) as rows, round(avg({c}), 6) as mean, round(stddev_samp({c}), 4) as std, "
    f"cast(min({c}) as double) as lowest, cast(max({c}) as double) as highest from clean"
    for c in ("quantity", "unit_price", "revenue", "is_bulk"))))
def describe_sales(spark, folder):
    d = C.describe_sales(clean_of(spark, folder))
    return d.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 4)})


@register("drop_tail", with_ctes(CLEAN, f"""select {LINE_KEY}, invoice_date from clean
where invoice_date < (select max(invoice_date) from clean) - interval 7 days"""))
def drop_tail(spark, folder):
    return C.drop_tail(clean_of(spark, folder), "invoice_date").select(*KEY, "invoice_date")


# ------------------------------------------------------------------ scalar features

@register("calendar_parts", with_ctes(CLEAN, f"""select {LINE_KEY}, {lift('int', 'hour', 'day_of_month', 'month',
'quarter', 'year', 'week_of_year', 'day_of_week')} from (select *, hour(invoice_date) as hour,
isodow(invoice_date) - 1 as day_of_week, day(invoice_date) as day_of_month, weekofyear(invoice_date) as week_of_year,
month(invoice_date) as month, quarter(invoice_date) as quarter, year(invoice_date) as year from clean)"""))
def calendar_parts(spark, folder):
    return clean_of(spark, folder).withColumns(calendar.calendar_parts("invoice_date")).select(
        *KEY, "hour", "day_of_week", "day_of_month", "week_of_year", "month", "quarter", "year")


@register("calendar_flags", with_ctes(CLEAN, f"""select {LINE_KEY},
cast(isodow(invoice_date) >= 6 as int) as is_weekend, cast(day(invoice_date) <= 3 as int) as is_month_start,
cast(day(invoice_date) >= 28 as int) as is_month_end, cast(month(invoice_date) in (11, 12) as int) as is_christmas_season,
cast(month(invoice_date) = 2 and weekofyear(invoice_date) = 7 as int) as is_valentine_week,
cast(month(invoice_date) = 4 and weekofyear(invoice_date) in (14, 15) as int) as is_easter_approx,
cast(month(invoice_date) in (6, 7, 8) as int) as is_summer,
cast(month(invoice_date) = 1 and day(invoice_date) <= 7 as int) as is_new_year from clean"""))
def calendar_flags(spark, folder):
    flags = calendar.calendar_flags("invoice_date")
    return clean_of(spark, folder).withColumns(flags).select(*KEY, *flags)


@register("days_to_christmas", with_ctes(CLEAN, f"""select {LINE_KEY}, cast(greatest(least((epoch_us(
  make_timestamp(year(invoice_date) + case when invoice_date > make_timestamp(year(invoice_date), 12, 25, 0, 0, 0)
  then 1 else 0 end, 12, 25, 0, 0, 0)) - us) // {DAY}, 365), 0) as int) as days_to_christmas from clean"""))
def days_to_christmas(spark, folder):
    return clean_of(spark, folder).select(*KEY, calendar.days_to_christmas("invoice_date").alias("days_to_christmas"))


@register("time_of_day", with_ctes(CLEAN, f"""select {LINE_KEY}, case when hour(invoice_date) <= 6 then 3
when hour(invoice_date) <= 12 then 0 when hour(invoice_date) <= 17 then 1 when hour(invoice_date) <= 21 then 2
else 3 end as time_of_day from clean"""))
def time_of_day(spark, folder):
    return clean_of(spark, folder).select(*KEY, calendar.time_of_day("invoice_date").alias("time_of_day"))


@register("categorise", with_ctes(CLEAN, f"select {LINE_KEY}, {CATEGORY} as product_category from clean"))
def categorise(spark, folder):
    return clean_of(spark, folder).select(*KEY, text.categorise("description").alias("product_category"))


@register("label_encode", with_ctes(CLEAN, f"""labels as (select c, cast(row_number() over (order by c) - 1 as int)
as product_category_id from (select distinct {CATEGORY} as c from clean))""",
          f"select {LINE_KEY}, c as product_category, product_category_id from clean join labels on c = {CATEGORY}"))
def label_encode(spark, folder):
    return S.category_ids(clean_of(spark, folder)).select(*KEY, "product_category", "product_category_id")


@register("label_encode_open", with_ctes(CLEAN, """labels as (select country, cast(row_number() over (order by country)
- 1 as int) as country_id from (select distinct country from clean))""",
          f"select {LINE_KEY}, country, country_id from clean join labels using (country)"))
def label_encode_open(spark, folder):
    """The same for a column whose values are not fixed beforehand."""
    return S.label_encode(clean_of(spark, folder), "country", "country_id").select(*KEY, "country", "country_id")


@register("word_count", with_ctes(CLEAN, f"""select {LINE_KEY}, cast(len(list_filter(string_split_regex(description,
'\\s+'), lambda w: w <> '')) as int) as product_name_length from clean"""))
def word_count(spark, folder):
    return clean_of(spark, folder).select(*KEY, text.word_count("description").alias("product_name_length"))


@register("price_relatives", with_ctes(STATS, f"""select {LINE_KEY},
unit_price / product_avg_price_global as price_vs_product_mean,
(product_avg_price_global - unit_price) / product_avg_price_global * 100 as price_discount_pct,
cast((product_avg_price_global - unit_price) / product_avg_price_global * 100 > 5 as int) as is_discounted
from clean join stats using (stock_code)"""))
def price_relatives(spark, folder):
    c = clean_of(spark, folder)
    means = c.groupBy("stock_code").agg(exact_avg("unit_price").alias("m"))
    pct = (F.col("m") - F.col("unit_price")) / F.col("m") * 100
    return c.join(means, "stock_code").select(
        *KEY, (F.col("unit_price") / F.col("m")).alias("price_vs_product_mean"),
        pct.alias("price_discount_pct"), flag(pct > 5).alias("is_discounted"))


# ------------------------------------------------------------------ aggregates

@register("product_stats", with_ctes(STATS, """select * replace (round(product_price_std, 6) as product_price_std)
from stats"""))
def product_stats(spark, folder):
    return S.product_stats(clean_of(spark, folder)).withColumn("product_price_std", F.round("product_price_std", 6))


def _read_back(name, write, read, columns="stock_code, product_price_min, product_transaction_count"):
    """A sink: product statistics written by it and read again."""
    @register(name, with_ctes(STATS, f"select {columns} from stats"))
    def run(spark, folder):
        path = shared_folder(spark, name)
        write(S.product_stats(clean_of(spark, folder)).select(*columns.split(", ")), path)
        return read(spark.read, path)
    return run


_read_back("write_stage", lambda df, path: sinks.write_stage(df, path, ["product_transaction_count"]),
           lambda reader, path: reader.parquet(path).withColumn("product_transaction_count", F.col(
               "product_transaction_count").cast("long")))
_read_back("report_csv", sinks.report_csv, lambda reader, path: reader.schema(
    "stock_code string, product_price_min double, product_transaction_count long").csv(path, header=True))
_read_back("write_metrics_json", sinks.write_metrics_json, lambda reader, path: reader.schema(
    "stock_code string, product_price_min double, product_transaction_count long").json(path))


@register("validate_schema", with_ctes(STATS, "select stock_code, product_price_max from stats"))
def checked_schema(spark, folder):
    return validate_schema(S.product_stats(clean_of(spark, folder)).select("stock_code", "product_price_max"),
                           ["stock_code", "product_price_max"])


@register("popularity_rank", with_ctes(STATS, """
edges as (select quantile_cont(product_transaction_count, [0, 0.2, 0.4, 0.6, 0.8, 1]) as e from stats)""", """
select stock_code, product_transaction_count, cast(case when len(list_distinct(e)) = 6 then
    1 + (product_transaction_count > e[2])::int + (product_transaction_count > e[3])::int
    + (product_transaction_count > e[4])::int + (product_transaction_count > e[5])::int
  else 1 + (product_transaction_count > e[1] + (e[6] - e[1]) / 5)::int
    + (product_transaction_count > e[1] + (e[6] - e[1]) / 5 * 2)::int
    + (product_transaction_count > e[1] + (e[6] - e[1]) / 5 * 3)::int
    + (product_transaction_count > e[1] + (e[6] - e[1]) / 5 * 4)::int end as int) as product_popularity_rank
from stats, edges"""))
def popularity_rank(spark, folder):
    return S.popularity_rank(S.product_stats(clean_of(spark, folder))).select(
        "stock_code", "product_transaction_count", "product_popularity_rank")


@register("country_stats", with_ctes(CLEAN, f"""select country, {avg_of('unit_price')} as country_avg_price,
count(*) / (select count(*) from clean)::double as country_demand_share from clean group by country"""))
def country_stats(spark, folder):
    return S.country_stats(clean_of(spark, folder))


@register("customer_stats", with_ctes(CLEAN, f"""select customer_id, {sum_of('revenue')} as customer_lifetime_value,
count(distinct invoice_date) as customer_purchase_frequency,
cast(sum(quantity) as double) / count(*) as customer_avg_basket_size,
round(coalesce(stddev_samp(unit_price), 0), 6) as customer_price_sensitivity from clean group by customer_id"""))
def customer_stats(spark, folder):
    return S.customer_stats(clean_of(spark, folder)).withColumn(
        "customer_price_sensitivity", F.round("customer_price_sensitivity", 6))


@register("wholesale_flags", with_ctes(CLEAN, """baskets as (select customer_id, cast(sum(quantity) as double) / count(*)
as b from clean group by customer_id)""", f"""select {LINE_KEY}, cast(country = 'United Kingdom' as int) as is_uk,
cast(is_bulk = 1 or b > 20 as int) as is_wholesale_customer from clean join baskets using (customer_id)"""))
def wholesale_flags(spark, folder):
    c = clean_of(spark, folder)
    return S.add_customer_features(c, S.country_stats(c), S.customer_stats(c)).select(
        *KEY, "is_uk", "is_wholesale_customer")


@register("daily_demand", with_ctes(CLEAN, """select stock_code, cast(invoice_date as date) as date,
cast(sum(quantity) as bigint) as daily_qty from clean group by all"""))
def daily_demand(spark, folder):
    return S.daily_demand(clean_of(spark, folder))


@register("trend_slope", with_ctes(CLEAN, """days as (select stock_code, cast(invoice_date as date) as d,
sum(quantity) as q from clean group by all)""", """last as (select *, row_number() over (partition by stock_code
order by d) as i from days qualify row_number() over (partition by stock_code order by d desc) <= 30)""", """
select stock_code, round(case when count(*) < 2 then 0 else regr_slope(q, i) end, 6) as demand_trend_slope
from last group by stock_code"""))
def trend_slope(spark, folder):
    return S.trend_slope(clean_of(spark, folder)).withColumn("demand_trend_slope", F.round("demand_trend_slope", 6))


@register("hourly_demand", with_ctes(CLEAN, """select stock_code, cast(hour(invoice_date) as int) as hour,
cast(sum(quantity) as double) / count(*) as h_mean, round(stddev_samp(quantity), 6) as h_std
from clean group by all"""))
def hourly_demand(spark, folder):
    return S.hourly_demand(clean_of(spark, folder)).withColumn("h_std", F.round("h_std", 6))


@register("transaction_zscore", with_ctes(CLEAN, """hours as (select stock_code, hour(invoice_date) as h,
avg(quantity) as m, stddev_samp(quantity) as s from clean group by all)""", f"""
select {LINE_KEY}, round((quantity - m) / case when s = 0 then 1 else s end, 6) as hourly_demand_zscore,
coalesce(cast((quantity - m) / case when s = 0 then 1 else s end > 2.5 as int), 0) as is_flash_sale_window
from clean c join hours using (stock_code) where h = hour(invoice_date)"""))
def transaction_zscore(spark, folder):
    """Mean and deviation per product and hour, joined back."""
    c = clean_of(spark, folder)
    df = c.join(S.hourly_profile(c), "stock_code", "left").withColumn("product_avg_price_global", F.lit(1.0))
    return S.add_flash_features(df).select(
        *KEY, F.round("hourly_demand_zscore", 6).alias("hourly_demand_zscore"), "is_flash_sale_window")


@register("price_history", with_ctes(CLEAN, f"""select stock_code, cast(invoice_date as date) as date,
{avg_of('unit_price')} as mean_price, cast(sum(quantity) as bigint) as units from clean group by all"""))
def price_history(spark, folder):
    return P.price_history(clean_of(spark, folder))


@register("distinct_sorted", with_ctes(CLEAN, """select product_category, cast(row_number() over (order by
product_category) as int) as position from (select distinct """ + CATEGORY + """ as product_category from clean)"""))
def distinct_sorted(spark, folder):
    c = clean_of(spark, folder).select(text.categorise("description").alias("product_category"))
    return P.distinct_sorted(c, "product_category")


# ------------------------------------------------------------------ windows

@register("rolling_demand", with_ctes(ROLLED, f"""select {LINE_KEY}, """ + ", ".join(
    f"rolling_{m}_{d}d" for d in (7, 14, 30) for m in ("demand", "revenue", "transactions", "avg_price"))
    + " from demand"))
def rolling_demand(spark, folder):
    c = clean_of(spark, folder)
    means = c.groupBy("stock_code").agg(exact_avg("unit_price").alias("product_avg_price_global"))
    df = S.add_rolling(c, heavy=heavy_of(spark, folder)).join(means, "stock_code")
    return df.select(*KEY, *[
        F.coalesce(f"rolling_{m}_{d}d", "product_avg_price_global").alias(f"rolling_{m}_{d}d") if m == "avg_price"
        else F.col(f"rolling_{m}_{d}d") for d in (7, 14, 30) for m in ("demand", "revenue", "transactions", "avg_price")])


@register("row_lags", with_ctes(ROLLED, f"select {LINE_KEY}, " + ", ".join(
    f"price_lag_{n}, demand_lag_{n}" for n in (1, 7, 14, 30)) + " from rolled"))
def row_lags(spark, folder):
    df = S.add_rolling(clean_of(spark, folder), heavy=heavy_of(spark, folder))
    return df.select(*KEY, *[f"{m}_lag_{n}" for m in ("price", "demand") for n in (1, 7, 14, 30)])


@register("cumulative_units", with_ctes(ROLLED, f"""select {LINE_KEY}, cumulative_units_sold, units_sold_today,
days_since_last_sale from demand"""))
def cumulative_units(spark, folder):
    """Running units, units of the day and days since the previous sale."""
    df = S.units_today(S.add_rolling(clean_of(spark, folder), heavy=heavy_of(spark, folder)), heavy_of(spark, folder))
    return df.withColumn("days_since_last_sale", S.days_since_last_sale()).select(
        *KEY, "cumulative_units_sold", "units_sold_today", "days_since_last_sale")


@register("windows_in_hours", with_ctes(ROLLED, f"""select {LINE_KEY}, rolling_demand_7d, rolling_revenue_30d,
price_lag_1, demand_lag_30, cumulative_units_sold, units_sold_today, days_since_last_sale from demand"""))
def windows_in_hours(spark, folder):
    """The sales windows where products of 30 lines or more are cut into hours and the others are not."""
    c = clean_of(spark, folder)
    heavy = heavy_keys(c, "stock_code", 30)
    df = S.units_today(S.add_rolling(c, heavy=heavy), heavy)
    return df.withColumn("days_since_last_sale", S.days_since_last_sale()).select(
        *KEY, "rolling_demand_7d", "rolling_revenue_30d", "price_lag_1", "demand_lag_30", "cumulative_units_sold",
        "units_sold_today", "days_since_last_sale")


def _demand_frame(spark, folder):
    c = clean_of(spark, folder)
    df = S.units_today(S.add_rolling(c, heavy=heavy_of(spark, folder)), heavy_of(spark, folder))
    df = df.withColumn("days_since_last_sale", S.days_since_last_sale()).drop("_prev_us")
    df = df.join(S.product_stats(c), "stock_code").withColumn("demand_trend_slope", F.lit(0.0))
    return S.add_demand_features(df).withColumn("product_category", text.categorise("description"))


@register("demand_acceleration", with_ctes(ROLLED, f"""select {LINE_KEY}, demand_acceleration_14d,
demand_acceleration_30d from demand"""))
def demand_acceleration(spark, folder):
    return _demand_frame(spark, folder).select(*KEY, "demand_acceleration_14d", "demand_acceleration_30d")


@register("price_elasticity", with_ctes(ELASTIC, f"""select {LINE_KEY}, round(price_elasticity_30d, 6) as
price_elasticity_30d, is_price_elastic, round(optimal_price_elasticity_estimate, 4) as
optimal_price_elasticity_estimate from elastic"""))
def price_elasticity(spark, folder):
    # medians read the rows several times, so the windows are written once, as in build_features
    df = S.fill_elasticity(cut_lineage(S.raw_elasticity(_demand_frame(spark, folder)), "elasticity"))
    return df.select(*KEY, F.round("price_elasticity_30d", 6).alias("price_elasticity_30d"), "is_price_elastic",
                     F.round("optimal_price_elasticity_estimate", 4).alias("optimal_price_elasticity_estimate"))


@register("stockout_risk", with_ctes(RISK, f"""select {LINE_KEY}, round(units_sold_vs_30d_avg, 6) as
units_sold_vs_30d_avg, round((risk - lo) / (hi - lo), 6) as stockout_risk_score from risky, risk_ends"""))
def stockout_risk(spark, folder):
    df = S.add_inventory_features(_demand_frame(spark, folder))
    df = S.global_minmax(df, "stockout_risk_raw", "stockout_risk_score")
    return df.select(*KEY, F.round("units_sold_vs_30d_avg", 6).alias("units_sold_vs_30d_avg"),
                     F.round("stockout_risk_score", 6).alias("stockout_risk_score"))


COMPETITORS = """
supplier_means as (select l_partkey, l_suppkey, cast(sum((2 * cast(round(l_extendedprice * 100) as bigint)
  + cast(l_quantity as bigint)) // (2 * cast(l_quantity as bigint))) as double) / 100 / count(*) as m
  from lineitem group by all),
competitors as (select 'P' || l_partkey as stock_code, list_sort(list(m))[1] as c1, list_sort(list(m))[2] as c2
  from supplier_means group by l_partkey)
"""


@register("competitor_features", with_ctes(CLEAN, COMPETITORS, f"""rivals as (select c.*, {clip_sql('c1', '0.01', '5000')}
as competitor_price_1, {clip_sql('c2', '0.01', '5000')} as competitor_price_2
from clean c left join competitors using (stock_code))""", f"""select {LINE_KEY}, competitor_price_1, competitor_price_2,
(competitor_price_1 + competitor_price_2) / 2 as competitor_avg_price,
unit_price / ((competitor_price_1 + competitor_price_2) / 2) as price_vs_competitor,
unit_price - (competitor_price_1 + competitor_price_2) / 2 as competitor_price_gap,
coalesce(cast(unit_price / ((competitor_price_1 + competitor_price_2) / 2) <= 1.05 as int), 0)
as is_price_competitive from rivals"""))
def competitor_features(spark, folder):
    prices = Warehouse(spark, folder).competitor_prices()
    return S.add_competitor_features(clean_of(spark, folder), prices).select(
        *KEY, "competitor_price_1", "competitor_price_2", "competitor_avg_price", "price_vs_competitor",
        "competitor_price_gap", "is_price_competitive")


# The feature frame in SQL is the line, with the SQL of each group joined to it.
LINE_GROUPS = ["calendar_parts", "calendar_flags", "days_to_christmas", "time_of_day", "label_encode", "word_count",
               "price_relatives", "rolling_demand", "row_lags", "cumulative_units", "demand_acceleration",
               "price_elasticity", "stockout_risk", "competitor_features", "wholesale_flags", "transaction_zscore"]
KEYED_GROUPS = {"product_stats": "stock_code", "trend_slope": "stock_code", "country_stats": "country",
                "customer_stats": "customer_id", "hourly_demand": "stock_code, hour"}
TEXT_COLUMNS = ["stock_code", "customer_id", "country", "product_category", "invoice_no", "description", "invoice_date",
                "source", "dataset_year_range"]
ROUNDED = {"price_elasticity_30d": 6, "optimal_price_elasticity_estimate": 4, "units_sold_vs_30d_avg": 6,
           "stockout_risk_score": 6, "hourly_demand_zscore": 6, "demand_trend_slope": 6, "product_price_std": 6,
           "customer_price_sensitivity": 6, "h_std": 6, "pct_price_change": 6, "pct_demand_change": 6}
WHOLE_FRAME = "with " + ",\n".join(
    f"{name}_part as materialized (select * from ({ORACLES[name]}))"
    for name in ["clean_sales", *LINE_GROUPS, *KEYED_GROUPS, "popularity_rank"]) + ",\npct_part as (" + with_ctes(
    ELASTIC, f"select {LINE_KEY}, round(pct_price_change, 6) as pct_price_change, round(pct_demand_change, 6) "
             "as pct_demand_change from elastic") + f""")
select {", ".join(TEXT_COLUMNS)}, columns(lambda c: c not in ({", ".join(f"'{c}'" for c in TEXT_COLUMNS)}))
from (select coalesce(columns(lambda c: c not in ({", ".join(f"'{c}'" for c in TEXT_COLUMNS)})), 0),
    {", ".join(TEXT_COLUMNS)}
  from (select *, epoch_us(invoice_date) as us from clean_sales_part
    {" ".join(f"join {g}_part using ({LINE_KEY})" for g in [*LINE_GROUPS, "pct"])}
    {" ".join(f"left join {g}_part using ({k})" for g, k in KEYED_GROUPS.items())}
    left join (select stock_code, product_popularity_rank from popularity_rank_part) using (stock_code)))"""


@register("build_features", WHOLE_FRAME)
def build_features(spark, folder):
    """All eight groups in one frame, every column of it."""
    w = Warehouse(spark, folder)
    df = S.build_features(clean_of(spark, folder), w.competitor_prices(), heavy=w.heavy_products())
    return df.withColumns({c: F.round(c, places) for c, places in ROUNDED.items()})


@register("null_cleanup", with_ctes(ROLLED, f"""select {LINE_KEY}, """ + ", ".join(
    f"coalesce(price_lag_{n}, 0) as price_lag_{n}, coalesce(demand_lag_{n}, 0) as demand_lag_{n}"
    for n in (1, 7, 14, 30)) + " from rolled"))
def null_cleanup(spark, folder):
    df = S.add_rolling(clean_of(spark, folder), heavy=heavy_of(spark, folder))
    return S.null_cleanup(df.select(*KEY, *[f"{m}_lag_{n}" for m in ("price", "demand") for n in (1, 7, 14, 30)]))


# ------------------------------------------------------------------ targets

def forward(c: str) -> str:
    return (f"cast(sum({c}) over (partition by stock_code order by us range between current row and {7 * DAY - 1} "
            f"following) - coalesce(sum({c}) over (partition by stock_code, us order by {SEQ} rows between "
            "unbounded preceding and 1 preceding), 0) as bigint)")


FORWARD = CLEAN + f""",
aheads as (select *, {forward('quantity')} as fd, {forward(minor('revenue'))} as fr from clean),
ahead as (select *, coalesce(lead(fd) over w, 0) as forward_demand_7d,
  coalesce(lead(fr) over w / 10000::double, 0) as forward_revenue_7d
  from aheads window w as (partition by stock_code order by us, {SEQ}))
"""


@register("forward_sums", with_ctes(FORWARD, f"select {LINE_KEY}, forward_demand_7d, forward_revenue_7d from ahead"))
def forward_sums(spark, folder):
    return T.forward_sums(clean_of(spark, folder), heavy=heavy_of(spark, folder)).select(
        *KEY, "forward_demand_7d", "forward_revenue_7d")


@register("weekly_stats", with_ctes(WEEKS, "select * from weeks"))
def weekly_stats(spark, folder):
    return T.weekly_stats(clean_of(spark, folder))


@register("historical_best_price", with_ctes(WEEKS, BEST, "select stock_code, optimal_price_historical from best"))
def historical_best_price(spark, folder):
    return T.historical_best_price(clean_of(spark, folder))


@register("target_price", with_ctes(ELASTIC, WEEKS.replace(CLEAN + ",", "").replace(CLEAN, ""), BEST, f"""
select {LINE_KEY}, round(greatest(least(0.40 * unit_price + 0.35 * optimal_price_historical
  + 0.25 * optimal_price_elasticity_estimate, product_price_max * 1.5), product_price_min * 0.5), 8) as target_price
from elastic join best using (stock_code)
where invoice_date < (select max(invoice_date) from clean) - interval 7 days"""))
def target_price(spark, folder):
    w = Warehouse(spark, folder)
    heavy = w.heavy_products()
    f = S.build_features(clean_of(spark, folder), w.competitor_prices(), heavy=heavy)
    return T.create_target(f, heavy=heavy).select(*KEY, F.round("target_price", 8).alias("target_price"))


@register("map_lookup", with_ctes(WEEKS, BEST, """
stats as (select stock_code, count(*) as n from clean group by stock_code),
days as (select stock_code, cast(invoice_date as date) as d, sum(quantity) as q from clean group by all),
last as (select *, row_number() over (partition by stock_code order by d) as i from days
  qualify row_number() over (partition by stock_code order by d desc) <= 30),
slopes as (select stock_code, case when count(*) < 2 then 0 else regr_slope(q, i) end as slope from last group by 1)""",
                               f"""select {LINE_KEY}, n as product_transaction_count, {CATEGORY} as product_category,
round(slope, 6) as demand_trend_slope, optimal_price_historical
from clean join stats using (stock_code) join slopes using (stock_code) join best using (stock_code)"""))
def map_lookup(spark, folder):
    """Per-product values looked up on every sale: one joined table, then one join."""
    c = clean_of(spark, folder)
    table = (c.groupBy("stock_code").agg(F.count("*").alias("product_transaction_count"))
             .join(S.trend_slope(c), "stock_code").join(T.historical_best_price(c), "stock_code"))
    return c.join(table, "stock_code", "left").select(
        *KEY, "product_transaction_count", text.categorise("description").alias("product_category"),
        F.round("demand_trend_slope", 6).alias("demand_trend_slope"), "optimal_price_historical")


@register("sort_by_product_time", with_ctes(CLEAN, f"""select {LINE_KEY}, row_number() over (partition by stock_code
order by us, {SEQ}) as position from clean"""))
def sort_by_product_time(spark, folder):
    """Position of each sale in its product's time order."""
    c = clean_of(spark, folder).withColumn("us", micros("invoice_date"))
    out = rolling_sums(c, "stock_code", "us", S.SEQ, {"position": F.lit(1)}, {"all": None}, heavy=heavy_of(spark, folder))
    return drop_internal(out).select(*KEY, F.col("position_all").alias("position"))


@register("time_split", with_ctes(CLEAN, f"""select {LINE_KEY}, case when invoice_date < timestamp '2000-01-01'
then 'train' when invoice_date < timestamp '2001-01-01' then 'valid' else 'test' end as split from clean"""))
def time_split_query(spark, folder):
    return time_split(clean_of(spark, folder), "invoice_date", "2000-01-01", "2001-01-01").select(*KEY, "split")


# ------------------------------------------------------------------ events out of sales

@register("order_event_json", with_ctes(CLEAN, f"""select stock_code, invoice_no, quantity, unit_price, customer_id,
country, 'order' as event_type, strftime(invoice_date, '%Y-%m-%dT%H:%M:%S') as stamp from clean"""))
def order_event_json(spark, folder):
    """Written as JSON records and read back field by field."""
    from pricetide.sources.readers import parse_json
    from pricetide.sources.schemas import ORDER_EVENT
    back = parse_json(sinks.order_event_json(clean_of(spark, folder)), ORDER_EVENT)
    return back.withColumnRenamed("timestamp", "stamp")


@register("order_source", with_ctes(CLEAN, """select stock_code, invoice_no, quantity, unit_price, customer_id,
country, 'order' as event_type, strftime(invoice_date, '%Y-%m-%dT%H:%M:%S') as stamp from clean"""))
def order_source(spark, folder):
    """The records as text on a topic, subscribed to as a stream; what does not parse is left out."""
    from pricetide.sources.readers import event_stream
    from pricetide.sources.schemas import ORDER_EVENT
    from pricetide.streaming.routing import run_to_files
    topic, out, checkpoint = (shared_folder(spark, n) for n in ("topic", "orders", "checkpoint"))
    sinks.order_event_json(clean_of(spark, folder)).select("value").write.text(topic)
    spark.createDataFrame([('{"event_type": ',), ("no json",)], "value string").write.mode("append").text(topic)
    run_to_files(event_stream(spark, ORDER_EVENT, "text", path=topic), out, checkpoint)
    return spark.read.schema(ORDER_EVENT).parquet(out).withColumnRenamed("timestamp", "stamp")


@register("publish_updates", with_ctes(CLEAN, """newest as (select stock_code, arg_max(unit_price, (us, invoice_no, quantity,
unit_price)) as price, max(invoice_date) as t from clean group by stock_code)""", """select stock_code as key, price,
price as final_price, strftime(t, '%Y-%m-%dT%H:%M:%S') as stamp from newest"""))
def publish_updates(spark, folder):
    """Price updates written as keyed records and read back field by field."""
    newest = clean_of(spark, folder).groupBy(F.col("stock_code").alias("sku_id")).agg(
        F.max_by("unit_price", F.struct("invoice_date", "invoice_no", "quantity", "unit_price")).alias("final_price"),
        F.max("invoice_date").alias("timestamp"))
    path = shared_folder(spark, "updates")
    sinks.publish_updates(newest, "json", path=path)
    body = "sku_id string, price double, decision struct<final_price: double>, timestamp string"
    back = spark.read.schema("key string, value string").json(path).select("key", F.from_json("value", body).alias("v"))
    return back.select("key", "v.price", "v.decision.final_price", F.col("v.timestamp").alias("stamp"))


@register("load_or_build", with_ctes(CLEAN, """select step, count(*) as lines, sum(quantity)::bigint as units from
(select quantity, unnest(case when source = 'a' then ['built', 'loaded', 'changed'] else ['changed'] end) as step from (
select quantity, case when quantity % 2 = 0 then 'a' else 'b' end as source from clean)) group by step"""))
def load_or_build(spark, folder):
    """A stage built, loaded again without building, and built anew once its input has changed."""
    from pricetide.sources.readers import load_or_build as op
    source, stage = shared_folder(spark, "input"), shared_folder(spark, "stage")
    c, out, built = clean_of(spark, folder).select("quantity"), [], []

    def step(name):
        def build():
            built.append(name)
            return spark.read.parquet(source)
        return op(spark, stage, build, (source,)).agg(F.count("*").alias("lines"), F.sum("quantity").alias("units")).select(
            F.lit(name).alias("step"), "lines", "units")

    c.filter("quantity % 2 = 0").write.parquet(source)
    out += [step("built"), step("loaded")]
    c.filter("quantity % 2 <> 0").write.mode("append").parquet(source)
    out.append(step("changed"))
    assert built == ["built", "changed"]
    return out[0].union(out[1]).union(out[2])


@register("spike_baseline", with_ctes(CLEAN, """slots as (select stock_code, us // 300000000 as slot, sum(quantity) as q
from clean group by all)""", "select stock_code, quantile_cont(q, 0.5) as baseline_rate from slots group by stock_code"))
def spike_baseline(spark, folder):
    from pricetide.streaming.spikes import spike_baseline as op
    return op(clean_of(spark, folder).select("stock_code", F.col("invoice_date").alias("ts"), "quantity"))


@register("trailing_rate", with_ctes(CLEAN, f"""select {LINE_KEY}, cast(sum(quantity) over (partition by stock_code
order by us range between 300000000 preceding and current row) - coalesce(sum(quantity) over (partition by stock_code,
us order by {SEQ} rows between 1 following and unbounded following), 0) as bigint) as trailing_rate from clean"""))
def trailing_rate(spark, folder):
    c = clean_of(spark, folder).withColumn("us", micros("invoice_date"))
    out = rolling_sums(c, "stock_code", "us", S.SEQ, {"rate": F.col("quantity")},
                       {"300s": SETTINGS.spike_seconds * 1_000_000}, closed=True, heavy=heavy_of(spark, folder))
    return drop_internal(out).select(*KEY, F.col("rate_300s").alias("trailing_rate"))
