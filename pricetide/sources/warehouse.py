"""The canonical tables of the engine, derived from an order warehouse in Parquet.

``sales``, the marketplace star and the event streams are views over lineitem, orders, customer, part,
supplier, nation and events.  Prices are whole cents, as in a shop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricetide.config import SETTINGS
from pricetide.operators.windows import heavy_keys
from pricetide.session import prepare
from pricetide.sources.readers import standardise, union_sources

# Product nouns by part type, so that descriptions carry category words.
NOUNS = {"ECONOMY": "STORAGE BOX", "MEDIUM": "CANDLE HOLDER", "SMALL": "GIFT TAG",
         "PROMO": "CHRISTMAS CARD", "STANDARD": "GARDEN PLANT", "LARGE": "CUSHION COVER"}


def cents(total: str = "l_extendedprice", quantity: str = "l_quantity"):
    """Price per unit in whole cents, halves up, in integer arithmetic."""
    t, q = f"cast(round({total} * 100) as bigint)", f"cast({quantity} as bigint)"
    return F.expr(f"(2 * {t} + {q}) div (2 * {q})")


class Warehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- online-retail transaction log

    def _lines(self) -> DataFrame:
        """Sales lines.  Order columns and product texts are made on the small sides, so a line meets
        two tables and builds only its own price."""
        li, o = self.table("lineitem"), self.table("orders")
        c, n, p = self.table("customer"), self.table("nation"), self.table("part")
        places = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "c_custkey", F.when(F.col("n_nationkey") == 0, SETTINGS.home_country)
            .otherwise(F.col("n_name")).alias("country"))
        orders = o.join(places, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey",
            F.timestamp_add("MINUTE", ((F.col("o_orderkey") * 37) % 1440).cast("int"),
                            F.col("o_orderdate").cast("timestamp")).alias("invoice_date"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("customer_id"), "country")
        code = (F.when(F.col("p_partkey") == 0, "post").when(F.col("p_partkey") == 1, "ab")
                .otherwise(F.concat(F.lit(" p"), F.col("p_partkey").cast("string"))))
        noun = F.create_map(*[F.lit(x) for kv in NOUNS.items() for x in kv])
        text = (F.when(F.col("p_size") == 50, F.lit(None)).when(F.col("p_size") == 49, "Samples")
                .otherwise(F.concat_ws(" ", "p_name", noun[F.col("p_type")])))
        parts = p.select("p_partkey", code.alias("stock_code"), text.alias("description"))
        # from the line's own columns, so that a filter on it is applied before the line travels
        number = F.col("l_orderkey").cast("string")
        invoice = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("C"), number)).otherwise(number)
        return (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                .join(parts, F.col("l_partkey") == F.col("p_partkey"))
                .select("l_linestatus", invoice.alias("invoice_no"), "stock_code", "description",
                        F.col("l_quantity").cast("int").alias("quantity"), "invoice_date",
                        (cents() / F.lit(100.0)).alias("unit_price"), "customer_id", "country"))

    def source_one(self) -> DataFrame:
        """The newer source, under its own column names."""
        return self._lines().filter(F.col("l_linestatus") == "O").select(
            F.col("invoice_no").alias("InvoiceNo"), F.col("stock_code").alias("StockCode"),
            F.col("description").alias("Description"), F.col("quantity").alias("Quantity"),
            F.col("invoice_date").alias("InvoiceDate"), F.col("unit_price").alias("UnitPrice"),
            F.col("customer_id").alias("CustomerID"), F.col("country").alias("Country"))

    def source_two(self) -> DataFrame:
        return self._lines().filter(F.col("l_linestatus") == "F").select(
            F.col("invoice_no").alias("Invoice"), F.col("stock_code").alias("StockCode"),
            F.col("description").alias("Description"), F.col("quantity").alias("Quantity"),
            F.col("invoice_date").alias("InvoiceDate"), F.col("unit_price").alias("Price"),
            F.col("customer_id").alias("Customer ID"), F.col("country").alias("Country"))

    def two_sources(self) -> DataFrame:
        return union_sources([standardise(self.source_one(), "retail_i", "2010-2011"),
                              standardise(self.source_two(), "retail_ii", "2009-2011")])

    def sales(self) -> DataFrame:
        """Both sources in one pass: the tags follow the line status, so lineitem is read once."""
        first = F.col("l_linestatus") == "O"
        return self._lines().withColumns({
            "source": F.when(first, "retail_i").otherwise("retail_ii"),
            "dataset_year_range": F.when(first, "2010-2011").otherwise("2009-2011"),
        }).drop("l_linestatus")

    def heavy_products(self) -> DataFrame:
        """Stock codes with many lines, counted on the one column of the raw table."""
        keys = heavy_keys(self.table("lineitem").select("l_partkey"), "l_partkey")
        return keys.select(F.concat(F.lit("P"), "l_partkey").alias("stock_code"))

    def competitor_prices(self) -> DataFrame:
        """The two lowest supplier mean prices of each product."""
        means = (self.table("lineitem")
                 .groupBy("l_partkey", "l_suppkey").agg(F.sum(cents()).alias("s"), F.count("*").alias("n"))
                 .select("l_partkey", "l_suppkey", (F.col("s") / F.lit(100.0) / F.col("n")).alias("m")))
        # the limit of two per product is applied before the rows travel
        place = F.row_number().over(Window.partitionBy("l_partkey").orderBy("m", "l_suppkey"))
        best = means.withColumn("_r", place).filter(F.col("_r") <= 2).groupBy("l_partkey").agg(
            F.min("m").alias("competitor_price_1"), F.max(F.when(F.col("_r") == 2, F.col("m"))).alias("competitor_price_2"))
        return best.select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("stock_code"),
                           "competitor_price_1", "competitor_price_2")

    # ---- marketplace star

    def star(self) -> dict[str, DataFrame]:
        li, o, p = self.table("lineitem"), self.table("orders"), self.table("part")
        c, s = self.table("customer"), self.table("supplier")
        n, r = self.table("nation"), self.table("region")
        price = cents()
        tax = F.round(F.col("l_tax") * 100).cast("bigint")
        at = F.timestamp_add("MINUTE", ((F.col("o_orderkey") * 37) % 1440).cast("int"),
                             F.col("o_orderdate").cast("timestamp"))
        items = li.select(
            F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            (price / F.lit(100.0)).alias("price"),
            (F.floor(price * tax / 100) / F.lit(100.0)).alias("freight_value"))
        orders = o.select(
            F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"), at.alias("order_purchase_timestamp"),
            F.timestamp_add("HOUR", F.lit(1), at).alias("order_approved_at"),
            F.when(F.col("o_orderstatus") != "P", F.timestamp_add("DAY", F.lit(2), at))
            .alias("order_delivered_carrier_date"),
            F.when(F.col("o_orderstatus") == "F", F.timestamp_add("DAY", F.lit(7), at))
            .alias("order_delivered_customer_date"),
            F.timestamp_add("DAY", F.lit(21), at).alias("order_estimated_delivery_date"))
        products = p.select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.when(F.col("p_size") != 50, F.col("p_type")).alias("product_category_name"))
        translations = (p.select("p_type").distinct().filter(F.col("p_type") != "PROMO")
                        .select(F.col("p_type").alias("product_category_name"),
                                F.concat(F.lower("p_type"), F.lit("_goods")).alias("product_category_name_english")))
        # a score for every settled order, and a second, later one where a line came back
        settled = o.filter(F.col("o_orderstatus") != "P").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            (F.col("o_orderkey") % 5 + 1).cast("int").alias("review_score"),
            F.col("o_orderdate").cast("timestamp").alias("review_time"))
        returned = li.filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").cast("string").alias("order_id"), F.lit(1).alias("review_score"),
            F.col("l_shipdate").cast("timestamp").alias("review_time"))
        payments = o.select(F.col("o_orderkey").cast("string").alias("order_id"),
                            F.col("o_totalprice").alias("payment_value"))
        return {
            "order_items": items, "orders": orders, "products": products, "translations": translations,
            "reviews": settled.unionByName(returned), "payments": payments,
            "customers": c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
                F.col("c_custkey").cast("string").alias("customer_id"), F.col("n_name").alias("customer_state")),
            "sellers": s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
                F.col("s_suppkey").cast("string").alias("seller_id"), F.col("n_name").alias("seller_state")),
            "geolocation": n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
                F.col("n_name").alias("geolocation_state"), F.col("r_name").alias("geolocation_region")),
        }

    def heavy_market_products(self) -> DataFrame:
        keys = heavy_keys(self.table("lineitem").select("l_partkey"), "l_partkey")
        return keys.select(F.col("l_partkey").cast("string").alias("product_id"))

    # ---- event streams: a user stands for a SKU

    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @staticmethod
    def orders_of(events: DataFrame) -> DataFrame:
        return events.filter(F.col("event_type") == "purchase").select(
            F.col("user_id").cast("string").alias("sku_id"), F.col("value").alias("price"), "ts", "event_id")

    @staticmethod
    def activity_of(events: DataFrame) -> DataFrame:
        """Orders and clicks, the two topics of the demand stream."""
        return events.filter(F.col("event_type").isin("purchase", "click", "view")).select(
            F.col("user_id").cast("string").alias("sku_id"), F.col("value").alias("price"), "ts", "event_id",
            "event_type")

    @staticmethod
    def clicks_of(events: DataFrame) -> DataFrame:
        return events.filter(F.col("event_type").isin("click", "view")).select(
            F.col("user_id").cast("string").alias("sku_id"), "ts", "event_id")

    @staticmethod
    def inventory_of(events: DataFrame) -> DataFrame:
        stock = F.get_json_object("props", "$.k").cast("double")
        return events.filter(F.col("event_type").isin("signup", "error")).select(
            F.col("user_id").cast("string").alias("sku_id"), stock.alias("current_stock"),
            (F.col("value") / F.lit(4.0)).alias("avg_daily_demand"), "ts", "event_id")

    def feature_log(self) -> DataFrame:
        """Live feature writes: demand from clicks, stock from inventory, prices from orders."""
        e = self.events()
        name = (F.when(F.col("event_type").isin("click", "view"), "demand_score_7d")
                .when(F.col("event_type").isin("signup", "error"), "inventory_ratio").otherwise("competitor_price"))
        ttl = (F.when(F.col("event_type").isin("click", "view"), SETTINGS.ttl_demand)
               .when(F.col("event_type").isin("signup", "error"), SETTINGS.ttl_inventory)
               .otherwise(SETTINGS.ttl_competitor))
        return e.select(F.col("user_id").cast("string").alias("sku_id"), name.alias("feature"),
                        F.col("value"), F.col("ts").alias("event_ts"), ttl.cast("int").alias("ttl_seconds"),
                        "event_id")

    # ---- price requests, one per part

    def rule_requests(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("sku_id"),
            ((F.col("p_size") - 1) / F.lit(48.0)).alias("inventory_level"),
            (F.col("p_partkey") / F.lit(1.9)).alias("demand_score"),
            (F.col("p_partkey") % 6).cast("int").alias("customer_segment"),
            (F.col("p_brand") == "Brand#1").alias("is_flash_sale"),
            (F.col("p_retailprice") * F.lit(1.5)).alias("cost_price"),
            (F.col("p_retailprice") * F.lit(2.5)).alias("msrp"))

    def model_requests(self) -> DataFrame:
        size = F.col("p_size") / F.lit(50.0)
        factors = F.struct(size.alias("stockout_risk"), (F.col("p_brand") == "Brand#2").alias("flash_sale"),
                           (F.lit(1.0) - size).alias("inventory_excess"))
        return self.table("part").select(
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("stock_code"),
            (F.col("p_retailprice") * (F.col("p_size") - 1)).alias("current_price"),
            F.when(F.col("p_size") != 5, F.col("p_size") - 2).alias("quantity"),
            F.when(F.col("p_type") == "PROMO", SETTINGS.home_country)
            .when(F.col("p_brand") != "Brand#2", F.lit("NATION_1")).alias("country"),
            F.timestamp_add("HOUR", F.col("p_size") * 9, F.lit("2001-01-01 00:00:00").cast("timestamp"))
            .alias("timestamp"),
            F.when(F.col("p_type") != "LARGE", factors).alias("adjustment_factors"))
