"""Cleaning of the transaction log, and a one-pass report of what each step takes out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetide.config import SETTINGS, Settings
from pricetide.functions.core import flag

# Descriptions and codes that are not products.
STOP_PHRASES = ["POSTAGE", "DOTCOM POSTAGE", "BANK CHARGES", "MANUAL", "SAMPLES", "AMAZON FEE"]
STOP_CODES = ["POST", "D", "M", "BANK CHARGES", "PADS", "DOT"]

DEDUP_KEYS = ["invoice_no", "stock_code", "quantity", "unit_price"]


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def is_sale() -> Column:
    """Neither cancelled nor returned."""
    return ~_yes(F.col("invoice_no").startswith("C")) & _yes(F.col("quantity") > 0)


def price_in_range(s: Settings = SETTINGS) -> Column:
    return _yes(F.col("unit_price").between(s.min_price, s.max_price))


def quantity_in_range(s: Settings = SETTINGS) -> Column:
    return _yes(F.col("quantity").between(s.min_quantity, s.max_quantity))


def describes_product(s: Settings = SETTINGS) -> Column:
    long_enough = F.length(F.trim("description")) >= s.min_description
    return _yes(long_enough & ~F.upper("description").rlike("|".join(STOP_PHRASES)))


def clean_code() -> Column:
    return F.upper(F.trim("stock_code"))


def is_product_code(code: Column) -> Column:
    return _yes(~code.rlike(r"^\p{L}{1,2}$") & ~code.isin(STOP_CODES))


def drop_cancellations(df: DataFrame) -> DataFrame:
    return df.filter(is_sale())


def filter_price(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    return df.filter(price_in_range(s))


def filter_quantity(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    return df.filter(quantity_in_range(s))


def filter_description(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    return df.filter(describes_product(s))


def guest_customer(df: DataFrame) -> DataFrame:
    return df.withColumn("customer_id", F.coalesce("customer_id", F.concat(F.lit("GUEST_"), "invoice_no")))


def normalise_code(df: DataFrame) -> DataFrame:
    return df.withColumn("stock_code", clean_code()).filter(is_product_code(F.col("stock_code")))


def add_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", F.col("quantity") * F.col("unit_price"))


def bulk_flag(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    return df.withColumn("is_bulk", flag(F.col("quantity") >= s.bulk_quantity))


def dedup_sales(df: DataFrame) -> DataFrame:
    """The earliest of the lines that share invoice, product, quantity and price.

    A minimum over a struct, not a ranked window: copies collapse before the shuffle, so any number of
    them is harmless.
    """
    rest = [c for c in df.columns if c not in DEDUP_KEYS and c != "invoice_date"]
    first = F.min(F.struct("invoice_date", *rest)).alias("_first")
    kept = df.groupBy(*DEDUP_KEYS).agg(first).select(*DEDUP_KEYS, "_first.*")
    return kept.select(*df.columns)


def final_cast(df: DataFrame) -> DataFrame:
    types = {"quantity": "int", "unit_price": "double", "revenue": "double", "customer_id": "string",
             "stock_code": "string"}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def clean_sales(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """All ten steps.  The filters are row-wise and reach the scan; only the dedup shuffles, without the columns that
    follow from its keys."""
    for step in (drop_cancellations, lambda d: filter_price(d, s), lambda d: filter_quantity(d, s),
                 lambda d: filter_description(d, s), guest_customer, normalise_code, dedup_sales,
                 add_revenue, lambda d: bulk_flag(d, s), final_cast):
        df = step(df)
    return df


def clean_report(df: DataFrame, s: Settings = SETTINGS) -> DataFrame:
    """Rows each step removes, in one row, from one pass (a row counts for the first step it fails)."""
    reason = (F.when(~is_sale(), "cancelled").when(~price_in_range(s), "price")
              .when(~quantity_in_range(s), "quantity").when(~describes_product(s), "description")
              .when(~is_product_code(clean_code()), "code").otherwise("ok"))
    tagged = df.withColumn("_why", reason).withColumn("_code", clean_code())
    # distinct lines per reason: copies collapse before the shuffle
    lines = tagged.groupBy("_why", F.when(F.col("_why") == "ok", F.struct(
        "invoice_no", "_code", "quantity", "unit_price")).alias("_line")).agg(F.count(F.lit(1)).alias("n"))

    def count_of(why: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_why") == why, F.col("n"))), F.lit(0))

    return lines.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        *[count_of(w).alias(f"removed_{w}") for w in ("cancelled", "price", "quantity", "description", "code")],
        F.coalesce(F.sum(F.when(F.col("_why") == "ok", F.col("n") - 1)), F.lit(0)).alias("removed_duplicate"),
        F.count(F.when(F.col("_why") == "ok", 1)).alias("rows_out"))


def describe_sales(df: DataFrame) -> DataFrame:
    """count, mean, std, min and max of the numeric columns, one row per column."""
    names = ["quantity", "unit_price", "revenue", "is_bulk"]
    # four columns: each row becomes a fixed four
    long = df.select(*[F.col(n).cast("double").alias(n) for n in names]).unpivot([], names, "column", "value")
    return long.groupBy("column").agg(
        F.count("value").alias("rows"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"))


def drop_tail(df: DataFrame, ts: str, days: int = SETTINGS.forward_days) -> DataFrame:
    """Rows more than ``days`` before the last one; the later ones have no complete future."""
    last = df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) < last - F.expr(f"interval {days} days"))
