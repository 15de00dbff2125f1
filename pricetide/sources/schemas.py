"""Explicit schemas: nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
          "timestamp": T.TimestampType(), "boolean": T.BooleanType()}


def _struct(text: str) -> T.StructType:
    pairs = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SALES = _struct(
    "invoice_no string, stock_code string, description string, quantity int, invoice_date timestamp, "
    "unit_price double, customer_id string, country string, source string, dataset_year_range string")

# Column names the two transaction sources use.
SALES_RENAMES = {
    "InvoiceNo": "invoice_no", "Invoice": "invoice_no", "StockCode": "stock_code",
    "Description": "description", "Quantity": "quantity", "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price", "Price": "unit_price", "CustomerID": "customer_id",
    "Customer ID": "customer_id", "Country": "country",
}

STAR = {
    "order_items": _struct("order_id string, order_item_id int, product_id string, seller_id string, "
                           "price double, freight_value double"),
    "orders": _struct("order_id string, customer_id string, order_status string, "
                      "order_purchase_timestamp timestamp, order_approved_at timestamp, "
                      "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
                      "order_estimated_delivery_date timestamp"),
    "products": _struct("product_id string, product_category_name string"),
    "translations": _struct("product_category_name string, product_category_name_english string"),
    "reviews": _struct("order_id string, review_score int, review_time timestamp"),
    "payments": _struct("order_id string, payment_value double"),
    "customers": _struct("customer_id string, customer_state string"),
    "sellers": _struct("seller_id string, seller_state string"),
    "geolocation": _struct("geolocation_state string, geolocation_region string"),
}

ORDER_EVENT = _struct("event_type string, stock_code string, invoice_no string, quantity int, "
                      "unit_price double, customer_id string, country string, timestamp string")
STREAM_EVENT = _struct("sku_id string, price double, timestamp string")
INVENTORY_EVENT = _struct("sku_id string, current_stock double, avg_daily_demand double, timestamp string")

FEATURE_LOG = _struct("sku_id string, feature string, value double, event_ts timestamp, ttl_seconds int")

RULE_REQUEST = _struct("sku_id string, inventory_level double, demand_score double, customer_segment int, "
                       "is_flash_sale boolean, cost_price double, msrp double")
MODEL_REQUEST = _struct("stock_code string, current_price double, quantity int, country string, "
                        "timestamp timestamp").add(
    "adjustment_factors", _struct("stockout_risk double, flash_sale boolean, inventory_excess double"))

# Model inputs of the marketplace price model.
MARKET_FEATURES = [
    "price", "freight_value", "hour_sin", "hour_cos", "day_sin", "day_cos", "is_weekend", "is_month_end",
    "is_holiday", "days_since_last_order", "demand_score_7d", "demand_score_30d", "demand_velocity",
    "inventory_ratio", "price_percentile_in_category", "competitor_delta", "review_elasticity",
]
MARKET_TARGET = "optimal_price"


def validate_schema(df: DataFrame, required: list[str]) -> DataFrame:
    """The frame itself, or an error that names every missing column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
