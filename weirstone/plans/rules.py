"""The quality rules of every table, layer by layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirstone.layout import GOLD_TABLES
from weirstone.operators.keys import UNKNOWN_KEY
from weirstone.operators.quality import Check
from weirstone.schemas import SOURCE_TABLES

# Accepted codes and shapes.
CHANGE_OPS = ("c", "r", "u")
ORDER_STATUSES = (
    "DELIVERED",
    "SHIPPED",
    "CANCELED",
    "UNAVAILABLE",
    "INVOICED",
    "PROCESSING",
    "CREATED",
    "APPROVED",
)
PAYMENT_TYPES = ("CREDIT_CARD", "BOLETO", "VOUCHER", "DEBIT_CARD")
RATINGS = ("POSITIVE", "NEUTRAL", "NEGATIVE", "UNKNOWN")
SENTIMENTS = ("POSITIVE", "NEUTRAL", "NEGATIVE")
STATE_SHAPE = "^[A-Z]{2}$"
ZIP_SHAPE = "^[0-9]{5}$"


def _missing_or(column: str, condition: Column) -> Column:
    return F.col(column).isNull() | condition


def _within(column: str, low: int, high: int) -> Column:
    return _missing_or(column, F.col(column).between(low, high))


def _given(column: str) -> Column:
    return F.col(column).isNotNull()


def _resolved(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(UNKNOWN_KEY)) != UNKNOWN_KEY


def bronze_checks() -> dict[str, Check]:
    """Raw events: several per key are normal, so only the envelope and the key's presence count."""
    envelope = {
        "Valid CDC op": F.col("op").isin(*CHANGE_OPS),
        "Has ts_ms": F.col("ts_ms") > 0,
        "Has after image": _given("after"),
    }
    return {
        table: Check(
            keys=tuple(f"after.{column}" for column in source.key),
            rules=envelope,
            row_filter=F.col("op") != "d",
            unique=False,
        )
        for table, source in SOURCE_TABLES.items()
    }


# The check names, bounds and value lists in the three functions of checks.


def silver_checks() -> dict[str, Check]:
    col = F.col
    return {
        "olist_customers": Check(
            ("customer_id",),
            {
                "Valid State Code": col("customer_state").rlike(STATE_SHAPE),
                "Valid Zip Code": col("customer_zip_code_prefix").rlike(ZIP_SHAPE),
                "Valid Latitude": _within("customer_latitude", -90, 90),
                "Valid Longitude": _within("customer_longitude", -180, 180),
            },
        ),
        "olist_sellers": Check(
            ("seller_id",),
            {
                "Valid State Code": col("seller_state").rlike(STATE_SHAPE),
                "Valid Latitude": _within("seller_latitude", -90, 90),
                "Valid Longitude": _within("seller_longitude", -180, 180),
            },
        ),
        "olist_products": Check(
            ("product_id",),
            {
                "Positive Weight": _missing_or("product_weight_g", col("product_weight_g") > 0),
                "Positive Volume": _missing_or("product_volume_cm3", col("product_volume_cm3") > 0),
            },
        ),
        "olist_orders": Check(
            ("order_id",),
            {
                "Valid Status": col("order_status").isin(*ORDER_STATUSES),
                "Purchase Before Delivery": _missing_or(
                    "order_delivered_customer_date",
                    col("order_purchase_timestamp") <= col("order_delivered_customer_date"),
                ),
            },
        ),
        "olist_order_items": Check(
            ("order_id", "order_item_id"),
            {
                "Positive Price": col("price") >= 0,
                "Positive Freight": col("freight_value") >= 0,
                "Valid Total": col("total_item_value") >= 0,
            },
        ),
        "olist_order_payments": Check(
            ("order_id", "payment_sequential"),
            {
                "Valid Payment Type": col("payment_type").isin(*PAYMENT_TYPES),
                "Positive Amount": col("payment_value") > 0,
                "Valid Installments": col("payment_installments") >= 1,
            },
        ),
        "olist_order_reviews": Check(
            ("review_id", "order_id"),
            {
                "Valid Score": col("review_score").between(1, 5),
                "Valid Rating": col("review_rating").isin(*RATINGS),
            },
        ),
        "click_customers": Check(
            ("customer_id",),
            {"Valid Email": col("email").contains("@"), "Valid Age": _within("age", 0, 120)},
        ),
        "click_products": Check(
            ("product_id",),
            {"Non-negative Price": col("price_usd") >= 0, "Non-negative Cost": col("cost_usd") >= 0},
        ),
        "click_sessions": Check(
            ("session_id",),
            {
                "Has Start Time": _given("start_time"),
                "Has Device": _given("device"),
                "Has Source": _given("source"),
            },
        ),
        "click_orders": Check(
            ("order_id",),
            {
                "Has Order Time": _given("order_time"),
                "Non-negative Total": col("total_usd") >= 0,
                "Non-negative Discount": col("discount_pct") >= 0,
            },
        ),
        "click_order_items": Check(
            ("order_id", "product_id"),
            {"Positive Quantity": col("quantity") >= 1, "Non-negative Unit Price": col("unit_price_usd") >= 0},
        ),
        "click_events": Check(
            ("event_id",),
            {"Has Event Type": _given("event_type"), "Has Timestamp": _given("event_timestamp")},
        ),
        "click_reviews": Check(
            ("review_id",),
            {"Valid Rating": col("rating").between(1, 5), "Valid Sentiment": col("sentiment").isin(*SENTIMENTS)},
        ),
    }


# Surrogate key of each gold table.
GOLD_KEYS = {
    "dim_date": "date_sk",
    "dim_customer": "customer_sk",
    "dim_seller": "seller_sk",
    "dim_product": "product_sk",
    "dim_device": "device_sk",
    "dim_traffic_source": "source_sk",
    "dim_click_customer": "customer_sk",
    "dim_click_product": "product_sk",
    "fact_orders": "order_item_sk",
    "fact_reviews": "review_sk",
    "fact_click_orders": "order_sk",
    "fact_sessions": "session_sk",
    "fact_clickstream_events": "event_sk",
    "fact_click_reviews": "review_sk",
}

# References that must not be unknown, per fact.
RESOLVED_KEYS = {
    "fact_orders": ("customer", "product", "seller", "date"),
    "fact_reviews": ("customer", "date"),
    "fact_click_orders": ("customer", "device", "source", "date"),
    "fact_sessions": ("customer", "device", "source", "date"),
    "fact_clickstream_events": ("session", "date"),
    "fact_click_reviews": ("order", "product"),
}


def gold_checks() -> dict[str, Check]:
    values = {
        "fact_reviews": {"Valid review score": F.col("review_score").between(1, 5)},
        "fact_click_orders": {"Non-negative Total": F.col("total_usd") >= 0},
        "fact_click_reviews": {"Valid rating": F.col("rating").between(1, 5)},
    }
    return {
        table: Check(
            (GOLD_KEYS[table],),
            {
                **{f"Resolved {name} FK": _resolved(f"{name}_sk") for name in RESOLVED_KEYS.get(table, ())},
                **values.get(table, {}),
            },
        )
        for table in GOLD_TABLES
    }


CHECKS = {"bronze": bronze_checks, "silver": silver_checks, "gold": gold_checks}
