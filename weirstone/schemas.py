"""The sixteen source tables: columns, types, keys, references, topics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceTable:
    """``key`` tells changes of one row apart; ``declared`` is the primary key the source declares, where it is another."""

    topic: str
    ddl: str
    key: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    declared: tuple[str, ...] | None = None

    @property
    def primary_key(self) -> tuple[str, ...]:
        return self.key if self.declared is None else self.declared

    @property
    def typed(self) -> T.StructType:
        """Column types as declared at the source (used by the CSV loader)."""
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [column.split()[0] for column in self.ddl.split(", ")]

    @property
    def image(self) -> T.StructType:
        """The row image inside a change event: every column arrives as text."""
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns])


# Table names, topics, columns, source types and keys of the shop
# database and of the clickstream database.
SOURCE_TABLES: dict[str, SourceTable] = {
    "olist_orders": SourceTable(
        "olist.public.olist_orders",
        "order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp TIMESTAMP, "
        "order_approved_at TIMESTAMP, order_delivered_carrier_date TIMESTAMP, "
        "order_delivered_customer_date TIMESTAMP, order_estimated_delivery_date TIMESTAMP",
        ("order_id",),
        {"customer_id": ("olist_customers", "customer_id")},
    ),
    "olist_customers": SourceTable(
        "olist.public.olist_customers",
        "customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix STRING, "
        "customer_city STRING, customer_state STRING",
        ("customer_id",),
    ),
    "olist_geolocation": SourceTable(
        "olist.public.olist_geolocation",
        "geolocation_zip_code_prefix STRING, geolocation_lat DECIMAL(9,6), geolocation_lng DECIMAL(9,6), "
        "geolocation_city STRING, geolocation_state STRING",
    ),
    "olist_order_items": SourceTable(
        "olist.public.olist_order_items",
        "order_id STRING, order_item_id INT, product_id STRING, seller_id STRING, "
        "shipping_limit_date TIMESTAMP, price DECIMAL(10,2), freight_value DECIMAL(10,2)",
        ("order_id", "order_item_id"),
        {
            "order_id": ("olist_orders", "order_id"),
            "product_id": ("olist_products", "product_id"),
            "seller_id": ("olist_sellers", "seller_id"),
        },
    ),
    "olist_order_payments": SourceTable(
        "olist.public.olist_order_payments",
        "order_id STRING, payment_sequential INT, payment_type STRING, payment_installments INT, "
        "payment_value DECIMAL(10,2)",
        ("order_id", "payment_sequential"),
        {"order_id": ("olist_orders", "order_id")},
    ),
    "olist_order_reviews": SourceTable(
        "olist.public.olist_order_reviews",
        "review_id STRING, order_id STRING, review_score INT, review_comment_title STRING, "
        "review_comment_message STRING, review_creation_date TIMESTAMP, review_answer_timestamp TIMESTAMP",
        ("review_id", "order_id"),
        {"order_id": ("olist_orders", "order_id")},
        ("review_id",),
    ),
    "olist_products": SourceTable(
        "olist.public.olist_products",
        "product_id STRING, product_category_name STRING, product_name_length INT, "
        "product_description_length INT, product_photos_qty INT, product_weight_g INT, "
        "product_length_cm INT, product_height_cm INT, product_width_cm INT",
        ("product_id",),
    ),
    "olist_sellers": SourceTable(
        "olist.public.olist_sellers",
        "seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING, seller_state STRING",
        ("seller_id",),
    ),
    "product_category_translation": SourceTable(
        "olist.public.product_category_translation",
        "product_category_name STRING, product_category_name_english STRING",
        ("product_category_name",),
        declared=(),
    ),
    "click_customers": SourceTable(
        "clickstream.public.click_customers",
        "customer_id INT, name STRING, email STRING, country STRING, age INT, signup_date DATE, "
        "marketing_opt_in BOOLEAN",
        ("customer_id",),
    ),
    "click_products": SourceTable(
        "clickstream.public.click_products",
        "product_id INT, category STRING, name STRING, price_usd DECIMAL(10,2), cost_usd DECIMAL(10,2), "
        "margin_usd DECIMAL(10,2)",
        ("product_id",),
    ),
    "click_sessions": SourceTable(
        "clickstream.public.click_sessions",
        "session_id INT, customer_id INT, start_time TIMESTAMP, device STRING, source STRING, country STRING",
        ("session_id",),
        {"customer_id": ("click_customers", "customer_id")},
    ),
    "click_orders": SourceTable(
        "clickstream.public.click_orders",
        "order_id INT, customer_id INT, order_time TIMESTAMP, payment_method STRING, "
        "discount_pct DECIMAL(5,2), subtotal_usd DECIMAL(10,2), total_usd DECIMAL(10,2), country STRING, "
        "device STRING, source STRING",
        ("order_id",),
        {"customer_id": ("click_customers", "customer_id")},
    ),
    "click_order_items": SourceTable(
        "clickstream.public.click_order_items",
        "order_id INT, product_id INT, unit_price_usd DECIMAL(10,2), quantity INT, line_total_usd DECIMAL(10,2)",
        ("order_id", "product_id"),
        {"order_id": ("click_orders", "order_id"), "product_id": ("click_products", "product_id")},
        (),
    ),
    "click_events": SourceTable(
        "clickstream.public.click_events",
        "event_id INT, session_id INT, timestamp TIMESTAMP, event_type STRING, product_id DECIMAL(38,10), "
        "qty DECIMAL(38,10), cart_size DECIMAL(38,10), payment STRING, discount_pct DECIMAL(5,2), "
        "amount_usd DECIMAL(10,2)",
        ("event_id",),
        {"session_id": ("click_sessions", "session_id")},
    ),
    "click_reviews": SourceTable(
        "clickstream.public.click_reviews",
        "review_id INT, order_id INT, product_id INT, rating INT, review_text STRING, review_time TIMESTAMP",
        ("review_id",),
        {"order_id": ("click_orders", "order_id"), "product_id": ("click_products", "product_id")},
    ),
}

TABLE_OF_TOPIC = {source.topic: name for name, source in SOURCE_TABLES.items()}
