"""Silver -> gold: eight dimensions and six facts of two star schemas.

Builders take and return DataFrames; the order of the parameters matches the
inputs listed in :data:`GOLD`. Rows are stamped with ``etl_loaded_at``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.functions import cleaning as clean
from weirstone.functions import money
from weirstone.operators.calendar import calendar, date_spine
from weirstone.operators.keys import UNKNOWN, UNKNOWN_KEY, surrogate_key, with_unknown
from weirstone.operators.latest import first_per
from weirstone.operators.lookups import resolve
from weirstone.operators.sets import distinct_values
from weirstone.plans.silver import Build

NO_ZIP = "00000"


def _loaded(df: DataFrame) -> DataFrame:
    return df.withColumn("etl_loaded_at", F.current_timestamp())


def _dimension(rows: DataFrame, key: str, business_key: str, unknown: dict) -> DataFrame:
    """Key the rows and add the UNKNOWN member."""
    return _loaded(with_unknown(surrogate_key(rows, key, [business_key]), key, unknown))


# -- dimensions ---------------------------------------------------------------


def dim_date(orders: DataFrame) -> DataFrame:
    """Calendar over the years in which orders were placed; it has no UNKNOWN member."""
    return _loaded(calendar(date_spine(orders, "order_purchase_timestamp")))


def _place_unknown(kind: str) -> dict:
    return {
        f"{kind}_zip_code_prefix": NO_ZIP,
        f"{kind}_city": UNKNOWN,
        f"{kind}_state": UNKNOWN,
        f"{kind}_region": clean.OTHER_REGION,
    }


def _place_columns(kind: str) -> list[str]:
    return [f"{kind}_{part}" for part in ("zip_code_prefix", "city", "state", "region", "latitude", "longitude")]


def dim_customer(customers: DataFrame) -> DataFrame:
    """One row per person: of several customer ids sharing a unique id the first stands for all."""
    people = first_per(customers, ["customer_unique_id"], [F.col("customer_id")])
    rows = people.select("customer_unique_id", *_place_columns("customer"))
    return _dimension(
        rows, "customer_sk", "customer_unique_id", {"customer_unique_id": UNKNOWN, **_place_unknown("customer")}
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    rows = sellers.select("seller_id", *_place_columns("seller"))
    return _dimension(rows, "seller_sk", "seller_id", {"seller_id": UNKNOWN, **_place_unknown("seller")})


def dim_product(products: DataFrame) -> DataFrame:
    rows = products.drop("processed_at").withColumns(
        {
            "size_category": clean.banded(F.col("product_volume_cm3"), clean.SIZE_CLASSES),
            "weight_category": clean.banded(F.col("product_weight_g"), clean.WEIGHT_CLASSES),
        }
    )
    unknown = dict.fromkeys(
        (
            "product_id",
            "product_category_name",
            "product_category_name_english",
            "size_category",
            "weight_category",
        ),
        UNKNOWN,
    )
    return _dimension(rows, "product_sk", "product_id", unknown)


def dim_device(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    return _dimension(distinct_values("device", sessions, orders), "device_sk", "device", {"device": UNKNOWN})


def dim_traffic_source(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    sources = distinct_values("source", sessions, orders).withColumnRenamed("source", "traffic_source")
    return _dimension(sources, "source_sk", "traffic_source", {"traffic_source": UNKNOWN})


def dim_click_customer(customers: DataFrame) -> DataFrame:
    rows = customers.select(
        "customer_id", "customer_name", "email", "country", "age", "signup_date", "marketing_opt_in"
    )
    unknown = {
        "customer_id": UNKNOWN_KEY,
        "customer_name": UNKNOWN,
        "email": UNKNOWN,
        "country": UNKNOWN,
        "marketing_opt_in": False,
    }
    return _dimension(rows, "customer_sk", "customer_id", unknown)


def dim_click_product(products: DataFrame) -> DataFrame:
    rows = products.select("product_id", "product_category", "product_name", "price_usd", "cost_usd", "margin_usd")
    unknown = {"product_id": UNKNOWN_KEY, "product_category": UNKNOWN, "product_name": UNKNOWN}
    return _dimension(rows, "product_sk", "product_id", unknown)


# -- facts of the shop --------------------------------------------------------


def _payments_per_order(payments: DataFrame) -> DataFrame:
    """Totals per order; the primary payment type is that of the lowest sequential."""
    return payments.groupBy("order_id").agg(
        money.total(F.col("payment_value")).alias("total_payment_value"),
        F.sum("payment_installments").alias("payment_installments"),
        F.min(F.struct("payment_sequential", "payment_type")).getField("payment_type").alias("primary_payment_type"),
    )


def _orders_with_customer(orders: DataFrame, customers: DataFrame, dim: DataFrame) -> DataFrame:
    """customer_id -> customer_unique_id -> customer_sk, settled per order, before any item joins."""
    bridge = resolve(
        customers.select("customer_id", "customer_unique_id"),
        dim,
        "customer_unique_id",
        "customer_unique_id",
        {"customer_sk": "customer_sk"},
    )
    return resolve(orders, bridge, "customer_id", "customer_id", {"customer_sk": "customer_sk"})


def _order_lines(
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    dim_customer: DataFrame,
    dim_seller: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    """An order's items with what their orders and dimensions add, each value once.

    Everything that depends on the order alone (customer, payments) is joined
    to the orders first. The items, the largest input, look up their own
    dimensions while they are narrow, where a dimension too large to
    broadcast shuffles them once more each, and then meet the orders on the
    order_id and its length: the second key makes both sides shuffle directly
    under the join, which is what adaptive execution needs to split an order
    that holds a large share of the items.
    """
    per_order = _orders_with_customer(orders, customers, dim_customer).join(
        _payments_per_order(payments), "order_id", "left"
    )
    # any function of the order id does; one of few values takes next to nothing in a shuffle
    second = F.length("order_id")
    lines = items.select("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value")
    lines = resolve(lines, dim_seller, "seller_id", "seller_id", {"seller_sk": "seller_sk"})
    lines = resolve(lines, dim_product, "product_id", "product_id", {"product_sk": "product_sk"})
    lines = lines.withColumn("_order", second).join(per_order.withColumn("_order", second), ["order_id", "_order"])
    return lines.withColumnRenamed("price", "unit_price")


def _shown_order_items(lines: DataFrame, *keys: str) -> DataFrame:
    """The fact's columns, of which some follow from others: those are made here, after the last shuffle."""
    return lines.select(
        *keys,
        "order_id",
        "order_item_id",
        clean.date_key(F.col("order_purchase_timestamp")).alias("date_sk"),
        "customer_sk",
        "product_sk",
        "seller_sk",
        "order_status",
        clean.status_class(F.col("order_status")).alias("status_category"),
        "is_delivered",
        "is_delivered_late",
        "unit_price",
        "freight_value",
        clean.item_total(F.col("unit_price"), F.col("freight_value")).alias("total_item_value"),
        "actual_delivery_days",
        "delivery_delay_days",
        F.coalesce("total_payment_value", F.lit(0.0)).alias("total_payment_value"),
        F.coalesce("payment_installments", F.lit(0)).try_cast("int").alias("payment_installments"),
        F.coalesce("primary_payment_type", F.lit(UNKNOWN)).alias("primary_payment_type"),
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_customer_date",
        "shipping_limit_date",
    )


def order_item_rows(*inputs: DataFrame) -> DataFrame:
    """The rows of the order fact, without a key of their own; the inputs are those of :func:`fact_orders`."""
    return _shown_order_items(_order_lines(*inputs))


def numbered_order_items(rows: DataFrame) -> DataFrame:
    # items are not reduced per key, so an updated item is there twice
    ties = ["product_sk", "seller_sk", "unit_price", "freight_value", "shipping_limit_date"]
    return surrogate_key(rows, "order_item_sk", ["order_id", "order_item_id"], ties)


def fact_orders(
    items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    dim_customer: DataFrame,
    dim_seller: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    """One row per order item; the payment total of the order is repeated on each of its items."""
    lines = _order_lines(items, orders, payments, customers, dim_customer, dim_seller, dim_product)
    return _loaded(_shown_order_items(numbered_order_items(lines), "order_item_sk"))


def fact_reviews(reviews: DataFrame, orders: DataFrame, customers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """One row per review of a known order."""
    owners = _orders_with_customer(orders.select("order_id", "customer_id"), customers, dim_customer)
    score = F.col("review_score")
    rows = surrogate_key(reviews.join(owners, "order_id"), "review_sk", ["review_id", "order_id"])
    # what follows from other columns is made after the last shuffle
    shown = rows.select(
        "review_sk",
        "review_id",
        "order_id",
        clean.date_key(F.col("review_creation_date")).alias("date_sk"),
        "customer_sk",
        "review_score",
        "review_rating",
        "review_comment_title",
        "review_comment_message",
        F.col("has_comment").alias("review_has_comment"),
        "review_response_time_hours",
        clean.indicator(score >= 4).alias("is_positive"),
        clean.indicator(score == 3).alias("is_neutral"),
        clean.indicator(score <= 2).alias("is_negative"),
        "review_creation_date",
        "review_answer_timestamp",
    )
    return _loaded(shown)


# -- facts of the clickstream -------------------------------------------------


def _with_visit_keys(
    rows: DataFrame, dim_click_customer: DataFrame, dim_device: DataFrame, dim_traffic_source: DataFrame
) -> DataFrame:
    """Customer, device and traffic source keys shared by orders and sessions."""
    rows = resolve(rows, dim_device, "device", "device", {"device_sk": "device_sk"})
    rows = resolve(rows, dim_traffic_source, "source", "traffic_source", {"source_sk": "source_sk"})
    return resolve(rows, dim_click_customer, "customer_id", "customer_id", {"customer_sk": "customer_sk"})


def fact_click_orders(
    orders: DataFrame, dim_click_customer: DataFrame, dim_device: DataFrame, dim_traffic_source: DataFrame
) -> DataFrame:
    keyed = surrogate_key(
        _with_visit_keys(orders, dim_click_customer, dim_device, dim_traffic_source), "order_sk", ["order_id"]
    )
    return _loaded(
        keyed.select(
            "order_sk",
            "order_id",
            "customer_sk",
            clean.date_key(F.col("order_time")).alias("date_sk"),
            "device_sk",
            "source_sk",
            "payment_method",
            "discount_pct",
            "subtotal_usd",
            "total_usd",
            "country",
            F.col("order_time").alias("order_timestamp"),
        )
    )


def fact_sessions(
    sessions: DataFrame, dim_click_customer: DataFrame, dim_device: DataFrame, dim_traffic_source: DataFrame
) -> DataFrame:
    keyed = surrogate_key(
        _with_visit_keys(sessions, dim_click_customer, dim_device, dim_traffic_source), "session_sk", ["session_id"]
    )
    return _loaded(
        keyed.select(
            "session_sk",
            "session_id",
            "customer_sk",
            clean.date_key(F.col("start_time")).alias("date_sk"),
            "device_sk",
            "source_sk",
            "country",
            F.col("start_time").alias("session_start_timestamp"),
        )
    )


def fact_clickstream_events(events: DataFrame, fact_sessions: DataFrame, dim_click_product: DataFrame) -> DataFrame:
    """One row per event; session and customer keys come from its session.

    Most events carry no product (-1): those rows are scattered over the join
    instead of meeting in one task.
    """
    rows = resolve(
        events,
        fact_sessions,
        "session_id",
        "session_id",
        {"session_sk": "session_sk", "customer_sk": "customer_sk"},
        scatter_by="event_id",
    )
    rows = resolve(
        rows, dim_click_product, "product_id", "product_id", {"product_sk": "product_sk"}, scatter_by="event_id"
    )
    return _loaded(
        surrogate_key(rows, "event_sk", ["event_id"]).select(
            "event_sk",
            "event_id",
            "session_sk",
            "customer_sk",
            clean.date_key(F.col("event_timestamp")).alias("date_sk"),
            "product_sk",
            "event_type",
            "quantity",
            "payment_method",
            "event_timestamp",
        )
    )


def fact_click_reviews(reviews: DataFrame, fact_click_orders: DataFrame, dim_click_product: DataFrame) -> DataFrame:
    rows = resolve(reviews, fact_click_orders, "order_id", "order_id", {"order_sk": "order_sk"})
    rows = resolve(rows, dim_click_product, "product_id", "product_id", {"product_sk": "product_sk"})
    return _loaded(
        surrogate_key(rows, "review_sk", ["review_id"]).select(
            "review_sk",
            "review_id",
            "order_sk",
            "product_sk",
            clean.date_key(F.col("review_time")).alias("date_sk"),
            "rating",
            "review_text",
            "sentiment",
            F.col("review_time").alias("review_timestamp"),
        )
    )


def _s(*tables: str) -> tuple[tuple[str, str], ...]:
    return tuple(("silver", table) for table in tables)


def _g(*tables: str) -> tuple[tuple[str, str], ...]:
    return tuple(("gold", table) for table in tables)


_VISIT_DIMENSIONS = _g("dim_click_customer", "dim_device", "dim_traffic_source")

GOLD: dict[str, Build] = {
    "dim_date": Build(dim_date, _s("olist_orders")),
    "dim_customer": Build(dim_customer, _s("olist_customers")),
    "dim_seller": Build(dim_seller, _s("olist_sellers")),
    "dim_product": Build(dim_product, _s("olist_products")),
    "dim_device": Build(dim_device, _s("click_sessions", "click_orders")),
    "dim_traffic_source": Build(dim_traffic_source, _s("click_sessions", "click_orders")),
    "dim_click_customer": Build(dim_click_customer, _s("click_customers")),
    "dim_click_product": Build(dim_click_product, _s("click_products")),
    "fact_orders": Build(
        fact_orders,
        _s("olist_order_items", "olist_orders", "olist_order_payments", "olist_customers")
        + _g("dim_customer", "dim_seller", "dim_product"),
    ),
    "fact_reviews": Build(
        fact_reviews, _s("olist_order_reviews", "olist_orders", "olist_customers") + _g("dim_customer")
    ),
    "fact_click_orders": Build(fact_click_orders, _s("click_orders") + _VISIT_DIMENSIONS),
    "fact_sessions": Build(fact_sessions, _s("click_sessions") + _VISIT_DIMENSIONS),
    "fact_clickstream_events": Build(
        fact_clickstream_events, _s("click_events") + _g("fact_sessions", "dim_click_product")
    ),
    "fact_click_reviews": Build(
        fact_click_reviews, _s("click_reviews") + _g("fact_click_orders", "dim_click_product")
    ),
}
