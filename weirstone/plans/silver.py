"""Bronze -> silver: one builder per entity.

Every builder takes change-event DataFrames (``op``, ``ts_ms``, ``after`` and,
where the feed has it, ``before``) and returns typed, cleaned rows stamped
with ``processed_at``. Identifiers of the click tables are bigint so that ids
past 2^31 stay usable.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.functions import cleaning as clean
from weirstone.functions import parsing as parse
from weirstone.operators.geo import zip_coordinates
from weirstone.operators.latest import images, latest_images


def _columns(convert: Callable[[Column], Column], *names: str) -> list[Column]:
    """The same conversion over several columns, names kept."""
    return [convert(F.col(name)).alias(name) for name in names]


def _renamed(convert: Callable[[Column], Column], **names: str) -> list[Column]:
    """new_name="source_name" pairs under one conversion."""
    return [convert(F.col(source)).alias(new) for new, source in names.items()]


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp())


def _present(*names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).isNotNull()
    return condition


# -- shop ---------------------------------------------------------------------


def _located(places: DataFrame, geolocation: DataFrame, kind: str) -> DataFrame:
    """Add region, latitude and longitude to customers or sellers."""
    points = zip_coordinates(geolocation)
    zip_column = F.col(f"{kind}_zip_code_prefix")
    located = places.join(points, zip_column == points["zip"], "left")
    return located.select(
        *places.columns,
        clean.region_of(F.col(f"{kind}_state")).alias(f"{kind}_region"),
        F.col("latitude").alias(f"{kind}_latitude"),
        F.col("longitude").alias(f"{kind}_longitude"),
    )


def olist_customers(changes: DataFrame, geolocation: DataFrame) -> DataFrame:
    customers = (
        latest_images(changes, ["customer_id"])
        .select(
            *_columns(clean.text, "customer_id", "customer_unique_id", "customer_zip_code_prefix"),
            *_columns(clean.code, "customer_city", "customer_state"),
        )
        .where(F.col("customer_id") != "")
    )
    return _stamped(_located(customers, geolocation, "customer"))


def olist_sellers(changes: DataFrame, geolocation: DataFrame) -> DataFrame:
    sellers = (
        latest_images(changes, ["seller_id"])
        .select(
            *_columns(clean.text, "seller_id", "seller_zip_code_prefix"),
            *_columns(clean.code, "seller_city", "seller_state"),
        )
        .where(_present("seller_id"))
    )
    return _stamped(_located(sellers, geolocation, "seller"))


def olist_products(changes: DataFrame, translations: DataFrame) -> DataFrame:
    products = (
        latest_images(changes, ["product_id"])
        .select(
            *_columns(clean.text, "product_id", "product_category_name"),
            *_columns(
                parse.whole32,
                "product_name_length",
                "product_description_length",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            ),
        )
        .where(_present("product_id"))
    )
    english = (
        images(translations)
        .select(
            *_renamed(clean.text, category="product_category_name", english="product_category_name_english"),
        )
        .where(_present("category"))
    )
    # no broadcast hint: the stored translation table is small enough to be
    # broadcast by its known file size, and need not stay so
    named = products.join(english, F.col("product_category_name") == F.col("category"), "left")
    measured = named.select(
        "product_id",
        "product_category_name",
        F.coalesce("english", "product_category_name").alias("product_category_name_english"),
        *products.columns[2:],
        clean.product_of(*[F.col(f"product_{side}_cm") for side in ("length", "height", "width")]).alias(
            "product_volume_cm3"
        ),
    )
    return _stamped(measured)


def olist_orders(changes: DataFrame) -> DataFrame:
    orders = (
        latest_images(changes, ["order_id"])
        .select(
            *_columns(clean.text, "order_id", "customer_id"),
            *_columns(clean.code, "order_status"),
            *_columns(
                parse.epoch_or_timestamp,
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
        )
        .where(_present("order_id"))
    )
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    due = F.col("order_estimated_delivery_date")
    # datediff and the comparison are NULL where a date is missing, which is
    # exactly the undecided third state wanted here
    delay = F.datediff(delivered, due)
    return _stamped(
        orders.withColumns(
            {
                "order_year": F.year(purchased),
                "order_month": F.month(purchased),
                "order_day": F.dayofmonth(purchased),
                "order_hour": F.hour(purchased),
                "approval_delay_days": F.datediff("order_approved_at", purchased),
                "actual_delivery_days": F.datediff(delivered, purchased),
                "estimated_delivery_days": F.datediff(due, purchased),
                "delivery_delay_days": delay,
                "is_delivered_late": delay > 0,
                "is_delivered": F.col("order_status") == "DELIVERED",
            }
        )
    )


def olist_order_items(changes: DataFrame) -> DataFrame:
    items = (
        images(changes)
        .select(
            *_columns(clean.text, "order_id"),
            *_columns(parse.whole32, "order_item_id"),
            *_columns(clean.text, "product_id", "seller_id"),
            *_columns(parse.epoch_or_timestamp, "shipping_limit_date"),
            *_columns(parse.real, "price", "freight_value"),
        )
        .where(_present("order_id", "order_item_id"))
    )
    price, freight = F.col("price"), F.col("freight_value")
    return _stamped(
        items.withColumns({"total_item_value": clean.item_total(price, freight), "freight_ratio": clean.ratio(freight, price, 4)})
    )


def olist_order_payments(changes: DataFrame) -> DataFrame:
    payments = (
        images(changes)
        .select(
            *_columns(clean.text, "order_id"),
            *_columns(parse.whole32, "payment_sequential"),
            *_columns(clean.code, "payment_type"),
            *_columns(parse.whole32, "payment_installments"),
            *_columns(parse.real, "payment_value"),
        )
        .where(F.col("order_id") != "")
    )
    count = F.col("payment_installments")
    return _stamped(
        payments.withColumns(
            {
                "installment_value": clean.installment(F.col("payment_value"), count),
                "is_installment_payment": F.coalesce(count > 1, F.lit(False)),
            }
        )
    )


def olist_order_reviews(changes: DataFrame) -> DataFrame:
    reviews = (
        latest_images(changes, ["review_id", "order_id"])
        .select(
            *_columns(clean.text, "review_id", "order_id"),
            *_columns(parse.whole32, "review_score"),
            *_columns(clean.text, "review_comment_title", "review_comment_message"),
            *_columns(parse.epoch_or_timestamp, "review_creation_date", "review_answer_timestamp"),
        )
        .where(_present("review_id", "order_id"))
    )
    return _stamped(
        reviews.withColumns(
            {
                "review_rating": clean.score_label(F.col("review_score"), when_missing="UNKNOWN"),
                "has_comment": clean.has_text(F.col("review_comment_title"), F.col("review_comment_message")),
                "review_response_time_hours": clean.hours_between(
                    F.col("review_creation_date"), F.col("review_answer_timestamp")
                ),
            }
        )
    )


# -- clickstream --------------------------------------------------------------


def click_customers(changes: DataFrame) -> DataFrame:
    return _stamped(
        latest_images(changes, ["customer_id"])
        .select(
            *_columns(parse.whole, "customer_id"),
            *_renamed(clean.text, customer_name="name", email="email"),
            *_columns(clean.code, "country"),
            *_columns(parse.whole32, "age"),
            *_columns(parse.any_date, "signup_date"),
            *_columns(parse.flag, "marketing_opt_in"),
        )
        .where(_present("customer_id"))
    )


def click_products(changes: DataFrame) -> DataFrame:
    return _stamped(
        latest_images(changes, ["product_id"])
        .select(
            *_columns(parse.whole, "product_id"),
            *_renamed(clean.code, product_category="category"),
            *_renamed(clean.text, product_name="name"),
            *_columns(parse.real, "price_usd", "cost_usd", "margin_usd"),
        )
        .where(_present("product_id") & (F.col("price_usd") >= 0))
    )


def click_sessions(changes: DataFrame) -> DataFrame:
    return _stamped(
        latest_images(changes, ["session_id"])
        .select(
            *_columns(parse.whole, "session_id", "customer_id"),
            *_columns(parse.any_timestamp, "start_time"),
            *_columns(clean.code, "device", "source", "country"),
        )
        .where(_present("session_id"))
    )


def click_orders(changes: DataFrame) -> DataFrame:
    return _stamped(
        latest_images(changes, ["order_id"])
        .select(
            *_columns(parse.whole, "order_id", "customer_id"),
            *_columns(parse.any_timestamp, "order_time"),
            *_columns(clean.code, "payment_method"),
            *_columns(parse.real, "discount_pct", "subtotal_usd", "total_usd"),
            *_columns(clean.code, "country", "device", "source"),
        )
        .where(_present("order_id"))
    )


def click_order_items(changes: DataFrame) -> DataFrame:
    return _stamped(
        latest_images(changes, ["order_id", "product_id"])
        .select(
            *_columns(parse.whole, "order_id", "product_id"),
            *_columns(parse.real, "unit_price_usd"),
            *_columns(parse.whole32, "quantity"),
            *_columns(parse.real, "line_total_usd"),
        )
        .where(_present("order_id", "product_id") & (F.col("quantity") > 0))
    )


NO_PRODUCT = -1
NO_PAYMENT = "NOT_APPLICABLE"


def click_events(changes: DataFrame) -> DataFrame:
    return _stamped(
        latest_images(changes, ["event_id"])
        .select(
            *_columns(parse.whole, "event_id", "session_id"),
            *_renamed(parse.any_timestamp, event_timestamp="timestamp"),
            *_columns(clean.code, "event_type"),
            F.coalesce(parse.whole(F.col("product_id")), F.lit(NO_PRODUCT)).alias("product_id"),
            F.coalesce(parse.whole32(F.col("qty")), F.lit(0)).alias("quantity"),
            F.coalesce(clean.code(F.col("payment")), F.lit(NO_PAYMENT)).alias("payment_method"),
        )
        .where(_present("event_id"))
    )


def click_reviews(changes: DataFrame) -> DataFrame:
    return _stamped(
        latest_images(changes, ["review_id"])
        .select(
            *_columns(parse.whole, "review_id", "order_id", "product_id"),
            *_columns(parse.whole32, "rating"),
            *_columns(clean.text, "review_text"),
            *_columns(parse.any_timestamp, "review_time"),
        )
        .where(_present("review_id"))
        .withColumn("sentiment", clean.score_label(F.col("rating"), when_missing="NEGATIVE"))
    )


@dataclass(frozen=True)
class Build:
    """A table builder and the (layer, table) inputs it is called with, in order."""

    function: Callable[..., DataFrame]
    inputs: tuple[tuple[str, str], ...]


def _from_bronze(function: Callable[..., DataFrame], *tables: str) -> Build:
    return Build(function, tuple(("bronze", table) for table in tables))


SILVER: dict[str, Build] = {
    "olist_customers": _from_bronze(olist_customers, "olist_customers", "olist_geolocation"),
    "olist_sellers": _from_bronze(olist_sellers, "olist_sellers", "olist_geolocation"),
    "olist_products": _from_bronze(olist_products, "olist_products", "product_category_translation"),
    "olist_orders": _from_bronze(olist_orders, "olist_orders"),
    "olist_order_items": _from_bronze(olist_order_items, "olist_order_items"),
    "olist_order_payments": _from_bronze(olist_order_payments, "olist_order_payments"),
    "olist_order_reviews": _from_bronze(olist_order_reviews, "olist_order_reviews"),
    "click_customers": _from_bronze(click_customers, "click_customers"),
    "click_products": _from_bronze(click_products, "click_products"),
    "click_sessions": _from_bronze(click_sessions, "click_sessions"),
    "click_orders": _from_bronze(click_orders, "click_orders"),
    "click_order_items": _from_bronze(click_order_items, "click_order_items"),
    "click_events": _from_bronze(click_events, "click_events"),
    "click_reviews": _from_bronze(click_reviews, "click_reviews"),
}
