"""Reports over the gold tables.

Every report is a function of a ``gold`` accessor (table name -> DataFrame).
Sums of money are exact (see ``functions.money``), orderings end in a
tie-breaker so that a top-k always returns the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirstone.functions import money

Gold = Callable[[str], DataFrame]


def _rows() -> Column:
    return F.count(F.lit(1))


def _top(df: DataFrame, measure: str, *ties: str, k: int | None = None) -> DataFrame:
    ordered = df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
    return ordered if k is None else ordered.limit(k)


# -- single figures -----------------------------------------------------------


def customer_count(gold: Gold) -> DataFrame:
    return gold("dim_customer").agg(_rows().alias("customers"))


def product_count(gold: Gold) -> DataFrame:
    return gold("dim_product").agg(F.count_distinct("product_id").alias("products"))


def order_count(gold: Gold) -> DataFrame:
    return gold("fact_orders").agg(F.count_distinct("order_id").alias("orders"))


def total_revenue(gold: Gold) -> DataFrame:
    return gold("fact_orders").agg(money.total(F.col("total_item_value")).alias("revenue"))


def average_review_score(gold: Gold) -> DataFrame:
    score = F.col("review_score")
    return gold("fact_reviews").agg(money.quotient(F.sum(score), F.count(score), 2).alias("avg_score"))


def session_count(gold: Gold) -> DataFrame:
    return gold("fact_sessions").agg(F.count_distinct("session_sk").alias("sessions"))


def event_count(gold: Gold) -> DataFrame:
    return gold("fact_clickstream_events").agg(_rows().alias("events"))


def click_order_count(gold: Gold) -> DataFrame:
    return gold("fact_click_orders").agg(F.count_distinct("order_id").alias("orders"))


def click_revenue(gold: Gold) -> DataFrame:
    return gold("fact_click_orders").agg(money.total(F.col("total_usd")).alias("revenue"))


# -- shop ---------------------------------------------------------------------


def _dated(facts: DataFrame, gold: Gold) -> DataFrame:
    """Facts whose date is in the calendar (an inner join that only filters)."""
    return facts.join(gold("dim_date").select("date_sk"), "date_sk", "left_semi")


def _category() -> Column:
    return F.col("product_category_name_english").alias("category")


def revenue_by_region(gold: Gold, k: int = 5) -> DataFrame:
    sales = _dated(gold("fact_orders"), gold).join(gold("dim_customer"), "customer_sk")
    value = F.col("total_item_value")
    grouped = sales.groupBy(F.col("customer_region").alias("region"), F.col("customer_state").alias("state")).agg(
        F.count_distinct("order_id").alias("total_orders"),
        money.total(value).alias("total_revenue"),
        money.mean(value).alias("avg_order_value"),
        money.total(F.col("freight_value")).alias("total_shipping_cost"),
    )
    return _top(grouped, "total_revenue", "region", "state", k=k)


def top_categories(gold: Gold, k: int = 5) -> DataFrame:
    sales = _dated(gold("fact_orders"), gold).join(gold("dim_product"), "product_sk")
    price = F.col("unit_price")
    grouped = sales.groupBy(_category()).agg(
        _rows().alias("items_sold"),
        F.count_distinct("order_id").alias("order_count"),
        money.total(price).alias("total_sales"),
        money.mean(price, 2).alias("avg_price"),
    )
    return _top(grouped, "total_sales", "category", k=k)


def _category_reviews(reviews: DataFrame, gold: Gold) -> DataFrame:
    """Review figures per category, one review counting once per item of its order.

    The join of reviews and items on the order would emit every pair of the
    order. Both sides are reduced per order first and the pair counts are
    products, so nothing multiplies however many reviews or items one order has.
    """
    score = F.col("review_score")
    per_order = reviews.groupBy("order_id").agg(
        _rows().alias("reviews"),
        F.sum(score).alias("score_sum"),
        F.count(score).alias("scored"),
        *[F.sum(f"is_{kind}").alias(kind) for kind in ("positive", "negative", "neutral")],
    )
    per_product = gold("fact_orders").groupBy("order_id", "product_sk").agg(_rows().alias("items"))
    joined = per_order.join(per_product, "order_id").join(gold("dim_product"), "product_sk")
    figures = ("reviews", "score_sum", "scored", "positive", "negative", "neutral")
    return joined.groupBy(_category()).agg(*[F.sum(F.col(f) * F.col("items")).alias(f) for f in figures])


def review_analysis(gold: Gold, k: int = 5) -> DataFrame:
    grouped = _category_reviews(_dated(gold("fact_reviews"), gold), gold).select(
        "category",
        F.col("reviews").alias("total_reviews"),
        money.quotient(F.col("score_sum"), F.col("scored"), 2).alias("avg_score"),
        F.col("positive").alias("positive_reviews"),
        F.col("negative").alias("negative_reviews"),
        F.col("neutral").alias("neutral_reviews"),
        money.percent(F.col("positive"), F.col("reviews")).alias("positive_rate_pct"),
    )
    return _top(grouped, "total_reviews", "category", k=k)


def reviews_by_category(gold: Gold, k: int = 10) -> DataFrame:
    grouped = _category_reviews(gold("fact_reviews"), gold).select(
        "category",
        F.col("reviews").alias("total_reviews"),
        money.quotient(F.col("score_sum"), F.col("scored"), 2).alias("avg_score"),
        money.percent(F.col("positive"), F.col("reviews")).alias("positive_rate_pct"),
    )
    return _top(grouped, "total_reviews", "category", k=k)


def monthly_revenue(gold: Gold) -> DataFrame:
    sales = gold("fact_orders").join(gold("dim_date"), "date_sk")
    grouped = sales.groupBy(F.col("year_month").alias("month")).agg(
        money.total(F.col("total_item_value")).alias("revenue")
    )
    return grouped.orderBy("month")


def revenue_by_state(gold: Gold, k: int = 10) -> DataFrame:
    sales = gold("fact_orders").join(gold("dim_customer"), "customer_sk")
    grouped = sales.groupBy(F.col("customer_state").alias("state")).agg(
        money.total(F.col("total_item_value")).alias("revenue")
    )
    return _top(grouped, "revenue", "state", k=k)


def sales_by_category(gold: Gold, k: int = 10) -> DataFrame:
    sales = gold("fact_orders").join(gold("dim_product"), "product_sk")
    grouped = sales.groupBy(_category()).agg(money.total(F.col("unit_price")).alias("total_sales"))
    return _top(grouped, "total_sales", "category", k=k)


# -- clickstream --------------------------------------------------------------


def funnel_analysis(gold: Gold, entry_event: str = "PAGE_VIEW") -> DataFrame:
    """Sessions and events per type, and sessions relative to those that viewed a page.

    One scan: the denominator is one of the groups, a row per event type being
    left to look it up in. Where nobody entered the rate is NULL.
    """
    steps = gold("fact_clickstream_events").groupBy("event_type").agg(
        F.count_distinct("session_sk").alias("unique_sessions"), F.count("event_sk").alias("total_events")
    )
    entered = F.max(F.when(F.col("event_type") == entry_event, F.col("unique_sessions"))).over(Window.partitionBy())
    measured = steps.withColumn("conversion_rate_pct", money.percent(F.col("unique_sessions"), entered))
    return _top(measured, "total_events", "event_type")


def sessions_by_event_type(gold: Gold) -> DataFrame:
    steps = gold("fact_clickstream_events").groupBy("event_type")
    return _top(steps.agg(F.count_distinct("session_sk").alias("unique_sessions")), "unique_sessions", "event_type")


def session_analytics(gold: Gold, k: int = 10) -> DataFrame:
    """Sessions and their events by device and traffic source.

    Events are counted per session before they meet the sessions, so a session
    with very many events adds one row to the join.
    """
    events = gold("fact_clickstream_events").groupBy("session_sk").agg(F.count("event_sk").alias("session_events"))
    visits = (
        gold("fact_sessions")
        .join(gold("dim_device"), "device_sk")
        .join(gold("dim_traffic_source"), "source_sk")
        .join(events, "session_sk", "left")
    )
    grouped = visits.groupBy("device", "traffic_source").agg(
        F.count_distinct("session_sk").alias("total_sessions"),
        F.coalesce(F.sum("session_events"), F.lit(0)).alias("total_events"),
    )
    measured = grouped.withColumn(
        "avg_actions_per_session", money.quotient(F.col("total_events"), F.col("total_sessions"), 2)
    )
    return _top(measured, "total_sessions", "device", "traffic_source", k=k)


def device_performance(gold: Gold) -> DataFrame:
    value = F.col("total_usd")
    grouped = (
        gold("fact_click_orders")
        .join(gold("dim_device"), "device_sk")
        .groupBy("device")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            money.total(value).alias("total_revenue_usd"),
            money.mean(value, 2).alias("avg_order_value_usd"),
        )
    )
    return _top(grouped, "total_revenue_usd", "device")


def _orders_with_country(gold: Gold) -> DataFrame:
    """Orders under the country of their customer, not the one on the order."""
    customers = gold("dim_click_customer").select("customer_sk", "country")
    return gold("fact_click_orders").drop("country").join(customers, "customer_sk")


def click_revenue_by_country(gold: Gold, k: int = 5) -> DataFrame:
    value = F.col("total_usd")
    grouped = (
        _orders_with_country(gold)
        .groupBy("country")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            money.total(value).alias("total_revenue_usd"),
            money.mean(value, 2).alias("avg_order_value_usd"),
            money.mean(F.col("discount_pct"), 2).alias("avg_discount_pct"),
        )
    )
    return _top(grouped, "total_revenue_usd", "country", k=k)


def revenue_by_device(gold: Gold) -> DataFrame:
    sales = gold("fact_click_orders").join(gold("dim_device"), "device_sk")
    grouped = sales.groupBy("device").agg(money.total(F.col("total_usd")).alias("revenue_usd"))
    return _top(grouped, "revenue_usd", "device")


def revenue_by_country(gold: Gold, k: int = 10) -> DataFrame:
    grouped = _orders_with_country(gold).groupBy("country").agg(
        money.total(F.col("total_usd")).alias("revenue_usd")
    )
    return _top(grouped, "revenue_usd", "country", k=k)


# -- customer listings over the silver table ----------------------------------


def customers_per_state(customers: DataFrame, k: int = 10) -> DataFrame:
    return _top(customers.groupBy("customer_state").agg(_rows().alias("count")), "count", "customer_state", k=k)


def customers_per_city(customers: DataFrame, k: int = 10) -> DataFrame:
    grouped = customers.groupBy("customer_city", "customer_state").agg(_rows().alias("count"))
    return _top(grouped, "count", "customer_city", "customer_state", k=k)


def customers_of_state(customers: DataFrame, state: str, k: int = 10) -> DataFrame:
    chosen = customers.where(F.col("customer_state") == state)
    return chosen.select("customer_id", "customer_city", "customer_zip_code_prefix").orderBy("customer_id").limit(k)


# Names under which the report templates are requested.
TEMPLATES: dict[str, Callable[[Gold], DataFrame]] = {
    "cus_cnt": customer_count,
    "prd_cnt": product_count,
    "revenue_by_region": revenue_by_region,
    "top_products_by_category": top_categories,
    "review_analysis": review_analysis,
    "funnel_analysis": funnel_analysis,
    "session_analytics": session_analytics,
    "device_performance": device_performance,
    "click_revenue_by_country": click_revenue_by_country,
}

DASHBOARD: dict[str, Callable[[Gold], DataFrame]] = {
    "customers": customer_count,
    "products": product_count,
    "orders": order_count,
    "total_revenue": total_revenue,
    "average_review_score": average_review_score,
    "monthly_revenue": monthly_revenue,
    "revenue_by_state": revenue_by_state,
    "sales_by_category": sales_by_category,
    "reviews_by_category": reviews_by_category,
    "sessions": session_count,
    "events": event_count,
    "click_orders": click_order_count,
    "click_revenue": click_revenue,
    "sessions_by_event_type": sessions_by_event_type,
    "revenue_by_device": revenue_by_device,
    "revenue_by_country": revenue_by_country,
    "sessions_by_device_and_source": session_analytics,
}
