"""Check SQL of the reports, over the parts of :mod:`weirstone.bindings.oracle`."""

from weirstone.bindings.oracle import half_up, money_mean, money_sum


def _top(query: str, measure: str, *ties: str, k: int | None = None) -> str:
    order = ", ".join([f"{measure} desc nulls last", *(f"{t} asc nulls last" for t in ties)])
    return f"select * from ({query}) r order by {order}" + (f" limit {k}" if k else "")


_REVIEWED_ITEMS = """fact_reviews r join fact_orders f on r.order_id = f.order_id
    join dim_product p on f.product_sk = p.product_sk"""

_AVG_SCORE = half_up("sum(r.review_score)", "count(r.review_score)", 2)
_POSITIVE_RATE = half_up("sum(r.is_positive) * 100", "count(*)", 2)

_SESSIONS = f"""
    select d.device, t.traffic_source, count(distinct s.session_sk) as total_sessions,
        count(e.event_sk) as total_events,
        {half_up("count(e.event_sk)", "count(distinct s.session_sk)", 2)} as avg_actions_per_session
    from fact_sessions s join dim_device d on s.device_sk = d.device_sk
    join dim_traffic_source t on s.source_sk = t.source_sk
    left join fact_clickstream_events e on s.session_sk = e.session_sk
    group by d.device, t.traffic_source"""

REVENUE_BY_REGION = f"""
    select c.customer_region as region, c.customer_state as state, count(distinct f.order_id) as total_orders,
        {money_sum('f.total_item_value')} as total_revenue,
        cast(sum(cast(round(f.total_item_value * 100) as bigint)) as double)
            / (count(f.total_item_value) * 100.0) as avg_order_value,
        {money_sum('f.freight_value')} as total_shipping_cost
    from fact_orders f join dim_customer c on f.customer_sk = c.customer_sk
    join dim_date d on f.date_sk = d.date_sk
    group by c.customer_region, c.customer_state"""

TOP_CATEGORIES = f"""
    select p.product_category_name_english as category, count(*) as items_sold,
        count(distinct f.order_id) as order_count, {money_sum('f.unit_price')} as total_sales,
        {money_mean('f.unit_price')} as avg_price
    from fact_orders f join dim_product p on f.product_sk = p.product_sk
    join dim_date d on f.date_sk = d.date_sk group by p.product_category_name_english"""

DEVICE_PERFORMANCE = f"""
    select d.device, count(distinct o.order_id) as total_orders, {money_sum('o.total_usd')} as total_revenue_usd,
        {money_mean('o.total_usd')} as avg_order_value_usd
    from fact_click_orders o join dim_device d on o.device_sk = d.device_sk group by d.device"""

SQL = {
    "q01_customer_count": "select count(*) as customers from dim_customer",
    "q02_product_count": "select count(distinct product_id) as products from dim_product",
    "q03_revenue_by_region": _top(REVENUE_BY_REGION, "total_revenue", "region", "state", k=5),
    "q04_top_categories": _top(TOP_CATEGORIES, "total_sales", "category", k=5),
    "q05_review_analysis": _top(
        f"""select p.product_category_name_english as category, count(*) as total_reviews,
                {_AVG_SCORE} as avg_score, cast(sum(r.is_positive) as bigint) as positive_reviews,
                cast(sum(r.is_negative) as bigint) as negative_reviews,
                cast(sum(r.is_neutral) as bigint) as neutral_reviews, {_POSITIVE_RATE} as positive_rate_pct
            from {_REVIEWED_ITEMS} join dim_date d on r.date_sk = d.date_sk
            group by p.product_category_name_english""",
        "total_reviews",
        "category",
        k=5,
    ),
    "q06_funnel_analysis": _top(
        f"""select event_type, count(distinct session_sk) as unique_sessions, count(event_sk) as total_events,
                {half_up('count(distinct session_sk) * 100',
                         "(select count(distinct session_sk) from fact_clickstream_events where event_type = 'PAGE_VIEW')",
                         2)} as conversion_rate_pct
            from fact_clickstream_events group by event_type""",
        "total_events",
        "event_type",
    ),
    "q07_session_analytics": _top(_SESSIONS, "total_sessions", "device", "traffic_source", k=10),
    "q08_device_performance": _top(DEVICE_PERFORMANCE, "total_revenue_usd", "device"),
    "q09_click_revenue_by_country": _top(
        f"""select c.country, count(distinct o.order_id) as total_orders,
                {money_sum('o.total_usd')} as total_revenue_usd, {money_mean('o.total_usd')} as avg_order_value_usd,
                {money_mean('o.discount_pct')} as avg_discount_pct
            from fact_click_orders o join dim_click_customer c on o.customer_sk = c.customer_sk
            group by c.country""",
        "total_revenue_usd",
        "country",
        k=5,
    ),
    "q10_dashboard_customers": "select count(*) as customers from dim_customer",
    "q11_dashboard_products": "select count(distinct product_id) as products from dim_product",
    "q12_dashboard_orders": "select count(distinct order_id) as orders from fact_orders",
    "q13_dashboard_revenue": f"select {money_sum('total_item_value')} as revenue from fact_orders",
    "q14_dashboard_review_score": f"select {half_up('sum(review_score)', 'count(review_score)', 2)} as avg_score from fact_reviews",
    "q15_monthly_revenue": f"""
        select d.year_month as month, {money_sum('f.total_item_value')} as revenue
        from fact_orders f join dim_date d on f.date_sk = d.date_sk group by d.year_month order by 1""",
    "q16_revenue_by_state": _top(
        f"""select c.customer_state as state, {money_sum('f.total_item_value')} as revenue
            from fact_orders f join dim_customer c on f.customer_sk = c.customer_sk group by c.customer_state""",
        "revenue",
        "state",
        k=10,
    ),
    "q17_sales_by_category": _top(
        f"""select p.product_category_name_english as category, {money_sum('f.unit_price')} as total_sales
            from fact_orders f join dim_product p on f.product_sk = p.product_sk
            group by p.product_category_name_english""",
        "total_sales",
        "category",
        k=10,
    ),
    "q18_reviews_by_category": _top(
        f"""select p.product_category_name_english as category, count(*) as total_reviews,
                {_AVG_SCORE} as avg_score, {_POSITIVE_RATE} as positive_rate_pct
            from {_REVIEWED_ITEMS} group by p.product_category_name_english""",
        "total_reviews",
        "category",
        k=10,
    ),
    "q19_dashboard_sessions": "select count(distinct session_sk) as sessions from fact_sessions",
    "q20_dashboard_events": "select count(*) as events from fact_clickstream_events",
    "q21_dashboard_click_orders": "select count(distinct order_id) as orders from fact_click_orders",
    "q22_dashboard_click_revenue": f"select {money_sum('total_usd')} as revenue from fact_click_orders",
    "q23_sessions_by_event_type": _top(
        """select event_type, count(distinct session_sk) as unique_sessions
           from fact_clickstream_events group by event_type""",
        "unique_sessions",
        "event_type",
    ),
    "q24_revenue_by_device": _top(
        f"""select d.device, {money_sum('o.total_usd')} as revenue_usd
            from fact_click_orders o join dim_device d on o.device_sk = d.device_sk group by d.device""",
        "revenue_usd",
        "device",
    ),
    "q25_revenue_by_country": _top(
        f"""select c.country, {money_sum('o.total_usd')} as revenue_usd
            from fact_click_orders o join dim_click_customer c on o.customer_sk = c.customer_sk
            group by c.country""",
        "revenue_usd",
        "country",
        k=10,
    ),
    "q26_sessions_by_device_and_source": _top(_SESSIONS, "total_sessions", "device", "traffic_source", k=10),
    "q27_customers_per_state": _top(
        'select customer_state, count(*) as "count" from s_olist_customers group by customer_state',
        '"count"',
        "customer_state",
        k=10,
    ),
    "q28_customers_per_city": _top(
        """select customer_city, customer_state, count(*) as "count" from s_olist_customers
           group by customer_city, customer_state""",
        '"count"',
        "customer_city",
        "customer_state",
        k=10,
    ),
    "q29_customers_of_sp": """select customer_id, customer_city, customer_zip_code_prefix from s_olist_customers
        where customer_state = 'SP' order by customer_id limit 10""",
    "q30_customers_of_rj": """select customer_id, customer_city, customer_zip_code_prefix from s_olist_customers
        where customer_state = 'RJ' order by customer_id limit 10""",
}
