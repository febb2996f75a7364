"""Check SQL of the quality gates: the rules once more, in the checking database's SQL."""

from weirstone.bindings import oracle
from weirstone.schemas import SOURCE_TABLES


def _resolved(*names: str) -> dict[str, str]:
    return {f"Resolved {n} FK": f"coalesce({n}_sk, -1) <> -1" for n in names}


def _between(column: str, low: int, high: int) -> str:
    return f"({column} is null or {column} between {low} and {high})"


_CODES = {
    "status": "('DELIVERED','SHIPPED','CANCELED','UNAVAILABLE','INVOICED','PROCESSING','CREATED','APPROVED')",
    "payment": "('CREDIT_CARD','BOLETO','VOUCHER','DEBIT_CARD')",
}

SILVER = {
    "olist_customers": (
        ["customer_id"],
        {
            "Valid State Code": "regexp_matches(customer_state, '^[A-Z]{2}$')",
            "Valid Zip Code": "regexp_matches(customer_zip_code_prefix, '^[0-9]{5}$')",
            "Valid Latitude": _between("customer_latitude", -90, 90),
            "Valid Longitude": _between("customer_longitude", -180, 180),
        },
    ),
    "olist_sellers": (
        ["seller_id"],
        {
            "Valid State Code": "regexp_matches(seller_state, '^[A-Z]{2}$')",
            "Valid Latitude": _between("seller_latitude", -90, 90),
            "Valid Longitude": _between("seller_longitude", -180, 180),
        },
    ),
    "olist_products": (
        ["product_id"],
        {
            "Positive Weight": "product_weight_g is null or product_weight_g > 0",
            "Positive Volume": "product_volume_cm3 is null or product_volume_cm3 > 0",
        },
    ),
    "olist_orders": (
        ["order_id"],
        {
            "Valid Status": f"order_status in {_CODES['status']}",
            "Purchase Before Delivery": "delivered is null or bought <= delivered",
        },
    ),
    "olist_order_items": (
        ["order_id", "order_item_id"],
        {"Positive Price": "price >= 0", "Positive Freight": "freight_value >= 0", "Valid Total": "total_item_value >= 0"},
    ),
    "olist_order_payments": (
        ["order_id", "payment_sequential"],
        {
            "Valid Payment Type": f"payment_type in {_CODES['payment']}",
            "Positive Amount": "payment_value > 0",
            "Valid Installments": "payment_installments >= 1",
        },
    ),
    "olist_order_reviews": (
        ["review_id", "order_id"],
        {
            "Valid Score": "review_score between 1 and 5",
            "Valid Rating": "review_rating in ('POSITIVE','NEUTRAL','NEGATIVE','UNKNOWN')",
        },
    ),
    "click_customers": (
        ["customer_id"],
        {"Valid Email": "email like '%@%'", "Valid Age": _between("age", 0, 120)},
    ),
    "click_products": (
        ["product_id"],
        {"Non-negative Price": "price_usd >= 0", "Non-negative Cost": "cost_usd >= 0"},
    ),
    "click_sessions": (
        ["session_id"],
        {
            "Has Start Time": "start_time is not null",
            "Has Device": "device is not null",
            "Has Source": "source is not null",
        },
    ),
    "click_orders": (
        ["order_id"],
        {
            "Has Order Time": "order_time is not null",
            "Non-negative Total": "total_usd >= 0",
            "Non-negative Discount": "discount_pct >= 0",
        },
    ),
    "click_order_items": (
        ["order_id", "product_id"],
        {"Positive Quantity": "quantity >= 1", "Non-negative Unit Price": "unit_price_usd >= 0"},
    ),
    "click_events": (
        ["event_id"],
        {"Has Event Type": "event_type is not null", "Has Timestamp": "event_timestamp is not null"},
    ),
    "click_reviews": (
        ["review_id"],
        {
            "Valid Rating": "rating between 1 and 5",
            "Valid Sentiment": "sentiment in ('POSITIVE','NEUTRAL','NEGATIVE')",
        },
    ),
}

GOLD = {
    "dim_date": (["date_sk"], {}),
    "dim_customer": (["customer_sk"], {}),
    "dim_seller": (["seller_sk"], {}),
    "dim_product": (["product_sk"], {}),
    "dim_device": (["device_sk"], {}),
    "dim_traffic_source": (["source_sk"], {}),
    "dim_click_customer": (["customer_sk"], {}),
    "dim_click_product": (["product_sk"], {}),
    "fact_orders": (["order_item_sk"], _resolved("customer", "product", "seller", "date")),
    "fact_reviews": (
        ["review_sk"],
        {**_resolved("customer", "date"), "Valid review score": "review_score between 1 and 5"},
    ),
    "fact_click_orders": (
        ["order_sk"],
        {**_resolved("customer", "device", "source", "date"), "Non-negative Total": "total_usd >= 0"},
    ),
    "fact_sessions": (["session_sk"], _resolved("customer", "device", "source", "date")),
    "fact_clickstream_events": (["event_sk"], _resolved("session", "date")),
    "fact_click_reviews": (
        ["review_sk"],
        {**_resolved("order", "product"), "Valid rating": "rating between 1 and 5"},
    ),
}


def checks(
    table: str, rows: str, keys: list[str], rules: dict[str, str], unique: bool = True, label: str = "{}"
) -> list[str]:
    """One SELECT per check; ``label`` shapes the key names shown."""
    found = []

    def row(check: str, passed: str, detail: str, measured: str) -> None:
        found.append(
            f"select '{table}' as table_name, '{check}' as check_name, {passed} as passed, {detail} as detail "
            f"from (select count(*) as total, {measured} as n from ({rows}) t) m"
        )

    for key in keys:
        row(
            "pk_not_null_" + label.format(key),
            "n = 0",
            "printf('%d/%d nulls', n, total)",
            f"count(*) filter (where {key} is null)",
        )
    if unique and keys:
        row(
            "no_duplicates",
            "n = 0",
            "printf('%d duplicates', n)",
            f"count(*) - (select count(*) from (select distinct {', '.join(keys)} from ({rows}) u) v)",
        )
    for name, rule in rules.items():
        row(
            name,
            "n * 100.0 / total <= 5.0",
            "printf('%d/%d (%.1f%%)', n, total, cast(n as double) / total * 100)",
            f"count(*) filter (where not coalesce({rule}, false))",
        )
    return found


def layer(name: str) -> str:
    selects: list[str] = []
    if name == "bronze":
        for table, source in SOURCE_TABLES.items():
            image = " or ".join(f"after_{c} is not null" for c in source.columns)
            selects += checks(
                table,
                f"select * from ({oracle.bronze(table)}) e where op <> 'd'",
                [f"after_{key}" for key in source.key],
                {"Valid CDC op": "op in ('c','r','u')", "Has ts_ms": "ts_ms > 0", "Has after image": image},
                unique=False,
            )
        return " union all ".join(selects).replace("pk_not_null_after_", "pk_not_null_after.")
    for table, (keys, rules) in {"silver": SILVER, "gold": GOLD}[name].items():
        part = f"s_{table}" if name == "silver" else table
        selects += checks(table, f"select * from {part}", keys, rules)
    return " union all ".join(selects)
