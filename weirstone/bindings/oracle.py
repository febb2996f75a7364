"""The same results in plain SQL for the checking database.

Written from what each table means: the current rows of a feed are the base
rows not deleted (or inserted again), values are parsed with that database's
own functions, rounding is done on integers. Only the definition of the feeds
and the constant tables are shared with the Spark side.
"""

from __future__ import annotations

import re

from weirstone.bindings.feeds import SNAPSHOT_MS, DuckDialect, feeds
from weirstone.functions.cleaning import STATE_REGION, STATUS_CLASS
from weirstone.schemas import SOURCE_TABLES

FEEDS = feeds(DuckDialect())
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _base(table: str) -> str:
    return FEEDS[table].base.format(**{name: name for name in TABLES})


def _columns(image: dict[str, str]) -> str:
    return ", ".join(f"{expression} as {name}" for name, expression in image.items())


def current_images(table: str) -> str:
    feed = FEEDS[table]
    return f"select {_columns(feed.image)} from ({_base(table)}) b where not ({feed.deleted}) or ({feed.restored})"


def all_images(table: str) -> str:
    feed = FEEDS[table]
    first = {
        name: f"case when {feed.updated} then {feed.stale[name]} else {expression} end" if name in feed.stale else expression
        for name, expression in feed.image.items()
    }
    base = _base(table)
    return (
        f"select {_columns(first)} from ({base}) b "
        f"union all select {_columns(feed.image)} from ({base}) b where {feed.updated} "
        f"union all select {_columns(feed.image)} from ({base}) b where {feed.restored}"
    )


def bronze(table: str) -> str:
    feed = FEEDS[table]
    base = _base(table)
    first = {
        name: f"case when {feed.updated} then {feed.stale[name]} else {expression} end" if name in feed.stale else expression
        for name, expression in feed.image.items()
    }

    def event(op: str, step: int, before: dict | None, after: dict | None, happened: str) -> str:
        sides = [
            f"cast({side[name] if side else 'null'} as varchar) as {label}_{name}"
            for label, side in (("before", before), ("after", after))
            for name in feed.image
        ]
        return (
            f"select '{SOURCE_TABLES[table].topic}' as topic, '{op}' as op, "
            f"cast({SNAPSHOT_MS + 1000 * min(step, 2)} as bigint) as ts_ms, cast({step} as bigint) as log_offset, "
            f"{', '.join(sides)} from ({base}) b where {happened}"
        )

    return " union all ".join(
        [
            event("r", 0, None, first, "true"),
            event("u", 1, first, feed.image, feed.updated),
            event("d", 2, feed.image, None, feed.deleted),
            event("c", 3, None, feed.image, feed.restored),
        ]
    )


# -- helpers --------------------------------------------------------------------


def half_up(part: str, whole: str, digits: int) -> str:
    """part / whole for non-negative integers, rounded half up without going through a double."""
    scale = 10**digits
    return (
        f"(cast((2 * cast({part} as hugeint) * {scale} + ({whole})) // nullif(2 * ({whole}), 0) as double) / {scale}.0)"
    )


def rounded(expression: str, digits: int) -> str:
    """A double rounded half up on its shortest decimal text, as Spark's round does."""
    return f"cast(round(cast(cast({expression} as varchar) as decimal(38,18)), {digits}) as double)"


def cents(column: str) -> str:
    return f"cast(round({column} * 100) as bigint)"


def money_sum(column: str) -> str:
    return f"(cast(sum({cents(column)}) as double) / 100.0)"


def money_mean(column: str, digits: int = 2) -> str:
    return half_up(f"sum({cents(column)})", f"count({column}) * 100", digits)


def seconds_stamp(ms: str) -> str:
    """Epoch millis cut to the second."""
    return f"epoch_ms((cast({ms} as bigint) // 1000) * 1000)"


def any_stamp(text: str) -> str:
    return (
        f"case when regexp_matches(trim({text}), '^[0-9]+$') then {seconds_stamp(f'try_cast(trim({text}) as bigint)')} "
        f"else try_cast(replace(trim({text}), 'Z', '') as timestamp) end"
    )


def iso(column: str) -> str:
    return (
        f"case when date_part('microsecond', {column}) % 1000000 = 0 then strftime({column}, '%Y-%m-%dT%H:%M:%S') "
        f"else strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') end"
    )


def iso_day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def truncated(text: str, kind: str = "int") -> str:
    return f"cast(trunc(try_cast({text} as double)) as {kind})"


def date_key(column: str) -> str:
    return f"cast(strftime({column}, '%Y%m%d') as int)"


def _case(column: str, table: dict[str, str], default: str) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then '{v}'" for k, v in table.items()) + f" else '{default}' end"


def surrogate(business_key: list[str], ties: list[str] | None = None) -> str:
    columns = [*business_key, *(ties or [])]
    joined = " || '|' || ".join(f"coalesce(cast({c} as varchar), '')" for c in columns)
    order = ", ".join(f"{c} asc nulls first" for c in columns)
    bucket = f"cast('0x' || substr(md5({joined}), 1, 4) as bigint)"
    return f"({bucket} * 68719476736 + row_number() over (partition by {bucket} order by {order}))"


# -- silver ---------------------------------------------------------------------

_GEO = f"""
    select zip, lat, lng from (
        select zip, {{lat}} as lat, {{lng}} as lng from (
            select trim(geolocation_zip_code_prefix) as zip, upper(trim(geolocation_city)) as city,
                cast(cast(geolocation_lat as decimal(9,6)) * 1000000 as bigint) as lat6,
                cast(cast(geolocation_lng as decimal(9,6)) * 1000000 as bigint) as lng6
            from ({all_images('olist_geolocation')}) g
            where cast(geolocation_lat as double) between -90 and 90
              and cast(geolocation_lng as double) between -180 and 180) p
        group by zip, city) c
    qualify row_number() over (partition by zip order by lat, lng) = 1
""".format(
    lat="sign(sum(lat6)) * " + half_up("abs(sum(lat6))", "count(*)", 0) + " / 1000000.0",
    lng="sign(sum(lng6)) * " + half_up("abs(sum(lng6))", "count(*)", 0) + " / 1000000.0",
)


def _place(table: str, kind: str, lead: str) -> str:
    state = f"upper(trim({kind}_state))"
    return f"""
        select {lead}, trim({kind}_zip_code_prefix) as {kind}_zip_code_prefix,
            upper(trim({kind}_city)) as {kind}_city, {state} as {kind}_state,
            {_case(state, STATE_REGION, 'OUTROS')} as {kind}_region,
            g.lat as {kind}_latitude, g.lng as {kind}_longitude
        from ({current_images(table)}) p left join geo g on g.zip = trim({kind}_zip_code_prefix)"""


_COPIED = "trim({0}) as {0}"

PARTS: dict[str, str] = {
    "geo": _GEO,
    "s_olist_customers": _place(
        "olist_customers",
        "customer",
        "trim(customer_id) as customer_id, trim(customer_unique_id) as customer_unique_id",
    ),
    "s_olist_sellers": _place("olist_sellers", "seller", "trim(seller_id) as seller_id"),
    "s_olist_products": f"""
        select product_id, product_category_name,
            coalesce(english, product_category_name) as product_category_name_english,
            product_name_length, product_description_length, product_photos_qty, product_weight_g,
            product_length_cm, product_height_cm, product_width_cm,
            cast(product_length_cm as bigint) * product_height_cm * product_width_cm as product_volume_cm3
        from (select trim(product_id) as product_id, trim(product_category_name) as product_category_name,
                {", ".join(f"{truncated(c)} as {c}" for c in (
                    "product_name_length", "product_description_length", "product_photos_qty",
                    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"))}
              from ({current_images('olist_products')}) i) p
        left join (select trim(product_category_name) as category, trim(product_category_name_english) as english
                   from ({all_images('product_category_translation')}) i) t
        on t.category = p.product_category_name""",
    "s_olist_orders": f"""
        select *, cast(year(bought) as int) as order_year, cast(month(bought) as int) as order_month,
            cast(day(bought) as int) as order_day, cast(hour(bought) as int) as order_hour,
            cast(date_diff('day', cast(bought as date), cast(approved as date)) as int) as approval_delay_days,
            cast(date_diff('day', cast(bought as date), cast(delivered as date)) as int) as actual_delivery_days,
            cast(date_diff('day', cast(bought as date), cast(due as date)) as int) as estimated_delivery_days,
            cast(date_diff('day', cast(due as date), cast(delivered as date)) as int) as delivery_delay_days,
            date_diff('day', cast(due as date), cast(delivered as date)) > 0 as is_delivered_late,
            order_status = 'DELIVERED' as is_delivered
        from (select trim(order_id) as order_id, trim(customer_id) as customer_id,
                upper(trim(order_status)) as order_status,
                {seconds_stamp('order_purchase_timestamp')} as bought,
                cast(order_approved_at as timestamp) as approved,
                {seconds_stamp('order_delivered_carrier_date')} as carried,
                cast(order_delivered_customer_date as timestamp) as delivered,
                cast(order_estimated_delivery_date as timestamp) as due
              from ({current_images('olist_orders')}) i) o""",
    "s_olist_order_items": f"""
        select order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value,
            price + freight_value as total_item_value,
            case when price > 0 then {rounded('freight_value / price', 4)} end as freight_ratio
        from (select trim(order_id) as order_id, order_item_id, trim(product_id) as product_id,
                trim(seller_id) as seller_id, {seconds_stamp('shipping_limit_date')} as shipping_limit_date,
                cast(price as double) as price, cast(freight_value as double) as freight_value
              from ({all_images('olist_order_items')}) i) o""",
    "s_olist_order_payments": f"""
        select order_id, payment_sequential, payment_type, payment_installments, payment_value,
            case when payment_installments > 0
                then {rounded('payment_value / payment_installments', 2)}
                else payment_value end as installment_value,
            coalesce(payment_installments > 1, false) as is_installment_payment
        from (select trim(order_id) as order_id, payment_sequential, upper(trim(payment_type)) as payment_type,
                cast(payment_installments as int) as payment_installments,
                cast(payment_value as double) as payment_value
              from ({all_images('olist_order_payments')}) i) p""",
    "s_olist_order_reviews": f"""
        select *, case when review_score >= 4 then 'POSITIVE' when review_score = 3 then 'NEUTRAL'
                when review_score <= 2 then 'NEGATIVE' else 'UNKNOWN' end as review_rating,
            coalesce(review_comment_title <> '', false) or coalesce(review_comment_message <> '', false) as has_comment,
            {half_up('(epoch_ms(answered) - epoch_ms(created))', '3600000', 2)} as review_response_time_hours
        from (select trim(review_id) as review_id, trim(order_id) as order_id,
                cast(review_score as int) as review_score,
                trim(review_comment_title) as review_comment_title,
                trim(review_comment_message) as review_comment_message,
                {seconds_stamp('review_creation_date')} as created,
                cast(review_answer_timestamp as timestamp) as answered
              from ({current_images('olist_order_reviews')}) i) r""",
    "s_click_customers": f"""
        select cast(customer_id as bigint) as customer_id, trim(name) as customer_name, trim(email) as email,
            upper(trim(country)) as country, try_cast(age as int) as age,
            case when contains(signup_date, '/') then cast(strptime(signup_date, '%m/%d/%Y') as date)
                 when regexp_matches(signup_date, '^[0-9]+$') then
                    case when cast(signup_date as bigint) > 10000000000
                            then cast({seconds_stamp("signup_date")} as date)
                         when cast(signup_date as bigint) > 1000000
                            then cast(epoch_ms(cast(signup_date as bigint) * 1000) as date)
                         else date '1970-01-01' + cast(signup_date as int) end
                 else cast(substr(trim(signup_date, '"'), 1, 10) as date) end as signup_date,
            marketing_opt_in
        from ({current_images('click_customers')}) i""",
    "s_click_products": f"""
        select cast(product_id as bigint) as product_id, upper(trim(category)) as product_category,
            trim(name) as product_name, cast(price_usd as double) as price_usd, cast(cost_usd as double) as cost_usd,
            cast(margin_usd as double) as margin_usd
        from ({current_images('click_products')}) i where cast(price_usd as double) >= 0""",
    "s_click_sessions": f"""
        select cast(session_id as bigint) as session_id, cast(customer_id as bigint) as customer_id,
            {any_stamp('start_time')} as start_time, upper(trim(device)) as device,
            upper(trim(source)) as source, upper(trim(country)) as country
        from ({current_images('click_sessions')}) i""",
    "s_click_orders": f"""
        select cast(order_id as bigint) as order_id, cast(customer_id as bigint) as customer_id,
            {any_stamp('order_time')} as order_time, upper(trim(payment_method)) as payment_method,
            cast(discount_pct as double) as discount_pct, cast(subtotal_usd as double) as subtotal_usd,
            cast(total_usd as double) as total_usd, upper(trim(country)) as country,
            upper(trim(device)) as device, upper(trim(source)) as source
        from ({current_images('click_orders')}) i""",
    "s_click_order_items": f"""
        select cast(order_id as bigint) as order_id, cast(product_id as bigint) as product_id,
            cast(unit_price_usd as double) as unit_price_usd, cast(quantity as int) as quantity,
            cast(line_total_usd as double) as line_total_usd
        from ({current_images('click_order_items')}) i where cast(quantity as int) > 0""",
    "s_click_events": f"""
        select cast(event_id as bigint) as event_id, cast(session_id as bigint) as session_id,
            {seconds_stamp('"timestamp"')} as event_timestamp, upper(trim(event_type)) as event_type,
            coalesce({truncated('product_id', 'bigint')}, -1) as product_id,
            coalesce(cast(qty as int), 0) as quantity,
            coalesce(upper(trim(payment)), 'NOT_APPLICABLE') as payment_method
        from ({current_images('click_events')}) i""",
    "s_click_reviews": f"""
        select cast(review_id as bigint) as review_id, cast(order_id as bigint) as order_id,
            cast(product_id as bigint) as product_id, cast(rating as int) as rating,
            trim(review_text) as review_text, {seconds_stamp('review_time')} as review_time,
            case when rating >= 4 then 'POSITIVE' when rating = 3 then 'NEUTRAL' else 'NEGATIVE' end as sentiment
        from ({current_images('click_reviews')}) i""",
}

# -- gold -----------------------------------------------------------------------

_PLACE = "{0}_zip_code_prefix, {0}_city, {0}_state, {0}_region, {0}_latitude, {0}_longitude"
_NO_PLACE = "'00000', 'UNKNOWN', 'UNKNOWN', 'OUTROS', null, null"


def _lookup(alias: str, key: str) -> str:
    return f"cast(coalesce({alias}.{key}, -1) as bigint) as {key}"


PARTS |= {
    "dim_date": """
        select cast(strftime(d, '%Y%m%d') as int) as date_sk, d as full_date, cast(day(d) as int) as day_of_month,
            cast(dayofweek(d) + 1 as int) as day_of_week, dayname(d) as day_name,
            cast(weekofyear(d) as int) as week_of_year, cast(month(d) as int) as month_number,
            monthname(d) as month_name, cast(quarter(d) as int) as quarter, cast(year(d) as int) as year,
            dayofweek(d) in (0, 6) as is_weekend, strftime(d, '%Y-%m') as year_month,
            year(d) || '-Q' || quarter(d) as year_quarter
        from (select unnest(generate_series(
                    make_date(cast(min(year(bought)) as int), 1, 1),
                    make_date(cast(max(year(bought)) as int), 12, 31), interval 1 day)) as d
              from s_olist_orders) days""",
    "dim_customer": f"""
        select {surrogate(['customer_unique_id'])} as customer_sk, customer_unique_id, {_PLACE.format('customer')}
        from (select * from s_olist_customers
              qualify row_number() over (partition by customer_unique_id order by customer_id) = 1) p
        union all select -1, 'UNKNOWN', {_NO_PLACE}""",
    "dim_seller": f"""
        select {surrogate(['seller_id'])} as seller_sk, seller_id, {_PLACE.format('seller')} from s_olist_sellers
        union all select -1, 'UNKNOWN', {_NO_PLACE}""",
    "dim_product": f"""
        select {surrogate(['product_id'])} as product_sk, *,
            case when product_volume_cm3 < 1000 then 'SMALL' when product_volume_cm3 < 10000 then 'MEDIUM'
                when product_volume_cm3 < 50000 then 'LARGE' when product_volume_cm3 >= 50000 then 'EXTRA_LARGE'
                else 'UNKNOWN' end as size_category,
            case when product_weight_g < 500 then 'LIGHT' when product_weight_g < 2000 then 'MEDIUM'
                when product_weight_g < 10000 then 'HEAVY' when product_weight_g >= 10000 then 'VERY_HEAVY'
                else 'UNKNOWN' end as weight_category
        from s_olist_products
        union all select -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', null, null, null, null, null, null, null, null,
            'UNKNOWN', 'UNKNOWN'""",
    "dim_device": f"""
        select {surrogate(['device'])} as device_sk, device
        from (select device from s_click_sessions where device is not null
              union select device from s_click_orders where device is not null) u
        union all select -1, 'UNKNOWN'""",
    "dim_traffic_source": f"""
        select {surrogate(['source'])} as source_sk, source as traffic_source
        from (select source from s_click_sessions where source is not null
              union select source from s_click_orders where source is not null) u
        union all select -1, 'UNKNOWN'""",
    "dim_click_customer": f"""
        select {surrogate(['customer_id'])} as customer_sk, * from s_click_customers
        union all select -1, -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', null, null, false""",
    "dim_click_product": f"""
        select {surrogate(['product_id'])} as product_sk, * from s_click_products
        union all select -1, -1, 'UNKNOWN', 'UNKNOWN', null, null, null""",
    "owners": """
        select c.customer_id, d.customer_sk from s_olist_customers c
        left join dim_customer d on d.customer_unique_id = c.customer_unique_id and d.customer_sk <> -1""",
    "paid": f"""
        select order_id, {money_sum('payment_value')} as total_payment_value,
            cast(sum(payment_installments) as int) as payment_installments,
            arg_min(payment_type, payment_sequential) as primary_payment_type
        from s_olist_order_payments group by order_id""",
    "fact_orders": f"""
        select {surrogate(['order_id', 'order_item_id'],
                          ['product_sk', 'seller_sk', 'unit_price', 'freight_value', 'shipping_limit_date'])}
            as order_item_sk, *
        from (select i.order_id, i.order_item_id, {date_key('o.bought')} as date_sk,
                {_lookup('w', 'customer_sk')}, {_lookup('p', 'product_sk')}, {_lookup('s', 'seller_sk')},
                o.order_status, {_case('o.order_status', STATUS_CLASS, 'OTHER')} as status_category,
                o.is_delivered, o.is_delivered_late, i.price as unit_price, i.freight_value, i.total_item_value,
                o.actual_delivery_days, o.delivery_delay_days,
                coalesce(y.total_payment_value, 0.0) as total_payment_value,
                coalesce(y.payment_installments, 0) as payment_installments,
                coalesce(y.primary_payment_type, 'UNKNOWN') as primary_payment_type,
                o.bought as order_purchase_timestamp, o.approved as order_approved_at,
                o.delivered as order_delivered_customer_date, i.shipping_limit_date
              from s_olist_order_items i join s_olist_orders o on o.order_id = i.order_id
              left join owners w on w.customer_id = o.customer_id
              left join paid y on y.order_id = i.order_id
              left join dim_product p on p.product_id = i.product_id and p.product_sk <> -1
              left join dim_seller s on s.seller_id = i.seller_id and s.seller_sk <> -1) f""",
    "fact_reviews": f"""
        select {surrogate(['review_id', 'order_id'])} as review_sk, *
        from (select r.review_id, r.order_id, {date_key('r.created')} as date_sk, {_lookup('w', 'customer_sk')},
                r.review_score, r.review_rating, r.review_comment_title, r.review_comment_message,
                r.has_comment as review_has_comment, r.review_response_time_hours,
                case when r.review_score >= 4 then 1 else 0 end as is_positive,
                case when r.review_score = 3 then 1 else 0 end as is_neutral,
                case when r.review_score <= 2 then 1 else 0 end as is_negative,
                r.created as review_creation_date, r.answered as review_answer_timestamp
              from s_olist_order_reviews r join s_olist_orders o on o.order_id = r.order_id
              left join owners w on w.customer_id = o.customer_id) f""",
    "fact_click_orders": f"""
        select {surrogate(['order_id'])} as order_sk, o.order_id, {_lookup('c', 'customer_sk')},
            {date_key('o.order_time')} as date_sk, {_lookup('d', 'device_sk')}, {_lookup('t', 'source_sk')},
            o.payment_method, o.discount_pct, o.subtotal_usd, o.total_usd, o.country,
            o.order_time as order_timestamp
        from s_click_orders o
        left join dim_click_customer c on c.customer_id = o.customer_id and c.customer_sk <> -1
        left join dim_device d on d.device = o.device and d.device_sk <> -1
        left join dim_traffic_source t on t.traffic_source = o.source and t.source_sk <> -1""",
    "fact_sessions": f"""
        select {surrogate(['session_id'])} as session_sk, o.session_id, {_lookup('c', 'customer_sk')},
            {date_key('o.start_time')} as date_sk, {_lookup('d', 'device_sk')}, {_lookup('t', 'source_sk')},
            o.country, o.start_time as session_start_timestamp
        from s_click_sessions o
        left join dim_click_customer c on c.customer_id = o.customer_id and c.customer_sk <> -1
        left join dim_device d on d.device = o.device and d.device_sk <> -1
        left join dim_traffic_source t on t.traffic_source = o.source and t.source_sk <> -1""",
    "fact_clickstream_events": f"""
        select {surrogate(['event_id'])} as event_sk, e.event_id, {_lookup('s', 'session_sk')},
            {_lookup('s', 'customer_sk')}, {date_key('e.event_timestamp')} as date_sk, {_lookup('p', 'product_sk')},
            e.event_type, e.quantity, e.payment_method, e.event_timestamp
        from s_click_events e left join fact_sessions s on s.session_id = e.session_id
        left join dim_click_product p on p.product_id = e.product_id and p.product_sk <> -1""",
    "fact_click_reviews": f"""
        select {surrogate(['review_id'])} as review_sk, r.review_id, {_lookup('o', 'order_sk')},
            {_lookup('p', 'product_sk')}, {date_key('r.review_time')} as date_sk, r.rating, r.review_text,
            r.sentiment, r.review_time as review_timestamp
        from s_click_reviews r left join fact_click_orders o on o.order_id = r.order_id
        left join dim_click_product p on p.product_id = r.product_id and p.product_sk <> -1""",
}

_NAMES = re.compile(r"\b(" + "|".join(sorted(PARTS, key=len, reverse=True)) + r")\b")


def over(query: str) -> str:
    """The query with the parts it refers to, directly or not, as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAMES.findall(text)):
            if name not in needed:
                visit(PARTS[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    if not needed:
        return query
    if query.lstrip().startswith("with "):
        query = ", " + query.lstrip().removeprefix("with ")
    return "with " + ", ".join(f"{name} as ({PARTS[name]})" for name in needed) + " " + query
