"""Every operator and report as a query over the sample tables, with its check SQL."""

from __future__ import annotations

import contextlib
import json
import re
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirstone.bindings import oracle, quality_sql, reports_sql
from weirstone.bindings.feeds import DuckDialect, SparkDialect
from weirstone.bindings.workspace import Workspace
from weirstone.functions import cleaning as clean
from weirstone.functions import money
from weirstone.functions import parsing as parse
from weirstone.layout import GOLD_TABLES, SILVER_TABLES, Lake
from weirstone.operators.calendar import calendar, date_spine
from weirstone.operators.keys import dense_key, surrogate_key, with_unknown
from weirstone.operators.latest import images, latest_images, latest_rows
from weirstone.operators.lookups import resolve
from weirstone.operators.profile import Profile, absorbed
from weirstone.operators.quality import Check, Result, gate, log_results, result_rows, validate, validate_stored
from weirstone.operators.sets import distinct_values
from weirstone.plans import pipeline, reports, serving
from weirstone.plans.incremental import OrderFacts, changed_orders
from weirstone.plans.resume import resume
from weirstone.plans.rules import CHECKS
from weirstone.schemas import SOURCE_TABLES, TABLE_OF_TOPIC
from weirstone.session import side_by_side
from weirstone.sources import catalog, changes, files, tables, topic_log
from weirstone.streaming.store import EVERY_IMAGE, TopicStore, append_all, maintain_all, whole

Run = Callable[[Workspace], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}

spark_sql, duck_sql = SparkDialect(), DuckDialect()


def add(name: str, run: Run, sql: str | None = None) -> None:
    QUERIES[name] = run
    if sql is not None:
        SQL[name] = oracle.over(sql)


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name."""

    def register(run: Run) -> Run:
        add(run.__name__, run, sql)
        return run

    return register


# -- layers -----------------------------------------------------------------------

# Timestamps and dates of each stored table, shown as ISO text.
_STAMPS = {
    "olist_orders": {
        "bought": "order_purchase_timestamp",
        "approved": "order_approved_at",
        "carried": "order_delivered_carrier_date",
        "delivered": "order_delivered_customer_date",
        "due": "order_estimated_delivery_date",
    },
    "olist_order_items": {"shipping_limit_date": "shipping_limit_date"},
    "olist_order_reviews": {"created": "review_creation_date", "answered": "review_answer_timestamp"},
    "click_sessions": {"start_time": "start_time"},
    "click_orders": {"order_time": "order_time"},
    "click_events": {"event_timestamp": "event_timestamp"},
    "click_reviews": {"review_time": "review_time"},
    "dim_date": {"full_date": "full_date"},
    "fact_orders": {
        c: c
        for c in (
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_customer_date",
            "shipping_limit_date",
        )
    },
    "fact_reviews": {c: c for c in ("review_creation_date", "review_answer_timestamp")},
    "fact_click_orders": {"order_timestamp": "order_timestamp"},
    "fact_sessions": {"session_start_timestamp": "session_start_timestamp"},
    "fact_clickstream_events": {"event_timestamp": "event_timestamp"},
    "fact_click_reviews": {"review_timestamp": "review_timestamp"},
}
_DAYS = {"click_customers": ["signup_date"], "dim_click_customer": ["signup_date"]}


def _shown(part: str, table: str) -> str:
    stamps = {name: (oracle.iso(name), shown) for name, shown in _STAMPS.get(table, {}).items()}
    stamps |= {name: (oracle.iso_day(name), name) for name in _DAYS.get(table, [])}
    if not stamps:
        return f"select * from {part}"
    texts = ", ".join(f"{text} as {shown}" for text, shown in stamps.values())
    return f"select * exclude ({', '.join(stamps)}), {texts} from {part}"


def _bronze(table: str, ws: Workspace) -> DataFrame:
    """Topic text -> decoded events, flattened for display."""
    decoded = changes.decode(ws.topic(table), table)
    sides = [
        F.col(f"{side}.{column}").alias(f"{side}_{column}")
        for side in ("before", "after")
        for column in SOURCE_TABLES[table].columns
    ]
    return decoded.select("topic", "op", "ts_ms", "log_offset", *sides)


def _built(layer: str, stamp: str, table: str, ws: Workspace) -> DataFrame:
    return serving.iso_text(ws.derived(layer, table).drop(stamp))


for _table in SOURCE_TABLES:
    add(f"bronze_{_table}", partial(_bronze, _table), oracle.bronze(_table))
for _table in SILVER_TABLES:
    add(f"silver_{_table}", partial(_built, "silver", "processed_at", _table), _shown(f"s_{_table}", _table))
for _table in GOLD_TABLES:
    add(_table, partial(_built, "gold", "etl_loaded_at", _table), _shown(_table, _table))


# -- reports ----------------------------------------------------------------------

_REPORTS = {
    "q01_customer_count": reports.customer_count,
    "q02_product_count": reports.product_count,
    "q03_revenue_by_region": reports.revenue_by_region,
    "q04_top_categories": reports.top_categories,
    "q05_review_analysis": reports.review_analysis,
    "q06_funnel_analysis": reports.funnel_analysis,
    "q07_session_analytics": reports.session_analytics,
    "q08_device_performance": reports.device_performance,
    "q09_click_revenue_by_country": reports.click_revenue_by_country,
    "q10_dashboard_customers": reports.DASHBOARD["customers"],
    "q11_dashboard_products": reports.DASHBOARD["products"],
    "q12_dashboard_orders": reports.DASHBOARD["orders"],
    "q13_dashboard_revenue": reports.DASHBOARD["total_revenue"],
    "q14_dashboard_review_score": reports.DASHBOARD["average_review_score"],
    "q15_monthly_revenue": reports.DASHBOARD["monthly_revenue"],
    "q16_revenue_by_state": reports.DASHBOARD["revenue_by_state"],
    "q17_sales_by_category": reports.DASHBOARD["sales_by_category"],
    "q18_reviews_by_category": reports.DASHBOARD["reviews_by_category"],
    "q19_dashboard_sessions": reports.DASHBOARD["sessions"],
    "q20_dashboard_events": reports.DASHBOARD["events"],
    "q21_dashboard_click_orders": reports.DASHBOARD["click_orders"],
    "q22_dashboard_click_revenue": reports.DASHBOARD["click_revenue"],
    "q23_sessions_by_event_type": reports.DASHBOARD["sessions_by_event_type"],
    "q24_revenue_by_device": reports.DASHBOARD["revenue_by_device"],
    "q25_revenue_by_country": reports.DASHBOARD["revenue_by_country"],
    "q26_sessions_by_device_and_source": reports.DASHBOARD["sessions_by_device_and_source"],
}
_LISTINGS = {
    "q27_customers_per_state": reports.customers_per_state,
    "q28_customers_per_city": reports.customers_per_city,
    "q29_customers_of_sp": partial(reports.customers_of_state, state="SP"),
    "q30_customers_of_rj": partial(reports.customers_of_state, state="RJ"),
}


def _report(report: Callable, ws: Workspace) -> DataFrame:
    return report(ws.gold)


def _listing(report: Callable, ws: Workspace) -> DataFrame:
    return report(ws.stored("silver", "olist_customers"))


for _name, _function in _REPORTS.items():
    add(_name, partial(_report, _function), reports_sql.SQL[_name])
for _name, _function in _LISTINGS.items():
    add(_name, partial(_listing, _function), reports_sql.SQL[_name])


# -- parsing ----------------------------------------------------------------------


def _bought(d: SparkDialect | DuckDialect) -> str:
    return f"({d.ms('o_orderdate')} + cast(floor(o_totalprice) as bigint) * 1000)"


_BOUGHT = "(o_orderdate + to_seconds(cast(floor(o_totalprice) as bigint)))"


@query(
    f"""select o_orderkey, case when o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED') then null
        else strftime({_BOUGHT}, '%Y-%m-%dT%H:%M:%S') end as parsed from orders"""
)
def parse_safe_timestamp(ws: Workspace) -> DataFrame:
    ms = _bought(spark_sql)
    raw = f"""case o_orderpriority when '1-URGENT' then cast({ms} + 789 as string)
        when '2-HIGH' then {spark_sql.stamp(ms)} when '3-MEDIUM' then 'garbage'
        when '5-LOW' then {spark_sql.iso(ms)} end"""
    rows = ws.sample("orders").selectExpr("o_orderkey", f"{raw} as raw")
    return serving.iso_text(rows.select("o_orderkey", parse.epoch_or_timestamp(F.col("raw")).alias("parsed")))


@query(
    f"""select o_orderkey, case
            when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then null
            when o_orderstatus = 'P' and o_orderpriority = '2-HIGH'
                then strftime({_BOUGHT} - interval 7 hour, '%Y-%m-%dT%H:%M:%S')
            when o_orderpriority = '3-MEDIUM' then strftime({_BOUGHT}, '%Y-%m-%dT%H:%M:%S') || '.123000'
            else strftime({_BOUGHT}, '%Y-%m-%dT%H:%M:%S') end as parsed from orders"""
)
def parse_multi_format_timestamp(ws: Workspace) -> DataFrame:
    ms = _bought(spark_sql)
    raw = f"""case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then 'n/a'
        when o_orderstatus = 'P' and o_orderpriority = '2-HIGH' then {spark_sql.iso(ms)} || '+07'
        when o_orderpriority = '1-URGENT' then '  ' || cast({ms} as string) || ' '
        when o_orderpriority = '2-HIGH' then {spark_sql.iso(ms)} || 'Z'
        when o_orderpriority = '3-MEDIUM' then {spark_sql.iso_millis(f'{ms} + 123')}
        when o_orderpriority = '4-NOT SPECIFIED' then {spark_sql.iso(ms)}
        else ' ' || {spark_sql.stamp(ms)} end"""
    rows = ws.sample("orders").selectExpr("o_orderkey", f"{raw} as raw")
    return serving.iso_text(rows.select("o_orderkey", parse.any_timestamp(F.col("raw")).alias("parsed")))


@query(
    """select o_orderkey, case when o_orderstatus = 'P' and o_orderpriority in ('1-URGENT', '2-HIGH') then null
        else strftime(o_orderdate, '%Y-%m-%d') end as parsed from orders"""
)
def parse_multi_format_date(ws: Workspace) -> DataFrame:
    ms = spark_sql.ms("o_orderdate")
    days = spark_sql.div(ms, 86_400_000)
    raw = f"""case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then 'soon'
        when o_orderstatus = 'P' and o_orderpriority = '2-HIGH' then '2024-13-45'
        when o_orderstatus = 'P' and o_orderpriority = '3-MEDIUM' then cast({ms} + 5000 as string)
        when o_orderstatus = 'P' then cast({spark_sql.div(ms, 1000)} as string)
        when o_orderpriority = '1-URGENT' then {spark_sql.us_date(days)}
        when o_orderpriority = '2-HIGH' then '"' || {spark_sql.iso_date(days)} || '"'
        when o_orderpriority = '3-MEDIUM' then {spark_sql.iso_date(days)} || ' 23:59:59'
        when o_orderpriority = '4-NOT SPECIFIED' then cast({days} as string)
        else {spark_sql.iso_date(days)} end"""
    rows = ws.sample("orders").selectExpr("o_orderkey", f"{raw} as raw")
    return serving.iso_text(rows.select("o_orderkey", parse.any_date(F.col("raw")).alias("parsed")))


_LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


@query(
    f"""select {_LINE}, case l_returnflag when 'A' then cast(trunc(l_extendedprice) as bigint)
            when 'N' then cast(l_quantity as bigint) end as whole,
        case l_returnflag when 'A' then l_extendedprice end as real,
        case l_returnflag when 'A' then true when 'N' then false end as flag from lineitem"""
)
def lenient_casts(ws: Workspace) -> DataFrame:
    amount = "cast(cast(l_extendedprice as decimal(10,2)) as string)"
    rows = ws.sample("lineitem").selectExpr(
        *_LINE.split(", "),
        f"case l_returnflag when 'A' then {amount} when 'N' then ' ' || cast(int(l_quantity) as string) || ' ' else 'x1' end as w",
        f"case l_returnflag when 'A' then {amount} when 'N' then 'abc' end as r",
        "case l_returnflag when 'A' then 'true' when 'N' then 'no' else 'maybe' end as f",
    )
    return rows.select(
        *_LINE.split(", "),
        parse.whole(F.col("w")).alias("whole"),
        parse.real(F.col("r")).alias("real"),
        parse.flag(F.col("f")).alias("flag"),
    )


# -- cleaning ---------------------------------------------------------------------


@query("select p_partkey, p_name as text_value, upper(p_type) as code_value from part")
def clean_trim_upper(ws: Workspace) -> DataFrame:
    rows = ws.sample("part").selectExpr("p_partkey", "'  ' || p_name || ' ' as n", "' ' || lower(p_type) as t")
    return rows.select(
        "p_partkey", clean.text(F.col("n")).alias("text_value"), clean.code(F.col("t")).alias("code_value")
    )


@query(
    """select event_id, case when event_type = 'purchase' then 'BUYER' else 'NOT_APPLICABLE' end as role,
        case when value > 50 then cast(floor(value) as bigint) else -1 end as amount from events"""
)
def null_defaults(ws: Workspace) -> DataFrame:
    return ws.sample("events").select(
        "event_id",
        F.coalesce(F.when(F.col("event_type") == "purchase", F.lit("BUYER")), F.lit("NOT_APPLICABLE")).alias("role"),
        F.coalesce(F.when(F.col("value") > 50, F.floor("value")), F.lit(-1)).cast("bigint").alias("amount"),
    )


_STATES = "".join(clean.STATE_REGION)
_NATION_STATE = f"case when c_nationkey < 24 then substr('{_STATES}', c_nationkey * 2 + 1, 2) else 'ZZ' end"


@query(f"select c_custkey, {oracle._case(_NATION_STATE, clean.STATE_REGION, 'OUTROS')} as region from customer")
def region_mapping(ws: Workspace) -> DataFrame:
    state = F.expr(_NATION_STATE)
    return ws.sample("customer").select("c_custkey", clean.region_of(state).alias("region"))


_STATUS = "case o_orderstatus when 'F' then 'DELIVERED' when 'O' then 'SHIPPED' else upper(substr(o_orderpriority, 3)) end"


@query(f"select o_orderkey, {oracle._case(_STATUS, clean.STATUS_CLASS, 'OTHER')} as status_category from orders")
def status_category(ws: Workspace) -> DataFrame:
    return ws.sample("orders").select("o_orderkey", clean.status_class(F.expr(_STATUS)).alias("status_category"))


@query(
    """select p_partkey, case when volume < 1000 then 'SMALL' when volume < 10000 then 'MEDIUM'
            when volume < 50000 then 'LARGE' when volume >= 50000 then 'EXTRA_LARGE' else 'UNKNOWN' end as size_band,
        case when weight < 500 then 'LIGHT' when weight < 2000 then 'MEDIUM' when weight < 10000 then 'HEAVY'
            when weight >= 10000 then 'VERY_HEAVY' else 'UNKNOWN' end as weight_band, volume
        from (select p_partkey, p_size * 200 as weight,
            case when p_type <> 'SMALL' then cast(p_size as bigint) * p_size * p_size end as volume from part) p"""
)
def size_weight_bands(ws: Workspace) -> DataFrame:
    side = F.when(F.col("p_type") != "SMALL", F.col("p_size"))
    rows = ws.sample("part").select(
        "p_partkey",
        (F.col("p_size") * 200).alias("weight"),
        clean.product_of(F.col("p_size"), F.col("p_size"), side).alias("volume"),
    )
    return rows.select(
        "p_partkey",
        clean.banded(F.col("volume"), clean.SIZE_CLASSES).alias("size_band"),
        clean.banded(F.col("weight"), clean.WEIGHT_CLASSES).alias("weight_band"),
        "volume",
    )


@query(
    """select o_orderkey, case when s >= 4 then 'POSITIVE' when s = 3 then 'NEUTRAL' when s <= 2 then 'NEGATIVE'
            else 'UNKNOWN' end as review_label,
        case when s >= 4 then 'POSITIVE' when s = 3 then 'NEUTRAL' else 'NEGATIVE' end as click_label,
        case when s >= 4 then 1 else 0 end as is_positive, case when s = 3 then 1 else 0 end as is_neutral,
        case when s <= 2 then 1 else 0 end as is_negative
        from (select o_orderkey, case when o_orderstatus <> 'P' then 1 + cast(floor(o_totalprice / 100000) as int) end as s
              from orders) o"""
)
def score_labels_and_flags(ws: Workspace) -> DataFrame:
    score = F.when(F.col("o_orderstatus") != "P", 1 + F.floor(F.col("o_totalprice") / 100000).cast("int"))
    return ws.sample("orders").select(
        "o_orderkey",
        clean.score_label(score, when_missing="UNKNOWN").alias("review_label"),
        clean.score_label(score, when_missing="NEGATIVE").alias("click_label"),
        clean.indicator(score >= 4).alias("is_positive"),
        clean.indicator(score == 3).alias("is_neutral"),
        clean.indicator(score <= 2).alias("is_negative"),
    )


@query(
    f"""select {_LINE}, cast(year(o_orderdate) as int) as order_year, cast(month(o_orderdate) as int) as order_month,
        cast(day(o_orderdate) as int) as order_day, cast(strftime(l_shipdate, '%Y%m%d') as int) as ship_date_key,
        delay as delivery_delay_days, delay > 0 as is_delivered_late,
        cast(date_diff('hour', o_orderdate, l_shipdate) as double) as response_hours
        from (select *, case when l_linestatus = 'F' then
                cast(date_diff('day', cast(o_orderdate as date) + 60, cast(l_shipdate as date)) as int) end as delay
              from lineitem join orders on o_orderkey = l_orderkey) j"""
)
def order_derived_dates(ws: Workspace) -> DataFrame:
    ordered, shipped = F.col("o_orderdate").cast("timestamp"), F.col("l_shipdate").cast("timestamp")
    due = F.date_add(ordered, 60)
    delay = F.datediff(F.when(F.col("l_linestatus") == "F", shipped), due)
    joined = ws.sample("lineitem").join(ws.sample("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        *_LINE.split(", "),
        F.year(ordered).alias("order_year"),
        F.month(ordered).alias("order_month"),
        F.dayofmonth(ordered).alias("order_day"),
        clean.date_key(shipped).alias("ship_date_key"),
        delay.alias("delivery_delay_days"),
        (delay > 0).alias("is_delivered_late"),
        clean.hours_between(ordered, shipped).alias("response_hours"),
    )


@query(
    f"""select {_LINE}, case when l_extendedprice > 0
            then {oracle.rounded('l_quantity / l_extendedprice', 4)} end as freight_ratio,
        case when n > 0 then {oracle.rounded('l_extendedprice / n', 2)} else l_extendedprice end as installment_value
        from (select *, case l_returnflag when 'A' then cast(l_quantity as int) when 'N' then 0 end as n from lineitem) l"""
)
def guarded_ratios(ws: Workspace) -> DataFrame:
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    count = F.when(F.col("l_returnflag") == "A", quantity.cast("int")).when(F.col("l_returnflag") == "N", 0)
    return ws.sample("lineitem").select(
        *_LINE.split(", "),
        clean.ratio(quantity, price, 4).alias("freight_ratio"),
        clean.installment(price, count).alias("installment_value"),
    )


@query(
    """select doc_id, coalesce(trim(text) <> '', false) or coalesce(lang = 'en', false) as has_comment,
        length(trim(text)) > 0 as text_only from documents"""
)
def has_text_flag(ws: Workspace) -> DataFrame:
    title = F.when(F.col("lang") == "en", F.col("lang")).otherwise(F.lit("  "))
    return ws.sample("documents").select(
        "doc_id",
        clean.has_text(F.col("text"), title).alias("has_comment"),
        clean.has_text(F.col("text")).alias("text_only"),
    )


# -- change events ----------------------------------------------------------------

_OP = "case event_type when 'error' then 'd' when 'signup' then 'c' else 'u' end"


def _user_events(ws: Workspace) -> DataFrame:
    """The events as a change log of users: many events per key, deletes among them."""
    image = "struct(user_id as user_id, event_id as event_id, event_type as event_type, value as value)"
    return ws.sample("events").selectExpr(
        f"{_OP} as op",
        f"{spark_sql.ms('ts')} as ts_ms",
        "event_id as log_offset",
        f"if(event_type = 'error', {image}, null) as before",
        f"if(event_type <> 'error', {image}, null) as after",
    )


_NEWEST = "row_number() over (partition by user_id order by epoch_us(ts) // 1000 desc, event_id desc)"
_USER = "user_id, event_id, event_type, value"


@query(
    f"select {_USER} from (select *, {_NEWEST} as rn from events) e where rn = 1 and event_type <> 'error'"
)
def cdc_latest_with_before(ws: Workspace) -> DataFrame:
    return latest_images(_user_events(ws), ["user_id"])


@query(f"select {_USER} from (select *, {_NEWEST} as rn from events where event_type <> 'error') e where rn = 1")
def cdc_latest_no_before(ws: Workspace) -> DataFrame:
    return latest_images(_user_events(ws).drop("before"), ["user_id"])


@query(
    f"""select user_id, event_id, event_type, value, {_OP} as op from
        (select *, row_number() over (partition by user_id order by ts desc, value desc) as rn
         from events where event_type <> 'error') e where rn = 1"""
)
def cdc_latest_flat(ws: Workspace) -> DataFrame:
    rows = ws.sample("events").selectExpr(
        f"{_OP} as op", "unix_micros(cast(ts as timestamp)) as ts_us", "user_id", "value", "event_id", "event_type"
    )
    return latest_rows(rows, ["user_id"], ts="ts_us")


@query(
    f"""select user_id, event_id, event_type from (select *, {_NEWEST} as rn from events) e
        where rn = 1 and event_type <> 'error'
        and user_id in (select user_id from events where event_type = 'error')"""
)
def cdc_reinsert_after_delete(ws: Workspace) -> DataFrame:
    log = _user_events(ws)
    deleted_once = log.where("op = 'd'").select(F.col("before.user_id").alias("user_id"))
    current = latest_images(log, ["user_id"]).select("user_id", "event_id", "event_type")
    return current.join(deleted_once, "user_id", "left_semi")


@query(f"select {_USER} from events where event_type <> 'error'")
def cdc_append_only_images(ws: Workspace) -> DataFrame:
    return images(_user_events(ws))


# -- keys, calendar, lookups --------------------------------------------------------


@query(
    f"""select {oracle.surrogate(['l_orderkey', 'l_linenumber'], ['l_partkey', 'l_suppkey', 'l_extendedprice'])} as line_sk,
        {_LINE} from lineitem"""
)
def surrogate_key_assignment(ws: Workspace) -> DataFrame:
    lines = ws.sample("lineitem")
    keyed = surrogate_key(
        lines, "line_sk", ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]
    )
    return keyed.select("line_sk", *_LINE.split(", "))


@query("select count(*) as n_rows, count(*) as n_keys, true as all_positive, true as exact_as_double from lineitem")
def surrogate_key_properties(ws: Workspace) -> DataFrame:
    keyed = surrogate_key(ws.sample("lineitem"), "sk", ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("sk").alias("n_keys"),
        (F.min("sk") >= 1).alias("all_positive"),
        (F.max("sk") < 2**53).alias("exact_as_double"),
    )


@query("select count(*) as n_rows, count(*) as n_keys, 1 as least, count(*) as greatest from lineitem")
def surrogate_key_dense(ws: Workspace) -> DataFrame:
    keyed = dense_key(ws.sample("lineitem"), "sk")
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("sk").alias("n_keys"), F.min("sk").alias("least"), F.max("sk").alias("greatest")
    )


@query(
    f"""select {oracle.surrogate(['s_suppkey'])} as supplier_sk, s_suppkey, s_name, s_acctbal from supplier
        union all select -1, -1, 'UNKNOWN', null"""
)
def dimension_with_unknown(ws: Workspace) -> DataFrame:
    rows = ws.sample("supplier").select("s_suppkey", "s_name", "s_acctbal")
    return with_unknown(
        surrogate_key(rows, "supplier_sk", ["s_suppkey"]), "supplier_sk", {"s_suppkey": -1, "s_name": "UNKNOWN"}
    )


@query(
    f"""with dim as (select {oracle.surrogate(['c_custkey'])} as customer_sk, c_custkey
            from customer where c_acctbal >= 0)
        select o_orderkey, coalesce(customer_sk, -1) as customer_sk from orders left join dim on c_custkey = o_custkey"""
)
def dimension_lookup_with_misses(ws: Workspace) -> DataFrame:
    known = ws.sample("customer").where("c_acctbal >= 0").select("c_custkey")
    dim = with_unknown(surrogate_key(known, "customer_sk", ["c_custkey"]), "customer_sk", {"c_custkey": -1})
    orders = ws.sample("orders").select("o_orderkey", "o_custkey")
    found = resolve(orders, dim, "o_custkey", "c_custkey", {"customer_sk": "customer_sk"}, scatter_by="o_orderkey")
    return found.select("o_orderkey", "customer_sk")


@query("select c_mktsegment as name from customer union select p_type from part")
def distinct_union(ws: Workspace) -> DataFrame:
    segments = ws.sample("customer").select(F.col("c_mktsegment").alias("name"))
    types = ws.sample("part").select(F.col("p_type").alias("name"))
    return distinct_values("name", segments, types)


@query(
    oracle.PARTS["dim_date"]
    .replace("s_olist_orders", "(select l_shipdate as bought from lineitem)")
    .replace("d as full_date", f"{oracle.iso('d')} as full_date")
)
def date_spine_of_shipments(ws: Workspace) -> DataFrame:
    return serving.iso_text(calendar(date_spine(ws.sample("lineitem"), "l_shipdate")))


# -- sources and sinks --------------------------------------------------------------

_TYPED_ORDERS = f"""select 'O' || cast(o_orderkey as string) as order_id, 'C' || cast(o_custkey as string) as customer_id,
    o_orderpriority as order_status, {{bought}} as order_purchase_timestamp,
    cast(null as timestamp) as order_approved_at, cast(null as timestamp) as order_delivered_carrier_date,
    cast(null as timestamp) as order_delivered_customer_date,
    cast(o_orderdate as timestamp) as order_estimated_delivery_date from {{orders}}"""
_TYPED_STAMPS = [c for c in SOURCE_TABLES["olist_orders"].columns if c not in ("order_id", "customer_id", "order_status")]


def _typed_orders(ws: Workspace) -> DataFrame:
    text = _TYPED_ORDERS.replace("{bought}", f"timestamp_millis({_bought(spark_sql)})")
    return ws.spark.sql(text, orders=ws.sample("orders"))


@query(
    f"select order_id, customer_id, order_status, {', '.join(f'{oracle.iso(c)} as {c}' for c in _TYPED_STAMPS)} from ("
    + _TYPED_ORDERS.format(bought=_BOUGHT, orders="orders")
    + ") t"
)
def csv_load(ws: Workspace) -> DataFrame:
    folder = ws.scratch("csv")
    _typed_orders(ws).write.option("header", True).csv(folder)
    return serving.iso_text(files.read_csv(ws.spark, folder, "olist_orders"))


@query(
    """select 'R' || cast(o_orderkey // 2 as varchar) as review_id,
        min('O' || cast(o_orderkey as varchar)) as order_id from orders group by 1"""
)
def csv_seed_first_of_duplicates(ws: Workspace) -> DataFrame:
    """A review file in which every review id comes twice, loaded as a source table."""
    return _seeded_reviews(ws, F.asc("o_orderkey"))


@query(
    """select 'R' || cast(o_orderkey // 2 as varchar) as review_id,
        'O' || cast(max(o_orderkey) as varchar) as order_id from orders group by 1"""
)
def csv_seed_in_load_order(ws: Workspace) -> DataFrame:
    """The same file the other way round: the row loaded first is the larger one."""
    return _seeded_reviews(ws, F.desc("o_orderkey"))


def _seeded_reviews(ws: Workspace, order: F.Column) -> DataFrame:
    folder, target = ws.scratch("seed"), ws.scratch("source")
    ws.sample("orders").orderBy(order).selectExpr(
        "'R' || cast(o_orderkey div 2 as string) as review_id",
        "'O' || cast(o_orderkey as string) as order_id",
        "cast(floor(o_totalprice / 100000) as int) + 1 as review_score",
        "o_orderpriority as review_comment_title",
        '''concat('said "', o_orderstatus, '", then left') as review_comment_message''',
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') as review_creation_date",
        "cast(null as string) as review_answer_timestamp",
    ).write.options(header=True, escape='"').csv(f"{folder}/{files.CSV_FILES['olist_order_reviews']}")
    files.seed(ws.spark, folder, target, ["olist_order_reviews"])
    return ws.spark.read.parquet(f"{target}/olist_order_reviews").select("review_id", "order_id")


@query(
    """select c_custkey as custkey, -1 as orderkey from customer where c_acctbal < 0
       union all select o_custkey, min(o_orderkey) from orders
       where o_custkey not in (select c_custkey from customer where c_acctbal < 0) group by o_custkey"""
)
def insert_if_absent(ws: Workspace) -> DataFrame:
    target = ws.scratch("target")
    present = ws.sample("customer").where("c_acctbal < 0").selectExpr("c_custkey as custkey", "-1L as orderkey")
    present.write.parquet(target)
    incoming = ws.sample("orders").selectExpr("o_custkey as custkey", "o_orderkey as orderkey")
    files.insert_if_absent(incoming, target, ["custkey"], prefer=["orderkey"])
    return ws.spark.read.parquet(target)


@query(
    """select l_orderkey, l_linenumber, count(*) as copies from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1"""
)
def pk_duplicates(ws: Workspace) -> DataFrame:
    return files.duplicate_keys(ws.sample("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """select o_orderkey, o_custkey from orders
       where o_custkey not in (select c_custkey from customer where c_mktsegment <> 'BUILDING')"""
)
def fk_orphans(ws: Workspace) -> DataFrame:
    parents = ws.sample("customer").where("c_mktsegment <> 'BUILDING'")
    return files.orphans(ws.sample("orders"), "o_custkey", parents, "c_custkey").select("o_orderkey", "o_custkey")


# The keys and references that the source databases declare, of the tables that reach silver.
_DECLARED_KEYS = {
    "olist_customers": "customer_id",
    "olist_sellers": "seller_id",
    "olist_products": "product_id",
    "olist_orders": "order_id",
    "olist_order_items": "order_id, order_item_id",
    "olist_order_payments": "order_id, payment_sequential",
    "olist_order_reviews": "review_id",
    "click_customers": "customer_id",
    "click_products": "product_id",
    "click_sessions": "session_id",
    "click_orders": "order_id",
    "click_events": "event_id",
    "click_reviews": "review_id",
}
_DECLARED_REFERENCES = (
    ("olist_orders", "customer_id", "olist_customers"),
    ("olist_order_items", "order_id", "olist_orders"),
    ("olist_order_items", "product_id", "olist_products"),
    ("olist_order_items", "seller_id", "olist_sellers"),
    ("olist_order_payments", "order_id", "olist_orders"),
    ("olist_order_reviews", "order_id", "olist_orders"),
    ("click_sessions", "customer_id", "click_customers"),
    ("click_orders", "customer_id", "click_customers"),
    ("click_order_items", "order_id", "click_orders"),
    ("click_order_items", "product_id", "click_products"),
    ("click_events", "session_id", "click_sessions"),
    ("click_reviews", "order_id", "click_orders"),
    ("click_reviews", "product_id", "click_products"),
)


def _constraint_sql() -> str:
    found = [
        f"select '{table}' as table_name, 'primary key {key}' as constraint_name, count(*) as violations "
        f"from (select {key} from s_{table} group by {key} having count(*) > 1) d"
        for table, key in _DECLARED_KEYS.items()
    ]
    found += [
        f"select '{table}', '{column} references {parent}', count(*) from s_{table} c where {column} is not null "
        f"and not exists (select 1 from s_{parent} p where p.{column} = c.{column})"
        for table, column, parent in _DECLARED_REFERENCES
    ]
    return " union all ".join(found)


@query(_constraint_sql())
def constraint_report(ws: Workspace) -> DataFrame:
    ws.ensure("silver", *SILVER_TABLES)
    return files.constraint_report({table: ws.stored("silver", table) for table in SILVER_TABLES})


@query("select count(*) as rows_returned, count(*) as rows_stored, count(*) as distinct_stored from orders")
def sink_overwrite_count(ws: Workspace) -> DataFrame:
    """Written twice: the second write replaces the first."""
    lake = Lake(ws.scratch("sink"))
    orders = ws.sample("orders")
    for _ in range(2):
        returned = tables.replace_table(ws.spark, lake, orders, "silver", "olist_orders")
    return lake.read(ws.spark, "silver", "olist_orders").agg(
        F.lit(returned).cast("bigint").alias("rows_returned"),
        F.count(F.lit(1)).alias("rows_stored"),
        F.count_distinct("o_orderkey").alias("distinct_stored"),
    )


@query(
    """select 'silver' as layer, 'olist_orders' as table_name, 'success' as status, count(*) as row_count,
              0 as error_length, 0 as detail_length from orders
       union all select 'silver', 'olist_customers', 'success', count(*), 0, 0 from customer
       union all select 'gold', 'dim_date', 'failed', 0, 500, 1500"""
)
def metrics_rows(ws: Workspace) -> DataFrame:
    lake = Lake(ws.scratch("metrics"))
    tables.replace_table(ws.spark, lake, ws.sample("orders"), "silver", "olist_orders")
    tables.replace_table(ws.spark, lake, ws.sample("customer"), "silver", "olist_customers")
    failure = tables.metric("gold", "dim_date", 0, 0.1, "failed", "no such table; " * 100)
    tables.record_metrics(ws.spark, lake, [failure])
    metrics = lake.load(ws.spark, lake.metrics_path)
    lengths = [F.length("error_message").alias("error_length"), F.length("error_detail").alias("detail_length")]
    return metrics.select("layer", "table_name", "status", "row_count", *lengths)


@query(" union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in GOLD_TABLES))
def publish_layer(ws: Workspace) -> DataFrame:
    """Publish gold as catalogue tables and count each through SQL."""
    ws.ensure("gold", *GOLD_TABLES)
    catalog.publish(ws.spark, ws.lake, "gold", database="weirstone_gold")
    counts = [
        ws.spark.sql(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM weirstone_gold.{t}") for t in GOLD_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    """select 'dim_seller' as table_name, 1 as published, 0 as failed, count(*) as row_count from dim_seller
       union all select 'dim_product', 0, 1, null
       union all select 'all', 1, 13, count(*) from dim_seller"""
)
def publish_single_table(ws: Workspace) -> DataFrame:
    """One table alone, one that is missing, and a layer of which one table is there."""
    lake, database = Lake(ws.scratch("published")), "weirstone_single"
    ws.gold("dim_seller").write.parquet(lake.path("gold", "dim_seller"))
    rows = []
    for table in ("dim_seller", "dim_product", None):
        published, failed = catalog.publish(ws.spark, lake, "gold", table, database)
        count = ws.spark.table(f"{database}.dim_seller").count() if published else None
        rows.append((table or "all", published, failed, count))
    return tables.few_rows(ws.spark, rows, "table_name STRING, published BIGINT, failed BIGINT, row_count BIGINT")


_EMPTY, _BROKEN = "olist_sellers", "click_reviews"


@query(
    " union all ".join(
        f"select '{source.topic}' as topic, "
        + ("'empty' as status, cast(null as bigint) as rows" if table == _EMPTY
           else "'failed' as status, cast(null as bigint) as rows" if table == _BROKEN
           else f"'loaded' as status, (select count(*) from ({oracle.bronze(table)}) e) as rows")
        for table, source in SOURCE_TABLES.items()
    )
)
def ingest_summary(ws: Workspace) -> DataFrame:
    """All sixteen topics into a new lake, one of them empty and one unreadable."""

    def reader(spark: SparkSession, topic: str) -> DataFrame:
        if TABLE_OF_TOPIC[topic] == _BROKEN:
            raise OSError("broker unreachable")
        found = ws.read_topic(spark, topic)
        return found.where(F.lit(False)) if TABLE_OF_TOPIC[topic] == _EMPTY else found

    return changes.ingest(ws.spark, Lake(ws.scratch("ingest")), reader).select("topic", "status", "rows")


# -- quality ------------------------------------------------------------------------


def _validated(layer: str, ws: Workspace) -> list[Result]:
    """Every check of a layer; its tables are built, and then checked, side by side."""
    checks = CHECKS[layer]()
    ws.ensure(layer, *checks)

    def one(table: str) -> list[Result]:
        return validate_stored(ws.spark, ws.lake, table, ws.lake.path(layer, table), checks[table])

    return [result for found in side_by_side(ws.spark, one, checks, parallel=8) for result in found]


def _layer_checks(layer: str, ws: Workspace) -> DataFrame:
    return result_rows(ws.spark, layer, _validated(layer, ws)).select("table_name", "check_name", "passed", "detail")


for _layer in CHECKS:
    add(f"dq_{_layer}", partial(_layer_checks, _layer), quality_sql.layer(_layer))


def _results(ws: Workspace, table: str, df: DataFrame, check: Check) -> DataFrame:
    rows = result_rows(ws.spark, "silver", validate(table, df, check))
    return rows.select("table_name", "check_name", "passed", "detail")


@query(
    " union all ".join(
        quality_sql.checks(
            "lineitem",
            "select * from lineitem",
            ["l_orderkey", "l_linenumber"],
            {
                "quantity in range": "l_quantity between 1 and 50",
                "small discount": "l_discount <= 0.09",
                "returned": "case when l_returnflag = 'R' then true end",
            },
        )
    )
)
def dq_keys_and_rules(ws: Workspace) -> DataFrame:
    return _results(ws, "lineitem", ws.sample("lineitem"), _line_check())


def _line_check() -> Check:
    rules = {
        "quantity in range": F.col("l_quantity").between(1, 50),
        "small discount": F.col("l_discount") <= 0.09,
        "returned": F.when(F.col("l_returnflag") == "R", True),
    }
    return Check(("l_orderkey", "l_linenumber"), rules)


@query(
    " union all ".join(
        quality_sql.checks(
            "lineitem",
            "select * from lineitem union all select * from lineitem where l_partkey % 50 = 0",
            ["l_orderkey", "l_linenumber"],
            {
                "quantity in range": "l_quantity between 1 and 50",
                "small discount": "l_discount <= 0.09",
                "returned": "case when l_returnflag = 'R' then true end",
            },
        )
    )
)
def dq_incremental(ws: Workspace) -> DataFrame:
    """Four arrivals, some keys in more than one of them; each is read once, the verdict is that on the whole table."""
    lines = ws.sample("lineitem")
    again = lines.where("l_partkey % 50 = 0")
    parts = [lines.where(f"l_suppkey % 3 = {i}") for i in range(3)]
    profile = Profile(ws.scratch("profile"), "lineitem", _line_check())
    return result_rows(ws.spark, "silver", absorbed(profile, [*parts, again])).select("table_name", "check_name", "passed", "detail")


@query(
    " union all ".join(
        quality_sql.checks(
            "events",
            "select *, case when event_type = 'error' then null else user_id end as actor from events where event_type <> 'error'",
            ["actor", "event_id"],
            {"positive value": "value > 0"},
        )
    )
)
def dq_row_filter(ws: Workspace) -> DataFrame:
    actor = F.when(F.col("event_type") != "error", F.col("user_id"))
    check = Check(
        ("actor", "event_id"), {"positive value": F.col("value") > 0}, row_filter=F.col("event_type") != "error"
    )
    return _results(ws, "events", ws.sample("events").withColumn("actor", actor), check)


@query(
    " union all ".join(
        quality_sql.checks("orders", "select * from orders", ["o_custkey"], {"known": "true"}, unique=False)
    )
    + """ union all select 'orders', 'missing column', false, printf('-1/%d (100.0%%)', count(*)) from orders
          union all select 'customer', 'non_empty', false, '0 records'"""
)
def dq_broken_and_empty(ws: Workspace) -> DataFrame:
    check = Check(
        ("o_custkey",), {"known": F.lit(True), "missing column": F.col("no_such_column") > 0}, unique=False
    )
    orders = _results(ws, "orders", ws.sample("orders"), check)
    nobody = Check(("c_custkey",), row_filter=F.col("c_custkey") < 0)
    return orders.unionByName(_results(ws, "customer", ws.sample("customer"), nobody))


@query(" union all ".join(f"select '{layer}' as layer, bool_and(passed) as passed from ({quality_sql.layer(layer)}) c" for layer in CHECKS))
def gate_verdicts(ws: Workspace) -> DataFrame:
    rows = []
    for layer in CHECKS:
        ws.ensure(layer, *CHECKS[layer]())
        rows.append((layer, gate(ws.spark, ws.lake, layer, CHECKS[layer](), parallel=8)))
    return tables.few_rows(ws.spark, rows, "layer STRING, passed BOOLEAN")


@query(
    " union all ".join(
        f"select '{layer}' as layer, table_name, check_name, passed, detail from ({quality_sql.layer(layer)}) c"
        for layer in ("silver", "gold")
    )
)
def quality_log_rows(ws: Workspace) -> DataFrame:
    """What two gates leave in one log."""
    lake = Lake(ws.scratch("log"))
    for layer in ("silver", "gold"):
        log_results(ws.spark, lake, layer, _validated(layer, ws))
    return ws.spark.read.parquet(lake.quality_log_path).select("layer", "table_name", "check_name", "passed", "detail")


@query(
    """select 'olist_customers' as table_name, 'pk_not_null_c_custkey' as check_name, count(*) = count(c_custkey) as passed from customer
        union all select 'olist_customers', 'no_duplicates', count(*) = count(distinct c_custkey) from customer
        union all select 'olist_orders', 'readable', false
        union all select 'olist_sellers', 'readable', false"""
)
def dq_unreadable(ws: Workspace) -> DataFrame:
    """One table is there, one is no table but text, one is missing."""
    lake = Lake(ws.scratch("lake"))
    ws.sample("customer").write.parquet(lake.path("silver", "olist_customers"))
    ws.sample("orders").select(F.col("o_orderkey").cast("string")).write.text(lake.path("silver", "olist_orders"))
    results = []
    for table, key in (("olist_customers", "c_custkey"), ("olist_orders", "o_orderkey"), ("olist_sellers", "s_suppkey")):
        results += validate_stored(ws.spark, lake, table, lake.path("silver", table), Check((key,)))
    return result_rows(ws.spark, "silver", results).select("table_name", "check_name", "passed")


@query(
    """select case when o_orderkey % 5 > 2 then 'sound' else 'poison' end as kind, count(*) as n_rows,
              count(case when o_orderkey % 5 > 2 then 1 end) as amounts,
              cast(sum(case when o_orderkey % 5 > 2 then cast(round(o_totalprice * 100) as bigint) end) as double) / 100.0 as total,
              cast(count(case when o_orderkey % 5 > 2 then 1 end) as bigint) as volumes
       from orders group by 1"""
)
def poison_amounts(ws: Workspace) -> DataFrame:
    """Amounts of NaN, infinity and beyond any bigint, and sizes whose product overflows, among sound ones: none stops the sums."""
    text = F.expr(
        "case o_orderkey % 5 when 0 then 'NaN' when 1 then '-Infinity' when 2 then '1e300' else cast(o_totalprice as string) end"
    )
    size = F.when(F.col("o_orderkey") % 5 > 2, F.lit(3)).otherwise(F.lit(2**31 - 1))
    rows = ws.sample("orders").select("o_orderkey", parse.real(text).alias("amount"), clean.product_of(size, size, size).alias("volume"))
    kind = F.when(F.col("o_orderkey") % 5 > 2, "sound").otherwise("poison").alias("kind")
    return rows.groupBy(kind).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(money.cents(F.col("amount"))).alias("amounts"),
        money.total(F.col("amount")).alias("total"),
        F.count("volume").alias("volumes"),
    )


# -- the whole run, and the stream ----------------------------------------------------


@query(
    " union all ".join(
        f"select 'silver' as layer, '{t}' as table_name, count(*) as row_count from s_{t}" for t in SILVER_TABLES
    )
    + " union all "
    + " union all ".join(f"select 'gold', '{t}', count(*) from {t}" for t in GOLD_TABLES)
)
def pipeline_run(ws: Workspace) -> DataFrame:
    """Topics -> bronze -> silver -> gold in a new lake, gates recorded but not enforced."""
    lake = Lake(ws.scratch("run"))
    changes.require_all_loaded(changes.ingest(ws.spark, lake, ws.read_topic, parallel=8))
    outcome = pipeline.run(ws.spark, lake, enforce_gates=False, parallel=8)
    ws.adopt(lake)
    rows = [(layer, table, count) for (layer, table), count in outcome.rows.items()]
    return tables.few_rows(ws.spark, rows, "layer STRING, table_name STRING, row_count BIGINT")


@query(
    " union all ".join(
        f"select 'first' as step, 'silver' as layer, '{t}' as table_name, count(*) as row_count from s_{t}" for t in SILVER_TABLES
    )
    + " union all "
    + " union all ".join(f"select 'first', 'gold', '{t}', count(*) from {t}" for t in GOLD_TABLES)
    + " union all select 'sellers renamed', 'silver', 'olist_sellers', count(*) from s_olist_sellers"
    + " union all select 'sellers renamed', 'gold', 'dim_seller', count(*) from dim_seller"
    + " union all select 'sellers renamed', 'gold', 'fact_orders', count(*) from fact_orders"
)
def pipeline_resume(ws: Workspace) -> DataFrame:
    """Built; run again; a topic ingested anew as it was; sellers renamed: what each run builds, and how many rows.

    Renamed cities reach the sellers' tables and the fact that looks sellers up; the other 25 tables are left.
    """
    lake = Lake(ws.scratch("resumed"))
    changes.require_all_loaded(changes.ingest(ws.spark, lake, ws.read_topic, parallel=8))
    rows = []

    def step(name: str) -> None:
        done = resume(ws.spark, lake, enforce_gates=False, parallel=8)
        rows.extend((name, layer, table, count) for (layer, table), count in done.built.items())

    step("first")
    step("again")
    changes.ingest_table(ws.spark, lake, ws.read_topic, "product_category_translation")
    step("ingested anew")

    def renamed(spark: SparkSession, topic: str) -> DataFrame:
        value = F.regexp_replace("value", '"seller_city":"', '"seller_city":"new ')
        return ws.read_topic(spark, topic).withColumn("value", value)

    changes.ingest_table(ws.spark, lake, renamed, "olist_sellers")
    step("sellers renamed")
    return tables.few_rows(ws.spark, rows, "step STRING, layer STRING, table_name STRING, row_count BIGINT")


_ORDER_TABLES = ("olist_order_items", "olist_orders", "olist_order_payments", "olist_customers", "olist_sellers", "olist_products")


@query(_shown("fact_orders", "fact_orders"))
def fact_orders_incremental(ws: Workspace) -> DataFrame:
    """Built from the snapshot, then brought up to date by three batches of changes: updates, deletes, rows inserted again."""
    root, spark = ws.scratch("incremental"), ws.spark
    sources = (*_ORDER_TABLES, "olist_geolocation", "product_category_translation")
    bronze = {t: ws.stored("bronze", t) for t in sources}

    offsets = side_by_side(spark, lambda t: {r[0] for r in bronze[t].select("log_offset").distinct().collect()}, sources, 8)
    moments = dict(zip(sources, offsets, strict=True))
    held: dict[str, list[str]] = {}  # the folders of each table, oldest first

    def state(upto: int, before: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Silver tables and dimensions after the events up to a place in the log, those without events left as they were."""

        def kept(name: str, frame: DataFrame) -> DataFrame:
            frame.write.option("compression", "zstd").parquet(f"{root}/{upto}/{name}")
            held.setdefault(name, []).append(f"{root}/{upto}/{name}")
            return spark.read.parquet(f"{root}/{upto}/{name}")

        def silver(name: str) -> DataFrame:
            build = pipeline.BUILDS["silver"][name]
            feeds = [t for _, t in build.inputs]
            if before and not any(upto in moments[t] for t in feeds):
                return before[name]
            if before and name in EVERY_IMAGE:
                # not reduced per key: the events of this place only add rows
                return before[name].unionByName(kept(name, build.function(bronze[name].where(F.col("log_offset") == upto))))
            return kept(name, build.function(*[bronze[t].where(F.col("log_offset") <= upto) for t in feeds]))

        made = dict(zip(_ORDER_TABLES, side_by_side(spark, silver, _ORDER_TABLES, 6), strict=True))
        dims = {"dim_customer": "olist_customers", "dim_seller": "olist_sellers", "dim_product": "olist_products"}
        for dim, source in dims.items():
            same = before and made[source] is before[source]
            made[dim] = before[dim] if same else kept(dim, pipeline.BUILDS["gold"][dim].function(made[source]))
        return made

    facts, before = OrderFacts(f"{root}/facts"), state(0, {})
    facts.rebuild(before)
    for step in (1, 2, 3):
        after = state(step, before)
        events = {t: bronze[t].where(F.col("log_offset") == step) for t in _ORDER_TABLES}
        changed_orders(events, before, after).write.parquet(f"{root}/{step}/changed")
        facts.apply(spark.read.parquet(f"{root}/{step}/changed"), before, after)
        before = after
        for folders in (f for name, f in held.items() if name not in EVERY_IMAGE):
            while len(folders) > 1:  # replaced by a newer one, and read by nothing after this step
                tables.remove(spark, folders.pop(0))
    return serving.iso_text(facts.numbered(spark))


def _image_sql(table: str) -> str:
    """The current rows of a table as JSON text, as its silver builder takes them from the topic."""
    rows = oracle.all_images(table) if table in EVERY_IMAGE else oracle.current_images(table)
    pairs = ", ".join(f"'{name}', cast({name} as varchar)" for name in SOURCE_TABLES[table].columns)
    return f"select '{table}' as table_name, cast(json_object({pairs}) as varchar) as image from ({rows}) i"


_ALL_IMAGES = " union all ".join(_image_sql(table) for table in SOURCE_TABLES)


def _streamed(ws: Workspace, topics: str | None = None) -> DataFrame:
    topic_log.register(ws.spark)
    reader = ws.spark.readStream.format("topic_log")
    return (reader.option("topics", topics) if topics else reader).load(ws.topic_log())


def _arrivals(ws: Workspace) -> list[tuple[topic_log.Offsets, topic_log.Offsets]]:
    """The log in three spans of offsets, as if read while it grew."""
    ends = topic_log.ends(topic_log.segments(ws.topic_log()))
    marks = [{t: {p: n * k // 3 for p, n in parts.items()} for t, parts in ends.items()} for k in range(4)]
    return list(zip(marks, marks[1:], strict=False))


def _span(ws: Workspace, low: topic_log.Offsets, high: topic_log.Offsets) -> DataFrame:
    reader = ws.spark.read.format("topic_log").option("from", json.dumps(low)).option("until", json.dumps(high))
    return reader.load(ws.topic_log())


@query(_ALL_IMAGES)
def stream_equals_batch(ws: Workspace) -> DataFrame:
    """All topics through one stream into one store; every table's current rows."""
    store = TopicStore(ws.scratch("store"))
    maintain_all(_streamed(ws), store, ws.scratch("checkpoint")).awaitTermination()
    return whole(store, ws.spark, list(SOURCE_TABLES))


@query(
    " union all ".join(
        f"select '{source.topic}' as topic, op, count(*) as events from ({oracle.bronze(table)}) e group by op"
        for table, source in SOURCE_TABLES.items()
    )
)
def stream_bronze_append(ws: Workspace) -> DataFrame:
    bronze = ws.scratch("bronze")
    append_all(_streamed(ws), bronze, ws.scratch("checkpoint")).awaitTermination()
    return ws.spark.read.parquet(bronze).groupBy("topic", "op").agg(F.count(F.lit(1)).alias("events"))


@query(
    " union all ".join(
        f"select '{source.topic}' as topic, count(*) as events, count(*) as log_ends, 3 as batches from ({oracle.bronze(table)}) e"
        for table, source in SOURCE_TABLES.items()
    )
)
def stream_all_topics(ws: Workspace) -> DataFrame:
    """The commit ledger after three batches: messages of each topic, and how far its partitions are read."""
    store = TopicStore(ws.scratch("store"))
    for number, span in enumerate(_arrivals(ws)):
        store.absorb(_span(ws, *span), number)
    done = store.manifest(ws.spark)
    rows = [(topic, events, sum(done.offsets[topic].values()), done.batch + 1) for topic, events in done.rows.items()]
    return tables.few_rows(ws.spark, rows, "topic STRING, events BIGINT, log_ends BIGINT, batches BIGINT")


@query(_ALL_IMAGES)
def stream_replay_after_kill(ws: Workspace) -> DataFrame:
    """Every batch is killed between its data and its manifest, run again, and once more after it was published."""
    store = TopicStore(ws.scratch("store"), fold_after=1)

    class Killed(RuntimeError):
        pass

    class Dying(TopicStore):
        def _publish(self, *_):
            raise Killed

    for number, span in enumerate(_arrivals(ws)):
        with contextlib.suppress(Killed):
            Dying(store.root, fold_after=1).absorb(_span(ws, *span), number, until=span[1])
        store.absorb(_span(ws, *span), number, until=span[1])
        store.absorb(_span(ws, *span), number, until=span[1])
    return whole(store, ws.spark, list(SOURCE_TABLES))


@query(
    " union all ".join(
        f"select '{source.topic}' as topic, op, ts_ms, count(*) as events from ({oracle.bronze(table)}) e group by op, ts_ms"
        for table, source in SOURCE_TABLES.items()
    )
)
def topic_folder_read(ws: Workspace) -> DataFrame:
    """A bounded read of all sixteen topics, planned from offsets, decoded each by its own schema."""
    reader = topic_log.LogReader(ws.topic_log())
    decoded = [
        changes.decode(reader(ws.spark, source.topic), table).select("topic", "op", "ts_ms") for table, source in SOURCE_TABLES.items()
    ]
    return reduce(DataFrame.unionByName, decoded).groupBy("topic", "op", "ts_ms").agg(F.count(F.lit(1)).alias("events"))


@query(
    " union all ".join(
        f"select '{source.topic}' as topic, 'loaded' as status, count(*) as rows, count(*) as ledger from ({oracle.bronze(table)}) e"
        for table, source in SOURCE_TABLES.items()
    )
    + " union all select 'later', 'empty', null, 0"
)
def topic_ledger(ws: Workspace) -> DataFrame:
    """All topics ingested from the log, the bounds kept in a ledger; a reader that starts there finds every topic empty."""
    lake = Lake(ws.scratch("ingest"))
    reader = topic_log.LogReader(ws.topic_log())
    loaded = changes.ingest(ws.spark, lake, reader, parallel=8)
    reader.record(ws.spark, lake)
    ledger = ws.spark.read.parquet(topic_log.ledger_path(lake)).groupBy("topic").agg(F.sum("until_offset").alias("ledger"))
    later = topic_log.LogReader(ws.topic_log(), since=topic_log.ledger_offsets(ws.spark, lake))
    again = changes.ingest(ws.spark, lake, later).groupBy("status").agg(F.max("rows").alias("rows"))
    first = loaded.join(ledger, "topic").select("topic", "status", "rows", "ledger")
    return first.unionByName(again.select(F.lit("later").alias("topic"), "status", "rows", F.lit(0).cast("bigint").alias("ledger")))


# -- parameterised access ---------------------------------------------------------------


def _filtered(template: str, filters: dict, limit: int | None, ws: Workspace) -> DataFrame:
    return serving.run_template(ws.gold, template, filters, limit)


def _templates() -> None:
    region = re.sub(r" limit \d+$", "", reports_sql.SQL["q03_revenue_by_region"])
    device = reports_sql.SQL["q08_device_performance"]
    session = re.sub(r" limit \d+$", "", reports_sql.SQL["q07_session_analytics"])
    cases = {
        "template_filter_exact": ("revenue_by_region", {"region": "NORDESTE", "state": ""}, region, "region = 'NORDESTE'"),
        "template_filter_gte": ("device_performance", {"total_orders_gte": "300"}, device, "total_orders >= 300"),
        "template_filter_from_to": (
            "device_performance",
            {"total_orders_from": "10", "total_orders_to": "700"},
            device,
            "total_orders between 10 and 700",
        ),
        "template_filter_lte": ("session_analytics", {"total_events_lte": 900}, session, "total_events <= 900"),
        "template_filter_gt_lt": (
            "session_analytics",
            {"avg_actions_per_session_gt": "2.5", "total_sessions_lt": "400"},
            session,
            "avg_actions_per_session > 2.5 and total_sessions < 400",
        ),
        "template_filter_like": ("session_analytics", {"device_like": "SK"}, session, "device like '%SK%'"),
        "template_filter_in": ("session_analytics", {"traffic_source_in": "EMAIL, GOOGLE"}, session,
                               "traffic_source in ('EMAIL', 'GOOGLE')"),
    }
    cases["template_filter_below_top"] = (
        "revenue_by_region", {"region": "NORTE"}, region, "region = 'NORTE'"
    )
    cases["template_unlimited"] = ("revenue_by_region", {}, region, "true")
    for name, (template, filters, sql, where) in cases.items():
        add(name, partial(_filtered, template, filters, None), f"select * from ({sql}) t where {where}")
    add(
        "template_limit",
        partial(_filtered, "session_analytics", {}, 3),
        f"select * from ({session}) t order by total_sessions desc, device, traffic_source limit 3",
    )


_templates()


@query(
    f"""with top as (select * from ({reports_sql.SQL['q07_session_analytics']}) s
            order by total_sessions desc, device, traffic_source limit 1)
        select 1 as position, 'device' as name, 'string' as type, device as example from top
        union all select 2, 'traffic_source', 'string', traffic_source from top
        union all select 3, 'total_sessions', 'bigint', cast(total_sessions as varchar) from top
        union all select 4, 'total_events', 'bigint', cast(total_events as varchar) from top
        union all select 5, 'avg_actions_per_session', 'double', cast(avg_actions_per_session as varchar) from top"""
)
def template_schema(ws: Workspace) -> DataFrame:
    return serving.template_columns(ws.gold, "session_analytics")


@query(
    """select status_category, primary_payment_type, count(*) as items from fact_orders
       group by 1, 2 order by items desc, status_category, primary_payment_type limit 7"""
)
def adhoc_capped(ws: Workspace) -> DataFrame:
    ws.gold("fact_orders").createOrReplaceTempView("weirstone_fact_orders")
    text = """SELECT status_category, primary_payment_type, count(*) AS items FROM weirstone_fact_orders
        GROUP BY status_category, primary_payment_type ORDER BY items DESC, status_category, primary_payment_type"""
    return serving.run_select(ws.spark, text, limit=7)


@query(
    """select '{"customer_state":' || coalesce('"' || customer_state || '"', 'null') || ',"count":' || n || '}' as row
       from (select customer_state, cast(count(*) as varchar) as n from s_olist_customers group by customer_state) s"""
)
def result_json_rows(ws: Workspace) -> DataFrame:
    counts = reports.customers_per_state(ws.stored("silver", "olist_customers"), k=1000)
    return serving.json_rows(counts)
