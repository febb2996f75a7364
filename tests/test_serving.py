"""Templates, filters, ad-hoc SELECT, output shape - and reports on hand-made gold tables."""

from datetime import date, datetime

import pytest

from weirstone.plans import reports, serving


@pytest.fixture()
def gold(spark):
    frames = {
        "dim_date": [(20240101, "2024-01"), (20240201, "2024-02")],
        "dim_product": [(-1, "UNKNOWN", "UNKNOWN"), (1, "p1", "toys"), (2, "p2", "tools")],
        "dim_customer": [(-1, "OUTROS", "UNKNOWN"), (1, "SUL", "PR"), (2, "NORTE", "AM")],
        "fact_orders": [
            ("o1", 20240101, 1, 1, 10.0, 1.0, 11.0),
            ("o1", 20240101, 1, 1, 10.0, 1.0, 11.0),
            ("o2", 20240201, 2, 2, 5.0, 0.5, 5.5),
            ("o3", 20990101, -1, 2, 7.0, 0.5, 7.5),
        ],
        "fact_reviews": [
            ("o1", 20240101, 5, 1, 0, 0),
            ("o1", 20240101, 2, 0, 0, 1),
            ("o2", 20240201, 3, 0, 1, 0),
            ("o2", 20990101, None, 0, 0, 0),
        ],
        "dim_device": [(-1, "UNKNOWN"), (1, "MOBILE"), (2, "TV")],
        "dim_traffic_source": [(-1, "UNKNOWN"), (1, "ADS")],
        "fact_sessions": [(11, 1, 1), (12, 1, 1), (13, 2, 1), (14, -1, -1)],
        "fact_clickstream_events": [
            (1, 11, "PAGE_VIEW"), (2, 11, "PURCHASE"), (3, 11, "PAGE_VIEW"), (4, 12, "PAGE_VIEW"), (5, 13, "CLICK"),
            (6, -1, "PAGE_VIEW"),
        ],
    }
    schemas = {
        "dim_date": "date_sk int, year_month string",
        "dim_product": "product_sk long, product_id string, product_category_name_english string",
        "dim_customer": "customer_sk long, customer_region string, customer_state string",
        "fact_orders": "order_id string, date_sk int, customer_sk long, product_sk long, unit_price double, freight_value double, total_item_value double",
        "fact_reviews": "order_id string, date_sk int, review_score int, is_positive int, is_neutral int, is_negative int",
        "dim_device": "device_sk long, device string",
        "dim_traffic_source": "source_sk long, traffic_source string",
        "fact_sessions": "session_sk long, device_sk long, source_sk long",
        "fact_clickstream_events": "event_sk long, session_sk long, event_type string",
    }
    return lambda name: spark.createDataFrame(frames[name], schemas[name])


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_reviews_count_once_per_item(gold):
    """o1: two reviews x two items. A review outside the calendar is left out of the dated report only."""
    assert rows(reports.review_analysis(gold)) == [("toys", 4, 3.5, 2, 2, 0, 50.0), ("tools", 1, 3.0, 0, 0, 1, 0.0)]
    assert rows(reports.reviews_by_category(gold)) == [("toys", 4, 3.5, 50.0), ("tools", 2, 3.0, 0.0)]


def test_revenue_reports(gold):
    assert rows(reports.revenue_by_region(gold)) == [
        ("SUL", "PR", 1, 22.0, 11.0, 2.0),
        ("NORTE", "AM", 1, 5.5, 5.5, 0.5),
    ]
    assert rows(reports.monthly_revenue(gold)) == [("2024-01", 22.0), ("2024-02", 5.5)]
    assert rows(reports.revenue_by_state(gold)) == [("PR", 22.0), ("UNKNOWN", 7.5), ("AM", 5.5)]
    assert rows(reports.top_categories(gold, k=1)) == [("toys", 2, 1, 20.0, 10.0)]
    assert rows(reports.total_revenue(gold)) == [(35.0,)]


def test_sessions_and_funnel(gold):
    assert rows(reports.session_analytics(gold)) == [
        ("MOBILE", "ADS", 2, 4, 2.0),
        ("TV", "ADS", 1, 1, 1.0),
        ("UNKNOWN", "UNKNOWN", 1, 0, 0.0),  # session 14 has no event; the event without a session is not its
    ]
    assert rows(reports.funnel_analysis(gold)) == [
        ("PAGE_VIEW", 3, 4, 100.0),
        ("CLICK", 1, 1, 33.33),
        ("PURCHASE", 1, 1, 33.33),
    ]
    assert {r[3] for r in rows(reports.funnel_analysis(gold, entry_event="NEVER"))} == {None}


def test_filters(spark):
    df = spark.createDataFrame(
        [("a_b", 1, 1.5, date(2024, 1, 1), True), ("it's", 2, 2.5, date(2024, 2, 1), False), (None, 3, None, None, None)],
        "name string, n int, v double, day date, marketing_opt_in boolean",
    )

    def kept(**filters):
        return [r.n for r in serving.apply_filters(df, filters).orderBy("n").collect()]

    assert kept() == [1, 2, 3]
    assert kept(n="2") == [2] and kept(n=2) == [2] and kept(name="it's") == [2]
    assert kept(n_gte=2) == [2, 3] and kept(n_from="2") == [2, 3] and kept(n_gt=2) == [3]
    assert kept(n_lte="2") == [1, 2] and kept(n_to=1) == [1] and kept(n_lt=2) == [1]
    assert kept(day_gte="2024-01-15") == [2] and kept(day_lt=date(2024, 1, 15)) == [1]
    assert kept(name_like="_b") == [1] and kept(name_like="%") == []
    assert kept(n_in="1, 3") == [1, 3] and kept(name_in="it's,zzz") == [2]
    assert kept(marketing_opt_in="true") == [1]  # a column ending in a suffix is still a column
    assert kept(n="", v=None) == [1, 2, 3]
    assert kept(n_gte=1, v_lt=2) == [1]
    assert kept(n="not a number") == []
    for bad in ({"nope": 1}, {"nope_gte": 1}, {"n; drop table x": 1}):
        with pytest.raises(ValueError):
            serving.apply_filters(df, bad)


def test_template_access(gold):
    assert rows(serving.run_template(gold, "revenue_by_region", {"region": "SUL"}))[0][0] == "SUL"
    assert len(rows(serving.run_template(gold, "funnel_analysis", limit=2))) == 2
    with pytest.raises(KeyError):
        serving.run_template(gold, "nope")
    for limit in (0, -1, True, "5", 5000):
        with pytest.raises(ValueError):
            serving.run_template(gold, "cus_cnt", limit=limit)
    described = rows(serving.template_columns(gold, "revenue_by_region").orderBy("position"))
    assert described[:3] == [(1, "region", "string", "SUL"), (2, "state", "string", "PR"), (3, "total_orders", "bigint", "1")]
    assert set(serving.TEMPLATES) == {
        "cus_cnt", "prd_cnt", "revenue_by_region", "top_products_by_category", "review_analysis", "funnel_analysis",
        "session_analytics", "device_performance", "click_revenue_by_country",
    }


def test_filters_see_the_whole_report(gold):
    """A region below the top k is found."""
    few = lambda name: gold(name)
    assert rows(serving.run_template(few, "revenue_by_region", {"region": "NORTE"})) == [("NORTE", "AM", 1, 5.5, 5.5, 0.5)]
    assert len(rows(serving.run_template(few, "top_products_by_category"))) == 2


@pytest.mark.parametrize(
    "sql",
    [
        "", None, "  ", "DELETE FROM t", "SELECT 1; SELECT 2", "SHOW TABLES", "SET x = 1", "SELECTED 1",
        "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x", "DROP TABLE t", "CREATE TABLE t AS SELECT 1",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT 1 WHERE EXISTS (SELECT java_method('java.lang.System', 'nanoTime'))",
        "WITH x AS (SELECT try_reflect('java.lang.System', 'nanoTime') AS v) SELECT * FROM x",
        "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home')",
        "SELECT IDENTIFIER('ref' || 'lect')('java.lang.System', 'nanoTime')",
        "SELECT * FROM range(3) WHERE id = IDENTIFIER('java_' || 'method')('java.lang.System', 'nanoTime')",
        "SELECT (SELECT IDENTIFIER('reflect')('java.lang.System', 'nanoTime'))", "SELECT * FROM IDENTIFIER('parquet.`/x`')",
        "SELECT * FROM parquet.`/root/testdata/sf0.001/region.parquet`", "SELECT (SELECT max(a) FROM csv.`x`)",
    ],
)
def test_refused_statements(spark, sql):
    with pytest.raises(ValueError):
        serving.run_select(spark, sql)


def test_calls_are_found_in_the_analysed_plan_too(spark, monkeypatch):
    """Whatever slips past the parsed names is refused by what it turned out to be."""
    monkeypatch.setattr(serving, "objection", lambda *_: None)
    for sql in (
        "SELECT IDENTIFIER('reflect')('java.lang.System', 'nanoTime')",
        "SELECT id FROM range(2) WHERE id IN (SELECT length(reflect('java.lang.System', 'nanoTime')))",
        "WITH x AS (SELECT java_method('java.lang.System', 'nanoTime') AS v) SELECT max(v) FROM x",
    ):
        with pytest.raises(ValueError):
            serving.run_select(spark, sql)


def test_adhoc_select(spark):
    assert serving.run_select(spark, "SELECT id FROM range(2000)").count() == 2000
    assert serving.run_select(spark, " with x as (select id from range(9) order by id limit 5) select * from x; ", 3).count() == 3
    assert rows(serving.run_select(spark, "SELECT 'DROP TABLE t; --' AS word -- INSERT")) == [("DROP TABLE t; --",)]
    assert serving.run_select(spark, "SELECT id, row_number() OVER (ORDER BY id) n FROM range(9) WHERE id IN (SELECT 3)").count() == 1
    with pytest.raises(ValueError):
        serving.run_select(spark, "SELECT 1", 9999)


def test_iso_text(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 120), 7), (None, None, None, None)],
        "d date, t timestamp, u timestamp_ntz, n int",
    )
    assert rows(serving.iso_text(df)) == [
        ("2024-01-02", "2024-01-02T03:04:05", "2024-01-02T03:04:05.000120", 7),
        (None, None, None, None),
    ]
