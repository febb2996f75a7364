"""Keys, lookups, calendar, geo, sinks, CSV, catalogue."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weirstone.functions.parsing import whole
from weirstone.layout import LAYERS, Lake
from weirstone.operators.calendar import calendar, date_spine
from weirstone.operators.geo import zip_coordinates
from weirstone.operators.keys import dense_key, surrogate_key, with_unknown
from weirstone.operators.lookups import resolve
from weirstone.sources import catalog, files, tables


def test_layout():
    lake = Lake("s3a://bucket/lake", "delta")
    assert lake.path("bronze", "olist_orders") == "s3a://bucket/lake/bronze/olist.public.olist_orders/"
    assert lake.path("gold", "dim_date").endswith("/gold/dim_date/")
    paths = [path for layer in LAYERS for path in lake.tables(layer).values()]
    assert len(set(paths)) == 44
    assert list(lake.tables("gold", "fact_orders")) == ["fact_orders"]
    with pytest.raises(KeyError):
        lake.tables("gold", "nope")


def test_keys_depend_on_the_data_alone(spark):
    rows = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    keyed = [surrogate_key(rows.repartition(n), "sk", ["k"]) for n in (1, 7)]
    first, second = ({r.k: r.sk for r in df.collect()} for df in keyed)
    assert first == second
    assert len(set(first.values())) == 500 and min(first.values()) >= 1 and max(first.values()) < 2**53


def test_duplicate_business_keys_still_get_distinct_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", None)], "k string, v int")
    keys = [r.sk for r in surrogate_key(rows, "sk", ["k"], ["v"]).collect()]
    assert len(set(keys)) == 4


def test_key_order_of_columns_and_empty_input(spark):
    rows = spark.range(0).select("id", F.lit("x").alias("v"))
    keyed = surrogate_key(rows, "sk", ["id"])
    assert keyed.columns == ["sk", "id", "v"] and keyed.count() == 0


def dimension(spark):
    rows = spark.createDataFrame([(10, "ten"), (20, "twenty")], "id long, name string")
    return with_unknown(surrogate_key(rows, "sk", ["id"]), "sk", {"id": -1, "name": "UNKNOWN"})


def test_unknown_member(spark):
    member = dimension(spark).where("sk = -1").first()
    assert (member.id, member.name) == (-1, "UNKNOWN")
    typed = with_unknown(spark.range(1).select(F.col("id").alias("sk"), F.lit(1.5).alias("v")), "sk", {})
    assert typed.where("sk = -1").first().v is None


def test_lookup(spark):
    dim = dimension(spark)
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, None), (5, -1)], "f long, id long")
    keys = {r.id: r.sk for r in dim.collect()}
    for scatter in (None, "f"):
        got = {r.f: r.sk for r in resolve(facts, dim, "id", "id", {"sk": "sk"}, scatter).collect()}
        assert got == {1: keys[10], 2: keys[20], 3: -1, 4: -1, 5: -1}


def test_value_that_reads_unknown_does_not_double_rows(spark):
    rows = spark.createDataFrame([("UNKNOWN",), ("MOBILE",)], "device string")
    dim = with_unknown(surrogate_key(rows, "sk", ["device"]), "sk", {"device": "UNKNOWN"})
    facts = spark.createDataFrame([("UNKNOWN",), ("MOBILE",)], "device string")
    got = resolve(facts, dim, "device", "device", {"sk": "sk"})
    assert got.count() == 2 and got.where("sk = -1").count() == 0


def test_rows_without_a_key_are_spread_over_a_shuffle_join(spark):
    """All facts lack the key: the join key must still take many values."""
    from weirstone.operators.lookups import scattered

    keys = spark.range(10_000).select(scattered(F.lit(-1).cast("long"), F.col("id")).alias("k"))
    spread = keys.agg(F.count_distinct("k").alias("n"), F.max("k").alias("high")).first()
    assert spread.n > 3000 and spread.high < -1


def test_calendar(spark):
    dated = spark.createDataFrame([(datetime(2020, 5, 5),), (datetime(2021, 2, 1),), (None,)], "t timestamp")
    days = calendar(date_spine(dated, "t"))
    assert days.count() == 366 + 365
    row = days.where("date_sk = 20210101").first()
    assert (row.full_date, row.day_of_week, row.day_name, row.week_of_year) == (datetime(2021, 1, 1), 6, "Friday", 53)
    assert (row.month_name, row.quarter, row.is_weekend, row.year_month, row.year_quarter) == (
        "January",
        1,
        False,
        "2021-01",
        "2021-Q1",
    )
    assert days.where("is_weekend").select("day_name").distinct().count() == 2
    empty = date_spine(dated.where("t is null"), "t").agg(F.min("day"), F.max("day")).first()
    assert [str(d) for d in empty] == ["2016-01-01", "2020-12-31"]


def test_zip_coordinates(spark):
    schema = (
        "op string, after struct<geolocation_zip_code_prefix:string,geolocation_lat:string,geolocation_lng:string,"
        "geolocation_city:string,geolocation_state:string>"
    )
    rows = [
        ("r", ("1", "-10.000001", "-40.0", "b ", "sp")),
        ("r", ("1", "-10.000002", "-40.0", " B", "SP")),
        ("r", ("1", "-5", "-41.0", "a", "sp")),
        ("r", ("2", "91", "0", "x", "sp")),
        ("r", ("3", "x", "0", "x", "sp")),
        ("d", ("4", "1", "1", "x", "sp")),
        ("r", (None, "1", "1", "x", "sp")),
    ]
    got = [tuple(r) for r in zip_coordinates(spark.createDataFrame(rows, schema)).collect()]
    assert got == [("1", -10.000002, -40.0)]  # the tie at the seventh decimal rounds away from zero


def test_overwrite_counts_and_records(spark, lake):
    assert tables.replace_table(spark, lake, spark.range(5), "silver", "olist_orders") == 5
    assert tables.replace_table(spark, lake, spark.range(3).select(F.lit("x").alias("other")), "silver", "olist_orders") == 3
    stored = lake.read(spark, "silver", "olist_orders")
    assert stored.columns == ["other"] and stored.count() == 3
    assert tables.replace_table(spark, lake, spark.range(0), "silver", "olist_sellers") == 0
    rows = lake.load(spark, lake.metrics_path).collect()
    assert sorted((r.table_name, r.row_count, r.status) for r in rows) == [
        ("olist_orders", 3, "success"),
        ("olist_orders", 5, "success"),
        ("olist_sellers", 0, "success"),
    ]


def test_failed_write_is_recorded_and_raised(spark, lake):
    broken = spark.range(5).select(F.raise_error(F.lit("boom" * 300)).cast("string").alias("x"))
    with pytest.raises(Exception, match="boom"):
        tables.replace_table(spark, lake, broken, "silver", "olist_orders")
    (row,) = lake.load(spark, lake.metrics_path).collect()
    assert (row.status, row.row_count, len(row.error_message)) == ("failed", 0, 500)


def test_metrics_never_raise(spark):
    tables.record_metrics(spark, Lake("/proc/nowhere"), [tables.metric("silver", "t", 1, 0.1)])


def test_csv_load(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,"a ""quoted"" title","two\nlines",2018-01-11 00:00:00,2018-01-12 12:00:00\n'
        "r2,o2,,,,2018-01-11 00:00:00,\n"
    )
    rows = {r.review_id: r for r in files.read_csv(spark, str(path), "olist_order_reviews").collect()}
    assert (rows["r1"].review_comment_title, rows["r1"].review_comment_message) == ('a "quoted" title', "two\nlines")
    assert (rows["r2"].review_score, rows["r2"].review_answer_timestamp) == (None, None)
    path.write_text("review_id,order_id,review_score\nr1,o1,five\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(path), "olist_order_reviews").collect()


def test_load_order_puts_parents_first():
    order = files.load_order()
    assert sorted(order) == sorted(LAYERS["bronze"])
    assert order.index("olist_orders") < order.index("olist_order_items")
    assert order.index("click_sessions") < order.index("click_events")


def test_insert_if_absent(spark, tmp_path):
    target = str(tmp_path / "target")
    spark.createDataFrame([("a", 1)], "id string, v int").write.parquet(target)
    incoming = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), ("c", 4)], "id string, v int")
    files.insert_if_absent(incoming, target, ["id"], prefer=["v"])
    files.insert_if_absent(incoming, target, ["id"], prefer=["v"])
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [("a", 1), ("b", 2), ("c", 4)]


def test_constraints(spark):
    orders = spark.createDataFrame([("o1", "c1"), ("o1", "c9"), ("o2", None)], "order_id string, customer_id string")
    customers = spark.createDataFrame([("c1",)], "customer_id string")
    report = files.constraint_report({"olist_orders": orders, "olist_customers": customers})
    assert {(r.table_name, r.constraint_name): r.violations for r in report.collect()} == {
        ("olist_orders", "primary key order_id"): 1,
        ("olist_orders", "customer_id references olist_customers"): 1,
        ("olist_customers", "primary key customer_id"): 0,
    }


def test_constraints_count_every_orphan_once(spark):
    """A hot reference, repeated parents, NULLs, and a table without a declared key."""
    orders = spark.createDataFrame([(1, 7), (2, 7), (2, 8), (None, None)], "order_id bigint, customer_id bigint")
    items = spark.createDataFrame([(1, 5)] * 50 + [(9, 5)] * 40 + [(None, 6), (2, None)], "order_id bigint, product_id bigint")
    products = spark.createDataFrame([(5,)], "product_id bigint")
    report = files.constraint_report({"click_orders": orders, "click_order_items": items, "click_products": products})
    assert sorted((r.table_name, r.constraint_name, r.violations) for r in report.collect()) == [
        ("click_order_items", "order_id references click_orders", 40),
        ("click_order_items", "product_id references click_products", 1),
        ("click_orders", "primary key order_id", 1),
        ("click_products", "primary key product_id", 0),
    ]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_dense_keys(spark, tmp_path):
    spark.range(0, 1000, numPartitions=7).where("id % 9 <> 4").write.parquet(str(tmp_path / "t"))
    keyed = dense_key(spark.read.parquet(str(tmp_path / "t")), "sk")
    rows = sorted((r.sk, r.id) for r in keyed.collect())
    assert [sk for sk, _ in rows] == list(range(1, len(rows) + 1)) and len({i for _, i in rows}) == len(rows)
    assert "Exchange hashpartitioning(id" not in keyed._jdf.queryExecution().executedPlan().toString()


def test_publish(spark, lake):
    spark.range(3).write.parquet(lake.path("gold", "dim_date"))
    assert catalog.publish(spark, lake, "gold", "dim_date", database="pub_test") == (1, 0)
    spark.range(4).select("id", F.lit(1).alias("more")).write.mode("overwrite").parquet(lake.path("gold", "dim_date"))
    assert catalog.publish(spark, lake, "gold", database="pub_test") == (1, 13)
    assert spark.sql("select sum(more) from pub_test.dim_date").first()[0] == 4
    assert [t.name for t in spark.catalog.listTables("pub_test")] == ["dim_date"]


def test_whole_keeps_big_identifiers(spark):
    got = spark.createDataFrame([("1234567890123456789",)], "x string").select(whole(F.col("x"))).first()[0]
    assert got == 1234567890123456789
