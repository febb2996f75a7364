"""What the physical plans must look like, on the sample lake with every broadcast switched off."""

import re

import pytest

from weirstone.plans import reports
from weirstone.plans.gold import GOLD
from weirstone.plans.pipeline import BUILDS

REPORTS = {**reports.TEMPLATES, **reports.DASHBOARD}


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def derived(spark, golden, layer, table):
    lake, _ = golden
    build = BUILDS[layer][table]
    return build.function(*[lake.read(spark, *source) for source in build.inputs])


@pytest.mark.parametrize("layer, table", [(layer, t) for layer in BUILDS for t in BUILDS[layer]])
def test_builders_have_no_cross_join_and_no_forced_broadcast(spark, golden, no_broadcast, layer, table):
    plan = plan_of(derived(spark, golden, layer, table))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|Broadcast|BatchEvalPython|ArrowEvalPython", plan)


@pytest.mark.parametrize("name", REPORTS)
def test_reports_have_no_cross_join_and_no_forced_broadcast(spark, golden, no_broadcast, name):
    lake, _ = golden
    plan = plan_of(REPORTS[name](lambda table: lake.read(spark, "gold", table)))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|Broadcast|Python", plan)


def test_items_shuffle_on_the_order_once(spark, golden, no_broadcast):
    """Through fact_orders: order, seller, product, then the key's bucket - and nothing else."""
    plan = plan_of(derived(spark, golden, "gold", "fact_orders"))
    depth = [line for line in plan.splitlines() if "Exchange" in line]
    on = [re.search(r"hashpartitioning\((\w+)#", line).group(1) for line in depth]
    assert on.count("_bucket") == 1 and on.count("product_id") == 1 and on.count("seller_id") == 1
    # both sides of the items join are exchanged under it, so that a hot order can be split
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+, _order#", plan)) == 2
    assert "SinglePartition" not in plan and "rangepartitioning" not in plan


def test_scans_read_only_what_a_report_needs(spark, golden):
    lake, _ = golden
    plan = plan_of(reports.revenue_by_region(lambda table: lake.read(spark, "gold", table)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    facts = next(s for s in schemas if "total_item_value" in s)
    assert {c.split(":")[0] for c in facts.split(",")} == {
        "order_id",
        "date_sk",
        "customer_sk",
        "freight_value",
        "total_item_value",
    }


def test_funnel_scans_the_events_once(spark, golden):
    lake, _ = golden
    plan = plan_of(reports.funnel_analysis(lambda table: lake.read(spark, "gold", table)))
    assert plan.count("FileScan parquet") == 1


def test_keys_take_one_shuffle_and_no_sort_of_everything(spark, golden):
    for table in ("dim_seller", "dim_click_product"):
        plan = plan_of(derived(spark, golden, "gold", table))
        assert plan.count("Exchange hashpartitioning(_bucket") == 1
        assert "rangepartitioning" not in plan and "InMemory" + "TableScan" not in plan


def test_reviews_and_items_are_reduced_before_they_meet(spark, golden, no_broadcast):
    """Both inputs of the join on order_id are aggregates, so no pair of one order is emitted."""
    lake, _ = golden
    plan = plan_of(reports.reviews_by_category(lambda table: lake.read(spark, "gold", table)))
    join = plan[plan.index("SortMergeJoin [order_id") :]
    assert join.count("HashAggregate(keys=[order_id") == 4  # partial and final on either side


def test_every_gold_table_is_keyed_by_its_builder(spark, golden):
    for table in GOLD:
        first = derived(spark, golden, "gold", table).columns[0]
        assert first.endswith("_sk"), table


def test_what_follows_from_other_columns_is_not_shuffled(spark, golden, no_broadcast):
    """The last shuffle of the facts carries each value once, and no hash of the order id goes through any."""
    for table, made in (
        ("fact_orders", ("date_sk", "status_category", "total_item_value")),
        ("fact_reviews", ("date_sk", "is_positive", "is_neutral", "is_negative")),
    ):
        plan = plan_of(derived(spark, golden, "gold", table))
        below = plan[plan.index("Exchange hashpartitioning(_bucket") :]
        assert not any(f" AS {name}#" in below for name in made), table
    assert "xxhash64" not in plan_of(derived(spark, golden, "gold", "fact_orders"))


def test_tables_are_stored_compressed_by_zstd(golden):
    import pyarrow.parquet as pq
    from pathlib import Path

    lake, _ = golden
    for layer, table in (("bronze", "olist_orders"), ("silver", "olist_orders"), ("gold", "fact_orders")):
        file = max(Path(lake.path(layer, table)).glob("*.parquet"), key=lambda f: f.stat().st_size)
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
