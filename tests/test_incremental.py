"""The order fact brought up to date by changed orders equals the fact built anew; months that hold none are left alone."""

import datetime as dt
import random
from pathlib import Path

from pyspark.sql import functions as F

from weirstone.plans.gold import order_item_rows
from weirstone.plans.incremental import INPUTS, OrderFacts, changed_orders

SCHEMAS = {
    "olist_order_items": "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp, "
    "price double, freight_value double, total_item_value double, processed_at timestamp",
    "olist_orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_approved_at timestamp, order_delivered_customer_date timestamp, is_delivered boolean, is_delivered_late boolean, "
    "actual_delivery_days int, delivery_delay_days int",
    "olist_order_payments": "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    "olist_customers": "customer_id string, customer_unique_id string",
    "dim_customer": "customer_sk bigint, customer_unique_id string",
    "dim_seller": "seller_sk bigint, seller_id string",
    "dim_product": "product_sk bigint, product_id string",
}


def world(orders, customers, keys):
    """Plain rows of all inputs. orders: id -> (customer, month or None, price); keys: dimension -> {business key: surrogate}."""
    bought = {o: dt.datetime(2020, m, 5) if m else None for o, (_, m, _) in orders.items()}
    return {
        "olist_order_items": [(o, 1, f"p{len(o) % 2}", f"s{int(o[1:]) % 3}", None, price, 1.0, price + 1, None) for o, (_, _, price) in orders.items()],
        "olist_orders": [(o, c, "SHIPPED", bought[o], None, None, False, None, None, None) for o, (c, _, _) in orders.items()],
        "olist_order_payments": [(o, 1, "CARD", 1, price) for o, (_, _, price) in orders.items()],
        "olist_customers": list(customers.items()),
        **{dim: [(sk, business) for business, sk in some.items()] for dim, some in keys.items()},
    }


def frames(spark, made):
    return {name: spark.createDataFrame(made[name], SCHEMAS[name]) for name in INPUTS}


def events(spark, column, keys):
    kind = f"struct<{column}:string>"
    return spark.createDataFrame([(None if i % 2 else (k,), (k,) if i % 2 else None) for i, k in enumerate(keys)], f"before {kind}, after {kind}")


def shown(df):
    return sorted(map(str, (r.asDict() for r in df.collect())))


def test_batches_of_changes(spark, tmp_path):
    dice = random.Random(2)
    customers = {f"c{i}": f"u{i % 7}" for i in range(20)}
    keys = {
        "dim_customer": {f"u{i}": i + 1 for i in range(7)}, "dim_seller": {f"s{i}": i + 1 for i in range(3)},
        "dim_product": {f"p{i}": i + 1 for i in range(2)},
    }
    orders = {f"o{i}": (f"c{dice.randrange(20)}", dice.choice([None, 1, 2, 3]), float(i)) for i in range(40)}
    orders |= {f"o{i}": ("c0", 9, 1.0) for i in range(100, 103)}
    facts, before = OrderFacts(str(tmp_path / "facts")), world(orders, customers, keys)
    facts.rebuild(frames(spark, before))

    def step(named=(), people=()):
        nonlocal before
        after = world(orders, customers, keys)
        old, new = frames(spark, before), frames(spark, after)
        batch = {"olist_orders": events(spark, "order_id", named), "olist_customers": events(spark, "customer_id", people)}
        folder = str(tmp_path / f"changed{dice.random()}")
        changed_orders(batch, old, new).write.parquet(folder)
        changed = spark.read.parquet(folder)
        months = facts.apply(changed, old, new)
        want = shown(order_item_rows(*[new[name] for name in INPUTS]))
        assert shown(facts.read(spark)) == want
        assert facts.apply(changed, old, new) == months and shown(facts.read(spark)) == want  # again
        before = after
        return {r.order_id for r in changed.collect()}, months

    def files(month):
        return sorted(p.name for p in (Path(facts.root) / f"month={month}").glob("*.parquet"))

    untouched = files(202002), files(202009)
    orders["o1"] = ("c1", 1, 999.0)
    orders["o500"] = ("c2", 3, 5.0)
    assert step(["o1", "o500"])[0] == {"o1", "o500"}
    if before["olist_orders"][1] != 2:
        assert files(202009) == untouched[1]
    # an order moves to another month, another is gone
    orders["o100"] = ("c0", 5, 1.0)
    del orders["o101"]
    changed, months = step(["o100", "o101"])
    assert changed == {"o100", "o101"} and months == [202005, 202009]
    # the last of a month goes: its folder goes, too
    del orders["o102"]
    step(["o102"])
    assert not (Path(facts.root) / "month=202009").exists()
    # a customer is somebody else now
    customers["c3"] = "u6"
    assert step(people=["c3"])[0] == {o for o, (c, _, _) in orders.items() if c == "c3"}
    # keys of a dimension move, a member is new
    keys["dim_customer"]["u0"] = 77
    keys["dim_seller"] |= {"s2": 50, "s9": 51}
    touched = step()[0]
    assert touched == {o for o, (c, _, _) in orders.items() if customers[c] == "u0" or int(o[1:]) % 3 == 2}
    assert step() == (set(), [])


def test_keys_are_those_of_a_full_build(spark, tmp_path):
    orders = {f"o{i}": ("c0", 1 + i % 2, float(i)) for i in range(30)}
    keys = {"dim_customer": {"u0": 1}, "dim_seller": {f"s{i}": i for i in range(3)}, "dim_product": {"p0": 1, "p1": 2}}
    facts = OrderFacts(str(tmp_path / "facts"))
    facts.rebuild(frames(spark, world(orders, {"c0": "u0"}, keys)))
    numbered = facts.numbered(spark)
    assert numbered.select(F.count_distinct("order_item_sk")).first()[0] == 30 and numbered.columns[0] == "order_item_sk"


def test_replaced_states_of_a_run_are_removed(spark, sample):
    from weirstone.bindings.queries import QUERIES
    from weirstone.bindings.workspace import Workspace

    ws = Workspace(spark, sample)
    assert QUERIES["fact_orders_incremental"](ws).count() > 0
    (run,) = Path(ws.root.removeprefix("file:")).glob("incremental-*")
    states = [d.name for d in run.glob("[0-9]/*") if d.is_dir()]
    assert all(states.count(t) == 1 for t in ("olist_orders", "olist_customers", "olist_products", "dim_customer", "dim_product"))
    assert states.count("olist_order_items") > 1  # its later folders hold added rows only
