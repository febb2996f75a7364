"""Own events of all sixteen topics through a log and a run whose gates are enforced; whole rows of what comes out."""

import datetime as dt
import json

import pytest

from weirstone.plans import pipeline
from weirstone.schemas import SOURCE_TABLES
from weirstone.sources import topic_log
from weirstone.sources.changes import ingest, require_all_loaded

T = dt.datetime

# Table -> events in log order: (op, ts_ms, image); the image of a delete is what was there before.
EVENTS = {
    "olist_geolocation": [
        ("r", 1, ["04001", -23.5, -46.5, "sao paulo", "sp"]),
        ("r", 1, ["04001", -23.7, -46.7, "sao paulo", "sp"]),
        ("r", 1, ["20010", -22.9, -43.2, "rio", "rj"]),
    ],
    "olist_customers": [
        ("r", 1, ["c1", "u1", "04001", " sao paulo ", "sp"]),
        ("c", 2, ["c2", "u2", "20010", "rio", "rj"]),
        ("u", 5, ["c1", "u1", "20010", "niteroi", "rj"]),
        ("c", 2, ["c3", "u3", "20010", "gone", "rj"]),
        ("d", 6, ["c3", None, None, None, None]),
    ],
    "olist_sellers": [("r", 1, ["s1", "04001", "campinas", "sp"])],
    "product_category_translation": [("r", 1, ["brinquedos", "toys"])],
    "olist_products": [
        ("r", 1, ["p1", "brinquedos", 10, 200, 3, 900, 20, 10, 5]),
        ("r", 1, ["p2", "livros", 12, 100, 1, 300, 30, 20, 2]),
    ],
    "olist_orders": [
        ("c", 10, ["o1", "c1", "shipped", "2018-03-01 10:30:00", None, None, None, "2018-03-20 00:00:00"]),
        ("u", 30, ["o1", "c1", "delivered", "2018-03-01 10:30:00", "2018-03-01 11:00:00", "2018-03-03 09:00:00", "2018-03-22 18:00:00",
                   "2018-03-20 00:00:00"]),
        ("c", 11, ["o2", "c2", "canceled", "1520000000000", None, None, None, "2018-03-30 00:00:00"]),
    ],
    "olist_order_items": [
        ("c", 10, ["o1", 1, "p1", "s1", "2018-03-05 00:00:00", "100.50", "9.50"]),
        ("c", 10, ["o1", 2, "p2", "s1", "2018-03-05 00:00:00", "20.00", "5.00"]),
        ("c", 11, ["o2", 1, "p1", "s1", "2018-03-06 00:00:00", "99.99", "10.01"]),
    ],
    "olist_order_payments": [
        ("c", 10, ["o1", 1, "credit_card", 3, "120.00"]),
        ("c", 10, ["o1", 2, "voucher", 1, "15.00"]),
        ("c", 11, ["o2", 1, "boleto", 1, "110.00"]),
    ],
    "olist_order_reviews": [("c", 40, ["r1", "o1", 4, "good", None, "2018-03-23 00:00:00", "2018-03-24 12:30:00"])],
    "click_customers": [("r", 1, [1, "Ann", "ann@example.org", "br", 30, "2020-01-02", True])],
    "click_products": [("r", 1, [7, "toys", "robot", "30.00", "20.00", "10.00"])],
    "click_sessions": [("r", 1, [5, 1, "2020-05-01 08:00:00", "mobile", "email", "br"])],
    "click_orders": [("c", 2, [9, 1, "2020-05-01 08:10:00", "card", "10.00", "60.00", "54.00", "br", "mobile", "email"])],
    "click_order_items": [("c", 2, [9, 7, "30.00", 2, "60.00"])],
    "click_events": [
        ("c", 2, [101, 5, "2020-05-01 08:01:00", "page_view", None, None, None, None, None, None]),
        ("c", 2, [102, 5, "2020-05-01 08:10:00", "purchase", 7, 2, 2, "card", "10.00", "54.00"]),
    ],
    "click_reviews": [("c", 3, [3, 9, 7, 5, "fun", "2020-05-09 00:00:00"])],
}


def messages():
    for table, history in EVENTS.items():
        source = SOURCE_TABLES[table]
        for op, ts, values in history:
            image = dict(zip(source.columns, values, strict=True))
            event = {"before": image if op == "d" else None, "after": None if op == "d" else image, "op": op, "ts_ms": ts}
            yield source.topic, 0, json.dumps({"payload": event} if table.startswith("olist") else event)


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    from weirstone.layout import Lake

    root = tmp_path_factory.mktemp("whole")
    made = [(*message, i) for i, message in enumerate(messages())]
    topic_log.append(spark.createDataFrame(made, "topic string, partition int, value string, offset long"), str(root / "log"))
    lake = Lake(str(root / "lake"))
    require_all_loaded(ingest(spark, lake, topic_log.LogReader(str(root / "log"))))
    outcome = pipeline.run(spark, lake, enforce_gates=True)
    assert outcome.gates == {"bronze": True, "silver": True, "gold": True}

    def read(layer, table):
        frame = lake.read(spark, layer, table).drop("processed_at", "etl_loaded_at")
        return [row.asDict() for row in frame.collect()]

    return read


def by(found, key):
    return {row[key]: row for row in found}


def test_customers(rows):
    assert by(rows("silver", "olist_customers"), "customer_id") == {
        "c1": {
            "customer_id": "c1", "customer_unique_id": "u1", "customer_zip_code_prefix": "20010", "customer_city": "NITEROI",
            "customer_state": "RJ", "customer_region": "SUDESTE", "customer_latitude": -22.9, "customer_longitude": -43.2,
        },
        "c2": {
            "customer_id": "c2", "customer_unique_id": "u2", "customer_zip_code_prefix": "20010", "customer_city": "RIO",
            "customer_state": "RJ", "customer_region": "SUDESTE", "customer_latitude": -22.9, "customer_longitude": -43.2,
        },
    }


def test_orders(rows):
    found = by(rows("silver", "olist_orders"), "order_id")
    assert found["o1"] == {
        "order_id": "o1", "customer_id": "c1", "order_status": "DELIVERED",
        "order_purchase_timestamp": T(2018, 3, 1, 10, 30), "order_approved_at": T(2018, 3, 1, 11),
        "order_delivered_carrier_date": T(2018, 3, 3, 9), "order_delivered_customer_date": T(2018, 3, 22, 18),
        "order_estimated_delivery_date": T(2018, 3, 20), "order_year": 2018, "order_month": 3, "order_day": 1, "order_hour": 10,
        "approval_delay_days": 0, "actual_delivery_days": 21, "estimated_delivery_days": 19, "delivery_delay_days": 2,
        "is_delivered_late": True, "is_delivered": True,
    }
    assert found["o2"] == {
        "order_id": "o2", "customer_id": "c2", "order_status": "CANCELED",
        "order_purchase_timestamp": T(2018, 3, 2, 14, 13, 20), "order_approved_at": None, "order_delivered_carrier_date": None,
        "order_delivered_customer_date": None, "order_estimated_delivery_date": T(2018, 3, 30), "order_year": 2018, "order_month": 3,
        "order_day": 2, "order_hour": 14, "approval_delay_days": None, "actual_delivery_days": None, "estimated_delivery_days": 28,
        "delivery_delay_days": None, "is_delivered_late": None, "is_delivered": False,
    }


def test_order_facts(rows):
    customers, sellers = by(rows("gold", "dim_customer"), "customer_unique_id"), by(rows("gold", "dim_seller"), "seller_id")
    products = by(rows("gold", "dim_product"), "product_id")
    found = {(r["order_id"], r["order_item_id"]): r for r in rows("gold", "fact_orders")}
    assert len({r.pop("order_item_sk") for r in found.values()}) == 3
    shared = {
        "order_id": "o1", "date_sk": 20180301, "customer_sk": customers["u1"]["customer_sk"], "seller_sk": sellers["s1"]["seller_sk"],
        "order_status": "DELIVERED", "status_category": "COMPLETED", "is_delivered": True, "is_delivered_late": True,
        "actual_delivery_days": 21, "delivery_delay_days": 2, "total_payment_value": 135.0, "payment_installments": 4,
        "primary_payment_type": "CREDIT_CARD", "order_purchase_timestamp": T(2018, 3, 1, 10, 30), "order_approved_at": T(2018, 3, 1, 11),
        "order_delivered_customer_date": T(2018, 3, 22, 18), "shipping_limit_date": T(2018, 3, 5),
    }
    assert found["o1", 1] == shared | {
        "order_item_id": 1, "product_sk": products["p1"]["product_sk"], "unit_price": 100.5, "freight_value": 9.5, "total_item_value": 110.0,
    }
    assert found["o1", 2] == shared | {
        "order_item_id": 2, "product_sk": products["p2"]["product_sk"], "unit_price": 20.0, "freight_value": 5.0, "total_item_value": 25.0,
    }
    assert found["o2", 1] == {
        "order_id": "o2", "order_item_id": 1, "date_sk": 20180302, "customer_sk": customers["u2"]["customer_sk"],
        "product_sk": products["p1"]["product_sk"], "seller_sk": sellers["s1"]["seller_sk"], "order_status": "CANCELED",
        "status_category": "FAILED", "is_delivered": False, "is_delivered_late": None, "unit_price": 99.99, "freight_value": 10.01,
        "total_item_value": 110.0, "actual_delivery_days": None, "delivery_delay_days": None, "total_payment_value": 110.0,
        "payment_installments": 1, "primary_payment_type": "BOLETO", "order_purchase_timestamp": T(2018, 3, 2, 14, 13, 20),
        "order_approved_at": None, "order_delivered_customer_date": None, "shipping_limit_date": T(2018, 3, 6),
    }


def test_click_facts(rows):
    (session,), (order,) = rows("gold", "fact_sessions"), rows("gold", "fact_click_orders")
    customer = by(rows("gold", "dim_click_customer"), "customer_id")[1]
    product = by(rows("gold", "dim_click_product"), "product_id")[7]
    device, source = by(rows("gold", "dim_device"), "device")["MOBILE"], by(rows("gold", "dim_traffic_source"), "traffic_source")["EMAIL"]
    visit = {"customer_sk": customer["customer_sk"], "device_sk": device["device_sk"], "source_sk": source["source_sk"], "country": "BR"}
    assert {k: v for k, v in session.items() if k != "session_sk"} == visit | {
        "session_id": 5, "date_sk": 20200501, "session_start_timestamp": T(2020, 5, 1, 8),
    }
    assert {k: v for k, v in order.items() if k != "order_sk"} == visit | {
        "order_id": 9, "date_sk": 20200501, "payment_method": "CARD", "discount_pct": 10.0, "subtotal_usd": 60.0, "total_usd": 54.0,
        "order_timestamp": T(2020, 5, 1, 8, 10),
    }
    events = by(rows("gold", "fact_clickstream_events"), "event_id")
    assert len({e.pop("event_sk") for e in events.values()}) == 2
    shared = {"session_sk": session["session_sk"], "customer_sk": customer["customer_sk"], "date_sk": 20200501}
    assert events[101] == shared | {
        "event_id": 101, "product_sk": -1, "event_type": "PAGE_VIEW", "quantity": 0, "payment_method": "NOT_APPLICABLE",
        "event_timestamp": T(2020, 5, 1, 8, 1),
    }
    assert events[102] == shared | {
        "event_id": 102, "product_sk": product["product_sk"], "event_type": "PURCHASE", "quantity": 2, "payment_method": "CARD",
        "event_timestamp": T(2020, 5, 1, 8, 10),
    }
    (review,) = rows("gold", "fact_click_reviews")
    assert {k: v for k, v in review.items() if k != "review_sk"} == {
        "review_id": 3, "order_sk": order["order_sk"], "product_sk": product["product_sk"], "date_sk": 20200509, "rating": 5,
        "review_text": "fun", "sentiment": "POSITIVE", "review_timestamp": T(2020, 5, 9),
    }


def test_products_reviews_and_calendar(rows):
    products = by(rows("gold", "dim_product"), "product_id")
    assert {p: (r["product_category_name_english"], r.get("product_volume_cm3")) for p, r in products.items() if p != "UNKNOWN"} == {
        "p1": ("toys", 1000), "p2": ("livros", 1200),
    }
    (review,) = rows("silver", "olist_order_reviews")
    assert (review["review_rating"], review["has_comment"], review["review_response_time_hours"]) == ("POSITIVE", True, 36.5)
    days = [r["date_sk"] for r in rows("gold", "dim_date")]
    assert (min(days), max(days), len(days)) == (20180101, 20181231, 365)
