"""Change events: reduction per key, decoding, ingestion, streaming."""

import json
import random

import pytest
from pyspark.sql import functions as F

from weirstone.operators.latest import images, latest_images, latest_rows
from weirstone.schemas import SOURCE_TABLES
from weirstone.sources import changes
from weirstone.streaming.changes import append_bronze, folder_stream

SCHEMA = "op string, ts_ms long, log_offset long, before struct<id:string,value:string>, after struct<id:string,value:string>"


def events(spark, *rows):
    """(op, ts, id, value) -> change events; a delete has only ``before``."""
    made = [
        (op, ts, offset, (key, None) if op == "d" else None, None if op == "d" else (key, value))
        for offset, (op, ts, key, value) in enumerate(rows)
    ]
    return spark.createDataFrame(made, SCHEMA)


def current(df):
    return {r.id: r.value for r in df.collect()}


# One key through its life; what is current after each event.
LIFE = [
    (("u", 10, "k", "seen late"), {"k": "seen late"}),
    (("r", 3, "k", "snapshot"), {"k": "seen late"}),
    (("d", 20, "k", None), {}),
    (("u", 15, "k", "between"), {}),
    (("c", 20, "k", "same millisecond"), {"k": "same millisecond"}),
    (("d", 20, "k", None), {}),
    (("c", 21, "other", "first"), {"other": "first"}),
    (("c", 40, "k", "third life"), {"k": "third life", "other": "first"}),
]


@pytest.mark.parametrize("length", range(1, len(LIFE) + 1))
def test_latest_with_before(spark, length):
    assert current(latest_images(events(spark, *[event for event, _ in LIFE[:length]]), ["id"])) == LIFE[length - 1][1]


def test_latest_without_before_only_skips_deletes(spark):
    df = events(spark, ("r", 1, "a", "v"), ("u", 3, "a", "w"), ("d", 9, "a", None), ("d", 9, "b", None)).drop("before")
    assert current(latest_images(df, ["id"])) == {"a": "w"}


def test_latest_without_offsets_is_deterministic(spark):
    df = events(spark, ("u", 1, "a", "x"), ("u", 1, "a", "y"), ("u", 1, "a", "z")).drop("log_offset")
    assert len({current(latest_images(df.repartition(n), ["id"]))["a"] for n in (1, 2, 3)}) == 1


def test_latest_flat_and_images(spark):
    flat = spark.createDataFrame([("c", 1, "a", "x"), ("u", 2, "a", "y"), ("d", 3, "a", "z")], "op string, ts_ms long, id string, value string")
    assert [tuple(r) for r in latest_rows(flat, ["id"]).select("id", "value").collect()] == [("a", "y")]
    log = events(spark, ("r", 1, "a", "v"), ("u", 2, "a", "w"), ("d", 3, "a", None))
    assert sorted(r.value for r in images(log).collect()) == ["v", "w"]


def test_random_histories_against_a_replay(spark):
    """A third of the events belong to one key."""
    dice = random.Random(7)
    history = []
    for ts in range(600):
        key = "hot" if dice.random() < 0.33 else f"k{dice.randrange(40)}"
        history.append((dice.choice("ccuuurd"), ts, key, f"v{ts}"))
    expected = {}
    for op, _, key, value in history:
        if op == "d":
            expected.pop(key, None)
        else:
            expected[key] = value
    dice.shuffle(history)
    assert current(latest_images(events(spark, *history).repartition(5), ["id"])) == expected


def test_reduction_limits_rows_before_the_shuffle(spark, tmp_path):
    events(spark, ("c", 1, "a", "x")).write.parquet(str(tmp_path / "log"))
    plan = latest_images(spark.read.parquet(str(tmp_path / "log")), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "before:struct<id:string>" in plan  # only the key of the before image is read


def envelope(wrapped, **event):
    return json.dumps({"payload": event} if wrapped else event)


def test_decode_accepts_both_envelopes_and_garbage(spark):
    seller = {"seller_id": "s1", "seller_zip_code_prefix": 1001, "seller_city": "x", "seller_state": "pr"}
    topic = SOURCE_TABLES["olist_sellers"].topic
    messages = [
        (topic, envelope(True, before=None, after=seller, op="c", ts_ms=5), 0),
        (topic, envelope(False, before=seller, after=None, op="d", ts_ms=6), 1),
        (topic, "{not json", 2),
        (topic, None, 3),
    ]
    df = spark.createDataFrame(messages, "topic string, value string, offset long")
    rows = {r.log_offset: r for r in changes.decode(df, "olist_sellers").collect()}
    assert (rows[0].op, rows[0].ts_ms, rows[0].after.seller_zip_code_prefix, rows[0].before) == ("c", 5, "1001", None)
    assert (rows[1].op, rows[1].before.seller_id, rows[1].after) == ("d", "s1", None)
    assert rows[2].op is None and rows[2].after is None and rows[3].op is None
    binary = df.withColumn("value", F.col("value").cast("binary")).drop("offset")
    assert changes.decode(binary, "olist_sellers").where("op = 'c'").first().after.seller_id == "s1"


def test_ingest_isolates_failures_and_skips_empty_topics(spark, lake):
    seller = {"seller_id": "s1", "seller_zip_code_prefix": "1", "seller_city": "x", "seller_state": "pr"}

    def reader(session, topic):
        if topic.endswith("olist_orders"):
            raise OSError("no broker")
        rows = [(topic, envelope(True, after=seller, op="c", ts_ms=5))] if topic.endswith("sellers") else []
        return session.createDataFrame(rows, "topic string, value string")

    topics = [SOURCE_TABLES[t].topic for t in ("olist_orders", "olist_sellers", "olist_customers")]
    summary = changes.ingest(spark, lake, reader, topics)
    assert {r.topic.split(".")[-1]: (r.status, r.rows) for r in summary.collect()} == {
        "olist_orders": ("failed", None),
        "olist_sellers": ("loaded", 1),
        "olist_customers": ("empty", None),
    }
    with pytest.raises(RuntimeError, match="olist_orders"):
        changes.require_all_loaded(summary)
    with pytest.raises(KeyError):
        changes.ingest(spark, lake, reader, ["no.such.topic"])
    # an empty topic later leaves the loaded table alone
    changes.ingest_table(spark, lake, lambda s, t: s.createDataFrame([], "topic string, value string"), "olist_sellers")
    assert lake.read(spark, "bronze", "olist_sellers").count() == 1


def write_messages(spark, folder, history, files):
    """The history as JSON files in an order that has nothing to do with time."""
    topic = SOURCE_TABLES["olist_sellers"].topic

    def image(key, value):
        return {"seller_id": key, "seller_zip_code_prefix": "1", "seller_city": value, "seller_state": "pr"}

    rows = [
        (
            topic,
            envelope(True, before=image(k, None) if op == "d" else None, after=None if op == "d" else image(k, v), op=op, ts_ms=ts),
            i,
        )
        for i, (op, ts, k, v) in enumerate(history)
    ]
    random.Random(3).shuffle(rows)
    spark.createDataFrame(rows, "topic string, value string, offset long").repartition(files).write.json(folder)


def test_append_bronze_stream(spark, tmp_path):
    folder = str(tmp_path / "topic")
    write_messages(spark, folder, [("c", 1, "a", "x"), ("d", 2, "a", None)], files=2)
    for _ in range(2):
        append_bronze(folder_stream(spark, folder), "olist_sellers", str(tmp_path / "bronze"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.op for r in spark.read.parquet(str(tmp_path / "bronze")).collect()) == ["c", "d"]
