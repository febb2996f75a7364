"""Topics as logs of segments, and the store that one stream keeps of all topics."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from weirstone.operators.latest import latest_images
from weirstone.schemas import SOURCE_TABLES
from weirstone.sources import changes, topic_log
from weirstone.streaming.store import Manifest, TopicStore, maintain_all

SELLERS, ITEMS = (SOURCE_TABLES[t].topic for t in ("olist_sellers", "olist_order_items"))


def logged(spark, root, rows):
    """(topic, partition, value) in the order given."""
    made = [(*row, i) for i, row in enumerate(rows)]
    topic_log.append(spark.createDataFrame(made, "topic string, partition int, value string, offset long"), root)


def read(spark, root, **options):
    topic_log.register(spark)
    return spark.read.format("topic_log").options(**options).load(root)


def test_offsets_count_on_and_ranges_cut_them(spark, tmp_path):
    root = str(tmp_path / "log")
    logged(spark, root, [("a", i % 2, f"v{i}") for i in range(50)])
    logged(spark, root, [("a", 0, f"w{i}") for i in range(30)] + [("b", 3, None)])
    assert topic_log.ends(topic_log.segments(root)) == {"a": {"0": 55, "1": 25}, "b": {"3": 1}}
    rows = read(spark, root, topics="a").where("partition = 0").orderBy("offset").collect()
    assert [(r.offset, r.value) for r in rows] == list(enumerate([f"v{i}" for i in range(0, 50, 2)] + [f"w{i}" for i in range(30)]))
    cut = read(spark, root, topics="a", rows_per_task="7", **{"from": json.dumps({"a": {"0": 20}}), "until": json.dumps({"a": {"0": 33}})})
    assert sorted((r.partition, r.offset) for r in cut.collect()) == [(0, i) for i in range(20, 33)]
    assert cut.rdd.getNumPartitions() == 3  # five of the first segment, eight of the second in two
    assert [tuple(r) for r in read(spark, root, topics="b").collect()] == [("b", 3, 0, None)]
    assert not (Path(root) / topic_log.STAGED).exists() or not list((Path(root) / topic_log.STAGED).iterdir())


def test_rows_across_row_groups(spark, tmp_path):
    root = str(tmp_path / "log")
    topic_log.append(
        spark.range(25_000, numPartitions=1).select(
            F.lit("a").alias("topic"), F.lit(0).alias("partition"), F.col("id").cast("string").alias("value"), F.col("id").alias("offset")
        ),
        root,
    )
    rows = read(spark, root, **{"from": '{"a": {"0": 9990}}', "until": '{"a": {"0": 20010}}'}).collect()
    assert [(r.offset, r.value) for r in sorted(rows, key=lambda r: r.offset)] == [(i, str(i)) for i in range(9990, 20010)]


def test_a_failed_append_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "log")
    logged(spark, root, [("a", 0, "v")])
    bad = spark.createDataFrame([("a", 0, "x", 0), ("a", 0, "y", 1)], "topic string, partition int, value string, offset long")
    with pytest.raises(Exception):
        topic_log.append(bad.withColumn("value", F.when(F.col("value") == "y", F.raise_error(F.lit("boom"))).otherwise("x")), root)
    assert topic_log.ends(topic_log.segments(root)) == {"a": {"0": 1}}
    with pytest.raises(Exception):
        bad.write.format("topic_log").mode("overwrite").save(root)


def test_an_empty_topic_is_known_without_a_job(spark, lake, tmp_path):
    root = str(tmp_path / "log")
    logged(spark, root, [(SELLERS, 0, json.dumps({"payload": {"after": {"seller_id": "s"}, "op": "c", "ts_ms": 1}}))])
    reader = topic_log.LogReader(root)
    assert (reader.rows(SELLERS), reader.rows(ITEMS)) == (1, 0)
    spark.sparkContext.setJobGroup("empty", "empty")
    try:
        assert changes.ingest_table(spark, lake, reader, "olist_order_items") is None
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("empty")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # what arrives after the snapshot is not read
    logged(spark, root, [(SELLERS, 0, "{}")] * 3)
    assert changes.ingest_table(spark, lake, reader, "olist_sellers") == 1
    reader.record(spark, lake)
    later = topic_log.LogReader(root, since=topic_log.ledger_offsets(spark, lake))
    assert later.rows(SELLERS) == 3 and later(spark, SELLERS).count() == 3


def event(op, ts, key, city):
    image = {"seller_id": key, "seller_zip_code_prefix": "1", "seller_city": city, "seller_state": "pr"}
    gone = op == "d"
    return json.dumps({"payload": {"before": image if gone else None, "after": None if gone else image, "op": op, "ts_ms": ts}})


def item(op, ts, order):
    return json.dumps({"payload": {"after": {"order_id": order, "order_item_id": "1"}, "op": op, "ts_ms": ts}})


def batches(spark, histories):
    made = []
    for number, history in enumerate(histories):
        rows = [(SELLERS, hash(k) % 2, number * 1000 + i, event(op, ts, k, v)) for i, (op, ts, k, v) in enumerate(history)]
        rows += [(ITEMS, 0, number * 1000 + i, item("cu"[i % 2], i, "o1")) for i in range(3)]
        made.append(spark.createDataFrame(rows, topic_log.MESSAGE))
    return made


def test_store_gives_the_batch_result_whatever_the_arrival_order(spark, tmp_path):
    dice = random.Random(11)
    history = [(dice.choice("cuud"), ts, "hot" if dice.random() < 0.3 else f"k{dice.randrange(9)}", f"v{ts}") for ts in range(90)]
    history += [("c", 100, "gone", "x"), ("d", 102, "gone", None), ("u", 101, "gone", "old update after the delete")]
    dice.shuffle(history)
    parts = batches(spark, [history[i::6] for i in range(6)])
    store = TopicStore(str(tmp_path / "store"), buckets=3, fold_after=2, keep=1)
    for number, batch in enumerate(parts):
        store.absorb(batch, number)
    everything = changes.decode(spark.createDataFrame([r for p in parts for r in p.where(F.col("topic") == SELLERS).collect()], topic_log.MESSAGE), "olist_sellers")
    expected = sorted(tuple(r) for r in latest_images(everything, ["seller_id"]).collect())
    assert sorted(tuple(r) for r in store.current(spark, "olist_sellers").collect()) == expected
    assert "gone" not in {row[0] for row in expected}
    # items keep every image: three a batch
    assert store.current(spark, "olist_order_items").count() == 18
    assert store.current(spark, "click_orders").count() == 0
    now = store.manifest(spark)
    assert now.rows == {SELLERS: len(history), ITEMS: 18} and now.batch == 5
    assert all(len(parts) <= 2 for some in now.cells.values() for parts in some.values())
    # what is on disk is live or waits to be removed
    cells = {f"part={p}/topic={t}/bucket={b}" for t, some in now.cells.items() for b, ps in some.items() for p in ps}
    there = {"/".join(d.relative_to(tmp_path / "store" / "data").parts) for d in (tmp_path / "store" / "data").glob("*/*/*") if d.is_dir()}
    assert there == cells | {gone for _, gone in now.retired}


def test_a_fold_touches_full_cells_only(spark, tmp_path):
    store = TopicStore(str(tmp_path / "store"), buckets=4, fold_after=2, keep=9)
    for number in range(3):
        rows = [(SELLERS, 0, number, event("u", number, "always", f"v{number}"))]
        if number == 0:
            rows += [(SELLERS, 0, 100 + i, event("c", 0, f"k{i}", "x")) for i in range(20)]
        store.absorb(spark.createDataFrame(rows, topic_log.MESSAGE), number)
    cells = store.manifest(spark).cells[SELLERS]
    folded = [b for b, parts in cells.items() if parts[0].startswith("f")]
    assert len(cells) == 4 and len(folded) == 1
    assert {r.seller_city for r in store.current(spark, "olist_sellers").where("seller_id = 'always'").collect()} == {"v2"}
    assert store.current(spark, "olist_sellers").count() == 21


def test_a_fold_shuffles_events_once(spark, tmp_path, monkeypatch):
    plans, written = [], DataFrameWriter.parquet

    def noted(writer, path, *args, **kwargs):
        plans.append((path, writer._df._jdf.queryExecution().executedPlan().toString()))
        return written(writer, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    store = TopicStore(str(tmp_path / "store"), buckets=3, fold_after=1)
    for number, batch in enumerate(batches(spark, [[("c", n, f"k{n % 40}", f"v{n}") for n in range(k, 200, 2)] for k in (0, 1)])):
        store.absorb(batch, number)
    folds = [plan for path, plan in plans if "/part=f" in path]
    assert len(folds) == 1 and folds[0].count("Exchange hashpartitioning") == 1
    rows = {r.seller_id: r.seller_city for r in store.current(spark, "olist_sellers").collect()}
    assert rows == {f"k{n % 40}": f"v{n}" for n in range(200)}


def test_killed_and_repeated_batches(spark, tmp_path, monkeypatch):
    store = TopicStore(str(tmp_path / "store"), buckets=2, fold_after=1)
    first, second = batches(spark, [[("c", 1, "a", "x"), ("c", 1, "b", "y")], [("u", 2, "a", "z"), ("d", 2, "b", None)]])
    store.absorb(first, 0)
    with monkeypatch.context() as patch:
        patch.setattr(TopicStore, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            store.absorb(second, 1)
    assert {r.seller_id for r in store.current(spark, "olist_sellers").collect()} == {"a", "b"}  # nothing of it shows
    for _ in range(2):
        store.absorb(second, 1)
        assert [(r.seller_id, r.seller_city) for r in store.current(spark, "olist_sellers").collect()] == [("a", "z")]
    data = {d.name.removeprefix("part=") for d in (tmp_path / "store" / "data").iterdir()}
    named = {p for some in store.manifest(spark).cells.values() for ps in some.values() for p in ps}
    assert data - named <= {gone.split("/")[0].removeprefix("part=") for _, gone in store.manifest(spark).retired}
    with pytest.raises(RuntimeError, match="already published"):
        from weirstone.streaming.store import _Folder

        store._publish(_Folder(spark, store.root), Manifest(batch=1))


def test_stream_continues_from_its_checkpoint(spark, tmp_path):
    root, store = str(tmp_path / "log"), TopicStore(str(tmp_path / "store"))

    def run():
        topic_log.register(spark)
        maintain_all(spark.readStream.format("topic_log").load(root), store, str(tmp_path / "checkpoint")).awaitTermination()

    logged(spark, root, [(SELLERS, 0, event("c", 1, "a", "x")), (ITEMS, 0, item("c", 1, "o1"))])
    run()
    logged(spark, root, [(SELLERS, 0, event("d", 2, "a", None)), (SELLERS, 1, event("c", 2, "b", "y"))])
    run()
    run()
    assert [r.seller_id for r in store.current(spark, "olist_sellers").collect()] == ["b"]
    done = store.manifest(spark)
    assert done.rows == {SELLERS: 3, ITEMS: 1} and done.offsets[SELLERS] == {"0": 2, "1": 1}


def test_topics_of_larger_samples_get_more_partitions(spark, sample, monkeypatch):
    from weirstone.bindings import feeds
    from weirstone.bindings.workspace import Workspace

    monkeypatch.setattr(feeds, "ROWS_PER_PARTITION", 500)
    work = Workspace(spark, sample)
    found = topic_log.segments(work.topic_log())
    items = [s for s in found if s.topic == feeds.SOURCE_TABLES["olist_order_items"].topic]
    rows, lines = sum(s.end - s.base for s in items), work.sample("lineitem").count()
    assert rows >= lines and len({s.partition for s in items}) == -(-lines // 500)
    assert max(s.end - s.base for s in items) < rows / 4  # the largest task of the append, four partitions at any size before
    assert spark.read.format("topic_log").load(work.topic_log()).count() == sum(s.end - s.base for s in found)


def test_sample_of_even_parts_is_read_where_it_lies(spark, sample, tmp_path):
    from weirstone.bindings.workspace import Workspace

    orders = spark.read.parquet(f"{sample}/orders.parquet")
    many = orders.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(39)))).drop("i")
    many.repartition(8).write.parquet(str(tmp_path / "even.parquet"))
    many.coalesce(1).write.parquet(str(tmp_path / "one.parquet"))
    work = Workspace(spark, str(tmp_path))
    even, one = work.dealt_sample("even"), work.dealt_sample("one")
    assert all("/samples/" not in name for name in even.inputFiles())
    assert len(one.inputFiles()) >= 4 and all("/samples/one/" in name for name in one.inputFiles())
    assert even.count() == one.count() == many.count()


def test_bounds_given_or_read_make_the_same_ledger(spark, sample, tmp_path):
    from weirstone.bindings.workspace import Workspace
    from weirstone.streaming.store import TopicStore

    root = Workspace(spark, sample).topic_log()
    ends = topic_log.ends(topic_log.segments(root))
    log = spark.read.format("topic_log").load(root)
    read, given = (TopicStore(str(tmp_path / name)) for name in ("read", "given"))
    read.absorb(log, 0)
    given.absorb(log, 0, until=ends)
    assert read.manifest(spark).offsets == given.manifest(spark).offsets == ends
    rows = given.current(spark, "olist_orders")
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()  # one part a cell: nothing to compare
    given.absorb(log, 1, until=ends)  # two parts a cell
    assert given.current(spark, "olist_orders").exceptAll(rows).isEmpty() and rows.exceptAll(given.current(spark, "olist_orders")).isEmpty()
