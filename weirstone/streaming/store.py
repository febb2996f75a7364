"""Current images of all topics, kept by one stream: key buckets, deltas, folds and an atomic manifest.

Events of every topic are decoded into one shape, images being maps of text, so
one job per micro-batch serves all topics. It reduces the batch to the newest
event per topic and key and writes it as a new *part*, laid out by topic and
bucket of the key. A *cell* (topic, bucket) lists the parts that hold its events, newest last. When a cell has
more than ``fold_after`` parts, its events alone are folded into a new part; other cells are
left as they are.

What is live is said by the manifest of the newest batch, one JSON file that appears by a single
rename. It is also the commit ledger: it names the batch, its rows and how far each topic partition has been read. A batch
whose manifest is there is not absorbed again; a batch killed before leaves a part that no manifest
names, which the next absorb removes before it runs. Folded parts are kept for ``keep`` further batches, for readers of
older manifests, and then removed.

Late and out-of-order events need no watermark: ``ts_ms`` decides, then the log position, and deletes stay
as tombstones. Topics without a key (or kept with every image, as order items are) use the log position as the key.
The manifest's rename goes through Hadoop's file system, so this needs a classic session, not Spark Connect.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weirstone.operators.latest import first_per
from weirstone.schemas import SOURCE_TABLES

_EVENT = "before: MAP<STRING, STRING>, after: MAP<STRING, STRING>, op: STRING, ts_ms: BIGINT"
_ENVELOPE = f"STRUCT<payload: STRUCT<{_EVENT}>, {_EVENT}>"
_COLUMNS = ("key", "after", "op", "ts_ms", "log_partition", "log_offset", "topic")
_STORED = (
    "key ARRAY<STRING>, after MAP<STRING, STRING>, op STRING, ts_ms BIGINT, log_partition INT, log_offset BIGINT, topic STRING"
)

#: Rows of a cell that one task folds.
SLICE_ROWS = 500_000

#: Topics kept with every image that is not a delete.
EVERY_IMAGE = ("olist_order_items", "olist_order_payments", "olist_geolocation", "product_category_translation")


def key_columns() -> dict[str, tuple[str, ...]]:
    """Topic -> key columns; none for topics that keep every image."""
    return {s.topic: () if name in EVERY_IMAGE else s.key for name, s in SOURCE_TABLES.items()}


def decode_any(messages: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Messages of any topics -> key, after, op, ts_ms and log position. Unreadable text yields NULLs, not an error."""
    parsed = messages.select(
        "topic", F.col("partition").cast("int").alias("log_partition"), F.col("offset").alias("log_offset"),
        F.from_json(F.col("value").cast("string"), _ENVELOPE).alias("event"),
    )

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"event.payload.{name}"), F.col(f"event.{name}")).alias(name)

    events = parsed.select("topic", "log_partition", "log_offset", *[either(n) for n in ("before", "after", "op", "ts_ms")])
    names = F.create_map(*[F.lit(x) for topic, columns in keys.items() for x in (topic, list(columns))]).cast("map<string,array<string>>")
    given = F.transform(
        F.coalesce(names[F.col("topic")], F.array().cast("array<string>")), lambda k: F.coalesce(F.col("after")[k], F.col("before")[k])
    )
    place = F.array(F.col("log_partition").cast("string"), F.col("log_offset").cast("string"))
    key = F.when(F.size(given) > 0, given).otherwise(place)
    return events.withColumn("key", key).select(*_COLUMNS)


def _newest(events: DataFrame, within: Sequence[str] = ("topic",)) -> DataFrame:
    """The newest event per key; ``within`` is the topic, with more columns that follow from it and the key if events are dealt by them."""
    order = [F.col("ts_ms").desc_nulls_last(), F.col("log_offset").desc(), F.col("log_partition").desc()]
    return first_per(events, [*within, "key"], order)


Cells = dict[str, dict[str, list[str]]]  # topic -> bucket -> parts


@dataclass
class Manifest:
    batch: int = -1
    cells: Cells = field(default_factory=dict)
    offsets: dict[str, dict[str, int]] = field(default_factory=dict)  # topic -> partition -> next offset
    rows: dict[str, int] = field(default_factory=dict)  # topic -> messages absorbed so far
    retired: list[tuple[int, str]] = field(default_factory=list)  # batch that replaced it, part/topic/bucket folder


class _Folder:
    """The few file operations that Spark's DataFrame API lacks, on whatever file system the root is on."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root
        self.files = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        path = self._path(name)
        return [one.getPath().getName() for one in self.files.listStatus(path)] if self.files.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.files.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """The whole file under its final name, or an error; never half of it."""
        staged = f"_staged-{uuid.uuid4().hex}"
        stream = self.files.create(self._path(staged))
        stream.write(bytearray(text.encode()))
        stream.close()
        self.files.mkdirs(self._path(name).getParent())
        if self.files.exists(self._path(name)) or not self.files.rename(self._path(staged), self._path(name)):
            self.remove(staged)
            raise RuntimeError(f"{name} is already published")

    def remove(self, name: str) -> None:
        self.files.delete(self._path(name), True)


@dataclass(frozen=True)
class TopicStore:
    root: str
    keys: Mapping[str, Sequence[str]] = field(default_factory=key_columns)
    buckets: int = 8
    fold_after: int = 4
    keep: int = 2

    def manifest(self, spark: SparkSession) -> Manifest:
        """The newest published one."""
        folder = _Folder(spark, self.root)
        found = sorted(folder.names("manifest"))
        if not found:
            return Manifest()
        stored = json.loads(folder.read(f"manifest/{found[-1]}"))
        return Manifest(**{**stored, "retired": [tuple(x) for x in stored["retired"]]})

    def absorb(self, batch: DataFrame, batch_id: int, until: Mapping[str, Mapping[str, int]] | None = None) -> None:
        """Take in a micro-batch; a batch already published changes nothing.

        ``until`` says where the batch ends in each topic partition, if the caller has bounded it; else it is read once more for that.
        """
        spark = batch.sparkSession
        folder, now = _Folder(spark, self.root), self.manifest(spark)
        if batch_id <= now.batch:
            return
        self._clear(folder, now)
        part = f"b{batch_id:012d}-{uuid.uuid4().hex[:8]}"
        seen, per_topic = Observation(), sorted(self.keys)
        counts = [F.count_if(F.col("topic") == t).alias(f"n{i}") for i, t in enumerate(per_topic)]
        events = decode_any(batch.observe(seen, *counts), self.keys)
        self._write(_newest(events), part)
        cells = {t: dict(b) for t, b in now.cells.items()}
        for topic, bucket_name in self._cells_of(folder, part):
            here = cells.setdefault(topic, {})
            here[bucket_name] = [*here.get(bucket_name, []), part]
        offsets = {t: dict(o) for t, o in now.offsets.items()}
        if until is None:
            until = self._ends_of(batch)
        for topic, reached in until.items():
            here = offsets.setdefault(topic, {})
            here.update({partition: max(end, here.get(partition, 0)) for partition, end in reached.items()})
        got = seen.get
        rows = {t: now.rows.get(t, 0) + got[f"n{i}"] for i, t in enumerate(per_topic) if now.rows.get(t, 0) + got[f"n{i}"]}
        retired = self._fold(spark, cells, batch_id, rows)
        old = [x for x in now.retired if x[0] > batch_id - self.keep]
        self._publish(folder, Manifest(batch_id, cells, offsets, rows, old + retired))
        for _, gone in (x for x in now.retired if x[0] <= batch_id - self.keep):
            folder.remove(f"data/{gone}")

    def _ends_of(self, batch: DataFrame) -> dict[str, dict[str, int]]:
        """Topic -> partition -> next offset: a row per topic partition comes to the driver."""
        out: dict[str, dict[str, int]] = {}
        for row in batch.groupBy("topic", "partition").agg(F.max("offset")).collect():
            out.setdefault(row[0], {})[str(row[1])] = row[2] + 1
        return out

    def _publish(self, folder: _Folder, manifest: Manifest) -> None:
        folder.publish(f"manifest/{manifest.batch:020d}.json", json.dumps(manifest.__dict__))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")

    def _write(self, events: DataFrame, part: str) -> None:
        # rebalanced, not repartitioned: few files per cell, and a large cell is split over tasks
        self._save(events.withColumn("bucket", self._bucket()).hint("rebalance", "topic", "bucket"), part)

    def _save(self, dealt: DataFrame, part: str) -> None:
        dealt.write.option("compression", "zstd").partitionBy("topic", "bucket").parquet(f"{self.root}/data/part={part}")

    def _cells_of(self, folder: _Folder, part: str) -> list[tuple[str, str]]:
        at = f"data/part={part}"
        topics = [name for name in folder.names(at) if name.startswith("topic=")]
        return [(t.removeprefix("topic="), b.removeprefix("bucket=")) for t in topics for b in folder.names(f"{at}/{t}")]

    def _fold(self, spark: SparkSession, cells: Cells, batch_id: int, rows: Mapping[str, int]) -> list[tuple[int, str]]:
        """Rewrite the cells of too many parts, in place in ``cells``; returns what that retires. ``rows``: messages of each topic so far.

        A part holds one event per key, so none is hot: events are shuffled once, by cell and slices of at most about
        ``SLICE_ROWS`` of it, in which they are reduced and written where they arrive.
        """
        full = [(t, b) for t, some in cells.items() for b, parts in some.items() if len(parts) > self.fold_after]
        if not full:
            return []
        part = f"f{batch_id:012d}-{uuid.uuid4().hex[:8]}"
        slices = F.create_map(*[F.lit(x) for t in cells for x in (t, max(1, -(-rows.get(t, 0) // (self.buckets * SLICE_ROWS))))])
        # another seed than the bucket's, or a cell's keys would share a few slices
        slice_ = F.pmod(F.xxhash64("key", F.lit("slice")), slices[F.col("topic")])
        events = self._events(spark, cells, full).withColumns({"bucket": self._bucket(), "_slice": slice_})
        cell = ["topic", "bucket", "_slice"]
        self._save(_newest(events.repartition(*cell), cell).drop("_slice"), part)
        retired = [(batch_id, f"part={p}/topic={t}/bucket={b}") for t, b in full for p in cells[t][b]]
        for t, b in full:
            cells[t][b] = [part]
        return retired

    def _events(self, spark: SparkSession, cells: Cells, wanted: list[tuple[str, str]]) -> DataFrame:
        paths = [f"{self.root}/data/part={p}/topic={t}/bucket={b}" for t, b in wanted for p in cells[t][b]]
        if not paths:
            return spark.createDataFrame([], _STORED)
        found = spark.read.schema(f"{_STORED}, bucket INT, part STRING").option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(*_COLUMNS)

    def _clear(self, folder: _Folder, now: Manifest) -> None:
        """Remove parts of killed batches: those no manifest names."""
        named = {p for some in now.cells.values() for parts in some.values() for p in parts}
        named |= {gone.split("/")[0].removeprefix("part=") for _, gone in now.retired}
        for name in folder.names("data"):
            if name.removeprefix("part=") not in named:
                folder.remove(f"data/{name}")

    def current(self, spark: SparkSession, table: str) -> DataFrame:
        """Current rows of a source table: what a batch run over all events so far would give."""
        source = SOURCE_TABLES[table]
        cells = self.manifest(spark).cells
        here = cells.get(source.topic, {})
        # a part holds one event per key, so that a cell of one part is current as it lies there
        single, several = ([(source.topic, b) for b, parts in here.items() if (len(parts) == 1) == one] for one in (True, False))
        events = self._events(spark, cells, single)
        if several:
            merged = _newest(self._events(spark, cells, several))
            events = events.unionByName(merged) if single else merged
        alive = events.where(F.col("op") != "d")
        return alive.select(*[F.col("after")[name].alias(name) for name in source.columns])


def maintain_all(messages: DataFrame, store: TopicStore, checkpoint: str) -> StreamingQuery:
    """Absorb all topics of a log into the store, batch by batch, up to now."""
    writer = messages.writeStream.foreachBatch(store.absorb).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def append_all(messages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the decoded events of all topics, one folder per batch, so that a batch run again replaces itself."""

    def append(batch: DataFrame, batch_id: int) -> None:
        events = decode_any(batch, key_columns())
        events.write.mode("overwrite").option("compression", "zstd").partitionBy("topic").parquet(f"{path}/batch={batch_id}")

    return messages.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def whole(store: TopicStore, spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """(table_name, image): the current rows of several tables as JSON text, keys in the order of the columns."""

    def one(table: str) -> DataFrame:
        rows = store.current(spark, table)
        return rows.select(F.lit(table).alias("table_name"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("image"))

    return reduce(DataFrame.unionByName, [one(table) for table in tables])
