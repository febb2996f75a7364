"""Topics as logs of segment files, read by ranges of offsets: a Spark data source for batches and streams.

A log is a folder ``<root>/<topic>/<partition>/<base>-<end>.parquet``; a message's offset is
the base of its segment plus its position, as in a broker's log. So a listing alone tells where each
partition ends: a read is planned from it without a job, is cut into ranges of
about ``rows_per_task`` offsets, and shuffles nothing. Messages appended after the listing are
not seen.

    spark.dataSource.register(TopicLog)
    spark.read.format("topic_log").option("topics", "a,b").load(root)
    spark.readStream.format("topic_log").load(root)              # all topics of the log
    messages.write.format("topic_log").mode("append").save(root)  # (topic, partition, value)

Options: ``from`` and ``until`` are JSON objects topic -> partition -> offset; what
is left out counts from the start, or to the listed end. A task appends one segment per topic partition it
holds; the driver gives segments their offsets when all tasks are done, and renames them into place in order, so that a
reader sees a prefix of the append at any time. One writer at a time, as one broker leads a partition.

The root is a path or URI that Arrow's file systems reach (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from weirstone.layout import Lake
from weirstone.sources.tables import append_log, few_rows

MESSAGE = "topic STRING, partition INT, offset BIGINT, value STRING"
ROWS_PER_TASK = 50_000
ROW_GROUP = 10_000
STAGED = "_staged"

Offsets = dict[str, dict[str, int]]  # topic -> partition -> offset


@dataclass(frozen=True)
class Segment:
    path: str
    topic: str
    partition: int
    base: int
    end: int


def _files(root: str) -> tuple[fs.FileSystem, str]:
    found, path = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
    return found, path.rstrip("/")


def segments(root: str) -> list[Segment]:
    """The log's segments in order of offsets, from one listing."""
    files, path = _files(root)
    out = []
    for info in files.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)):
        parts = info.path[len(path) :].strip("/").split("/")
        if info.type == fs.FileType.File and len(parts) == 3 and parts[0] != STAGED and parts[2].endswith(".parquet"):
            base, end = parts[2].removesuffix(".parquet").split("-")
            out.append(Segment(info.path, parts[0], int(parts[1]), int(base), int(end)))
    return sorted(out, key=lambda s: (s.topic, s.partition, s.base))


def ends(found: list[Segment]) -> Offsets:
    """Where each partition ends: the offset its next message will get."""
    out: Offsets = {}
    for s in found:
        here = out.setdefault(s.topic, {})
        here[str(s.partition)] = max(here.get(str(s.partition), 0), s.end)
    return out


@dataclass
class Range(InputPartition):
    """Offsets ``low`` to ``high`` of one segment."""

    root: str
    path: str
    topic: str
    partition: int
    base: int
    low: int
    high: int


def plan(root: str, found: list[Segment], start: Offsets, end: Offsets, rows: int, topics: set[str] | None = None) -> list[Range]:
    """The ranges between two sets of offsets, each within one segment and about ``rows`` long."""
    out = []
    for s in found:
        if topics is not None and s.topic not in topics:
            continue
        low = max(s.base, start.get(s.topic, {}).get(str(s.partition), 0))
        high = min(s.end, end.get(s.topic, {}).get(str(s.partition), 0))
        pieces = max(1, -(-(high - low) // rows))
        for i in range(pieces if high > low else 0):
            cut = [low + (high - low) * k // pieces for k in (i, i + 1)]
            out.append(Range(root, s.path, s.topic, s.partition, s.base, *cut))
    return out


def read_range(part: Range) -> Iterator[pa.RecordBatch]:
    """Messages of a range; row groups outside it are not read."""
    files, _ = _files(part.root)
    with files.open_input_file(part.path) as handle:
        file = pq.ParquetFile(handle)
        at = part.base
        for group in range(file.num_row_groups):
            n = file.metadata.row_group(group).num_rows
            low, high = max(part.low, at), min(part.high, at + n)
            if low < high:
                values = file.read_row_group(group, columns=["value"]).column("value").slice(low - at, high - low)
                for chunk in values.chunks:
                    size = len(chunk)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(pa.scalar(part.topic, pa.string()), size),
                            pa.repeat(pa.scalar(part.partition, pa.int32()), size),
                            pa.array(np.arange(low, low + size), pa.int64()),
                            chunk.cast(pa.string()),
                        ],
                        ["topic", "partition", "offset", "value"],
                    )
                    low += size
            at += n


class _Options:
    def __init__(self, options: Mapping[str, str]):
        if not options.get("path"):
            raise ValueError("topic_log needs the folder of the log")
        self.root = options["path"]
        named = options.get("topics")
        self.topics = {t.strip() for t in named.split(",")} if named else None
        self.rows = int(options.get("rows_per_task", ROWS_PER_TASK))
        self.start: Offsets = json.loads(options.get("from", "{}"))
        self.until: Offsets | None = json.loads(options["until"]) if options.get("until") else None


class TopicLogReader(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> list[Range]:
        o = self.options
        found = segments(o.root)
        return plan(o.root, found, o.start, ends(found) if o.until is None else o.until, o.rows, o.topics)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from read_range(partition)


class TopicLogStream(DataSourceStreamReader):
    """Offsets of all partitions are the stream's offset; topics and partitions may appear while it runs."""

    def __init__(self, options: _Options):
        self.options = options

    def initialOffset(self) -> Offsets:  # noqa: N802 - Spark's name
        return self.options.start

    def latestOffset(self) -> Offsets:  # noqa: N802
        found = ends(segments(self.options.root))
        topics = self.options.topics
        return {t: o for t, o in found.items() if topics is None or t in topics}

    def partitions(self, start: Offsets, end: Offsets) -> list[Range]:
        o = self.options
        return plan(o.root, segments(o.root), start, end, o.rows, o.topics)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from read_range(partition)


@dataclass
class _Written(WriterCommitMessage):
    staged: list[tuple[str, int, int, str]] = field(default_factory=list)  # topic, partition, rows, file


class TopicLogWriter(DataSourceArrowWriter):
    def __init__(self, root: str):
        self.root, self.attempt = root, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        """One staged segment per run of messages of a topic partition; input sorted by it gives one each."""
        files, path = _files(self.root)
        folder = f"{path}/{STAGED}/{self.attempt}"
        files.create_dir(folder, recursive=True)
        done = _Written()
        schema = pa.schema([("value", pa.string())])
        key, rows, name, writer = None, 0, "", None

        def close() -> None:
            if writer is not None:
                writer.close()
                done.staged.append((*key, rows, name))

        for batch in iterator:
            topics, partitions = batch.column("topic").to_pylist(), batch.column("partition").to_pylist()
            values = batch.column("value").cast(pa.string())
            at = 0
            while at < batch.num_rows:
                here = (topics[at], partitions[at])
                end = at
                while end < batch.num_rows and (topics[end], partitions[end]) == here:
                    end += 1
                if here != key:
                    close()
                    key, rows, name = here, 0, f"{folder}/{uuid.uuid4().hex}.parquet"
                    writer = pq.ParquetWriter(files.open_output_stream(name), schema, compression="zstd")
                writer.write_table(pa.table([values.slice(at, end - at)], schema=schema), row_group_size=ROW_GROUP)
                rows += end - at
                at = end
        close()
        return done

    def commit(self, messages: list[_Written | None]) -> None:
        files, path = _files(self.root)
        at = ends(segments(self.root))
        for message in messages:
            for topic, partition, rows, name in message.staged if message else ():
                here = at.setdefault(topic, {})
                base = here.get(str(partition), 0)
                here[str(partition)] = base + rows
                files.create_dir(f"{path}/{topic}/{partition}", recursive=True)
                files.move(name, f"{path}/{topic}/{partition}/{base:020d}-{base + rows:020d}.parquet")
        self.abort(messages)

    def abort(self, messages: list[_Written | None]) -> None:
        files, path = _files(self.root)
        folder = f"{path}/{STAGED}/{self.attempt}"
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)


class TopicLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema) -> TopicLogReader:
        return TopicLogReader(_Options(self.options))

    def streamReader(self, schema) -> TopicLogStream:  # noqa: N802 - Spark's name
        return TopicLogStream(_Options(self.options))

    def writer(self, schema, overwrite: bool) -> TopicLogWriter:
        if overwrite:
            raise ValueError("a log is only appended to")
        return TopicLogWriter(_Options(self.options).root)


# Workers get the code of this module along with the source, so that nothing has to be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TopicLog)


def append(messages: DataFrame, root: str, tasks: int | None = None) -> None:
    """Append (topic, partition, value), and of each topic partition in the order of the column ``offset``.

    A topic partition is one task's, so a topic that grows needs more partitions, and the append as
    many ``tasks`` as there are topic partitions; without it their number is the session's.
    """
    register(messages.sparkSession)
    width = () if tasks is None else (tasks,)
    ordered = messages.repartition(*width, "topic", "partition").sortWithinPartitions("topic", "partition", "offset")
    ordered.select("topic", "partition", "value").write.format("topic_log").mode("append").save(root)


LEDGER = "topic STRING, partition BIGINT, from_offset BIGINT, until_offset BIGINT"


class LogReader:
    """A topic reader bounded by one snapshot of the log's ends, taken when it is made.

    ``rows`` answers how many messages a topic has from the offsets alone, so an empty topic is
    known without a job. ``record`` keeps the bounds in the lake's ledger; ``since`` starts a
    later reader where the ledger left off.
    """

    def __init__(self, root: str, since: Offsets | None = None, rows_per_task: int = ROWS_PER_TASK):
        self.root, self.rows_per_task = root, rows_per_task
        self.start = since or {}
        self.until = ends(segments(root))

    def rows(self, topic: str) -> int:
        start = self.start.get(topic, {})
        return sum(max(0, end - start.get(partition, 0)) for partition, end in self.until.get(topic, {}).items())

    def __call__(self, spark: SparkSession, topic: str) -> DataFrame:
        register(spark)
        reader = spark.read.format("topic_log").option("topics", topic).option("rows_per_task", str(self.rows_per_task))
        return reader.option("from", json.dumps(self.start)).option("until", json.dumps(self.until)).load(self.root)

    def record(self, spark: SparkSession, lake: Lake) -> None:
        rows = [
            (topic, int(partition), self.start.get(topic, {}).get(partition, 0), end)
            for topic, ends_ in self.until.items()
            for partition, end in ends_.items()
        ]
        if rows:
            append_log(lake, few_rows(spark, rows, LEDGER), ledger_path(lake))


def ledger_path(lake: Lake) -> str:
    return f"{lake.root}/bronze/_topic_ledger/"


def ledger_offsets(spark: SparkSession, lake: Lake) -> Offsets:
    """Where the last recorded read of each partition ended: a row per topic partition, however many reads there were."""
    out: Offsets = {}
    for row in lake.load(spark, ledger_path(lake)).groupBy("topic", "partition").agg({"until_offset": "max"}).collect():
        out.setdefault(row[0], {})[str(row[1])] = row[2]
    return out
