"""Change topics: bounded reads, envelope decoding, ingestion into bronze."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirstone.layout import Lake
from weirstone.schemas import SOURCE_TABLES, TABLE_OF_TOPIC, SourceTable
from weirstone.session import side_by_side
from weirstone.sources.tables import few_rows, record_metrics, replace_table

# A reader returns at least (topic, value); with an ``offset`` column too,
# changes of one key that share a millisecond keep their log order.
TopicReader = Callable[[SparkSession, str], DataFrame]

BRONZE_COLUMNS = ("topic", "before", "after", "op", "ts_ms", "log_offset")


def kafka_reader(servers: str, min_partitions: int | None = None) -> TopicReader:
    """Whole topic, earliest to latest.

    ``min_partitions`` makes the source itself cut big topic partitions into
    smaller offset ranges, so a one-partition topic still parses in parallel
    and nothing is shuffled to get there.
    """

    def read(spark: SparkSession, topic: str) -> DataFrame:
        options = {
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": "earliest",
            "endingOffsets": "latest",
        }
        if min_partitions:
            options["minPartitions"] = str(min_partitions)
        return spark.read.format("kafka").options(**options).load()

    return read


def folder_reader(folder: str, storage: str = "json") -> TopicReader:
    """Messages saved as files with the columns a Kafka read would have."""
    message = "topic STRING, value STRING, offset BIGINT"

    def read(spark: SparkSession, topic: str) -> DataFrame:
        return spark.read.schema(message).format(storage).load(f"{folder}/{topic}")

    return read


def envelope_type(source: SourceTable) -> T.StructType:
    """Both envelope shapes in one schema: wrapped in ``payload``, or bare."""
    event = T.StructType(
        [
            T.StructField("before", source.image),
            T.StructField("after", source.image),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )
    return T.StructType([T.StructField("payload", event), *event.fields])


def decode(messages: DataFrame, table: str) -> DataFrame:
    """Message text -> before / after / op / ts_ms. Unreadable text yields NULLs, not an error."""
    offset = F.col("offset").cast("bigint") if "offset" in messages.columns else F.lit(None).cast("bigint")
    parsed = messages.select(
        "topic",
        offset.alias("log_offset"),
        F.from_json(F.col("value").cast("string"), envelope_type(SOURCE_TABLES[table])).alias("event"),
    )

    def either(name: str):
        return F.coalesce(F.col(f"event.payload.{name}"), F.col(f"event.{name}")).alias(name)

    return parsed.select("topic", either("before"), either("after"), either("op"), either("ts_ms"), "log_offset")


def ingest_table(
    spark: SparkSession, lake: Lake, reader: TopicReader, table: str, metrics: list[tuple] | None = None
) -> int | None:
    """Replace one bronze table from its topic; an empty topic leaves the table alone (None).

    A reader that knows its offsets (``rows``) says so itself; of another one the first message is asked for.
    """
    if table not in SOURCE_TABLES:
        raise KeyError(f"unknown topic or table: {table}")
    topic = SOURCE_TABLES[table].topic
    counted = getattr(reader, "rows", None)
    if counted is not None and not counted(topic):
        return None
    messages = reader(spark, topic)
    if counted is None and messages.isEmpty():
        return None
    return replace_table(spark, lake, decode(messages, table), "bronze", table, metrics)


def ingest(
    spark: SparkSession,
    lake: Lake,
    reader: TopicReader,
    topics: Iterable[str] | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Ingest the topics, a few at a time; a failing topic does not stop the others.

    Returns one row per topic: (topic, status, rows, error) with status
    ``loaded``, ``empty`` or ``failed``. An unknown topic raises at once.
    """
    names = list(SOURCE_TABLES) if topics is None else [TABLE_OF_TOPIC[topic] for topic in topics]

    metrics: list[tuple] = []

    def outcome(name: str) -> tuple[str, str, int | None, str | None]:
        topic = SOURCE_TABLES[name].topic
        try:
            rows = ingest_table(spark, lake, reader, name, metrics)
        except Exception as problem:  # isolation between topics is the point
            return topic, "failed", None, str(problem)
        return topic, "empty" if rows is None else "loaded", rows, None

    try:
        outcomes = side_by_side(spark, outcome, names, parallel)
    finally:
        record_metrics(spark, lake, metrics)
    return few_rows(spark, outcomes, "topic STRING, status STRING, rows BIGINT, error STRING")


def require_all_loaded(summary: DataFrame) -> None:
    """Turn a summary with failures into an error naming the failed topics."""
    failed = [row.topic for row in summary.where(F.col("status") == "failed").collect()]
    if failed:
        raise RuntimeError("failed topics: " + ", ".join(failed))
