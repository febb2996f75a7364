"""Change topics as streams, one by one: sources, and append to bronze. ``store`` keeps all topics with one stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from weirstone.sources.changes import decode

MESSAGE = "topic STRING, value STRING, offset BIGINT"


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None) -> DataFrame:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def folder_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Messages arriving as JSON files."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder)


def append_bronze(
    messages: DataFrame, table: str, path: str, checkpoint: str, storage: str = "parquet"
) -> StreamingQuery:
    """Decode and append whatever has arrived since the last run, then stop."""
    return (
        decode(messages, table)
        .writeStream.format(storage)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
