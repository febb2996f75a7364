"""Table storage: measured overwrites, appended logs."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Sequence
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weirstone.layout import Lake

log = logging.getLogger(__name__)

# Columns of the metrics table. error_message is a heading of at most 500 characters, error_detail the whole text.
METRIC_SCHEMA = (
    "run_id STRING, layer STRING, table_name STRING, row_count BIGINT, duration_sec DOUBLE, "
    "status STRING, error_message STRING, error_detail STRING, recorded_at STRING"
)
ERROR_LENGTH = 500

_ARROW_TYPES = {"STRING": pa.string(), "BIGINT": pa.int64(), "DOUBLE": pa.float64(), "BOOLEAN": pa.bool_()}

# Two appends into one parquet folder share its commit staging area, so
# threads of one driver take turns.
_append_turn = threading.Lock()


def few_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of driver-made rows (log lines, summaries) as a local relation."""
    fields = [column.split() for column in schema.split(", ")]
    columns = {
        name: pa.array([row[i] for row in rows], _ARROW_TYPES[kind]) for i, (name, kind) in enumerate(fields)
    }
    return spark.createDataFrame(pa.table(columns))


def append_log(lake: Lake, rows: DataFrame, path: str) -> None:
    """Append a few log rows as one file."""
    with _append_turn:
        rows.coalesce(1).write.format(lake.storage).mode("append").save(path)


def remove(spark: SparkSession, path: str) -> None:
    """Take back a folder of tables that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def now_text() -> str:
    """Now, in a form that sorts."""
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")


def metric(
    layer: str, table: str, row_count: int, seconds: float, status: str = "success", error: str = ""
) -> tuple:
    """One row of the metrics table, stamped now."""
    now = datetime.now(timezone.utc)
    return (
        now.isoformat(),
        layer,
        table,
        int(row_count),
        round(float(seconds), 2),
        status,
        error[:ERROR_LENGTH],
        error,
        now.strftime("%Y-%m-%d %H:%M:%S"),
    )


def record_metrics(spark: SparkSession, lake: Lake, metrics: Sequence[tuple]) -> None:
    """Append metric rows. A broken metrics store must not break the job, so nothing is raised."""
    if not metrics:
        return
    try:
        append_log(lake, few_rows(spark, metrics, METRIC_SCHEMA), lake.metrics_path)
    except Exception:
        log.warning("%d metric rows not recorded", len(metrics), exc_info=True)


AUDIT_COLUMNS = ("processed_at", "etl_loaded_at")


def content_digest(df: DataFrame) -> list[Column]:
    """Aggregates over all rows that tell contents apart whatever the order of the rows: their hashes' sum and exclusive or."""
    columns = [F.col(f"`{c}`") for c in df.columns if c not in AUDIT_COLUMNS]
    # a NULL leaves a hash as it is, so where the NULLs are is hashed, too
    row = F.xxhash64(*columns, F.concat(*[c.isNull().cast("string") for c in columns]))
    return [F.sum(row.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(row).alias("hash_xor")]


def replace_table(
    spark: SparkSession,
    lake: Lake,
    df: DataFrame,
    layer: str,
    table: str,
    metrics: list[tuple] | None = None,
    digests: dict[tuple[str, str], str] | None = None,
) -> int:
    """Overwrite a table, data and schema, and record the write. Returns the row count.

    The rows are counted by an observation riding on the write itself, so the
    plan runs once; a digest of the content rides along if ``digests`` is there to take it. The metric
    row is appended at once, or left in ``metrics`` for a caller that writes many tables and records them together.
    """
    started = time.monotonic()
    seen = Observation()

    def record(*outcome) -> None:
        row = metric(layer, table, *outcome)
        if metrics is None:
            record_metrics(spark, lake, [row])
        else:
            metrics.append(row)

    try:
        measures = [F.count(F.lit(1)).alias("rows"), *(content_digest(df) if digests is not None else ())]
        writer = df.observe(seen, *measures).write.format(lake.storage).mode("overwrite")
        if lake.storage == "delta":
            writer = writer.option("overwriteSchema", "true")
        if lake.storage == "parquet":
            writer = writer.option("compression", "zstd")
        writer.save(lake.path(layer, table))
        got = seen.get
        rows = got["rows"]
    except Exception as problem:
        record(0, time.monotonic() - started, "failed", str(problem))
        raise
    if digests is not None:
        digests[layer, table] = f"{rows}:{got['hash_sum']}:{got['hash_xor']}"
    record(rows, time.monotonic() - started)
    return rows
