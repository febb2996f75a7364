"""Surrogate keys and the UNKNOWN member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN_KEY = -1
UNKNOWN = "UNKNOWN"

# A key is bucket * 2^36 + position: 16 + 36 = 52 bits, exact even as a double.
BUCKET_HEX_DIGITS = 4
POSITION_BITS = 36


def surrogate_key(df: DataFrame, name: str, business_key: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """Prepend a unique bigint key >= 1 that depends on the data alone.

    Rows are spread over 65,536 buckets by a digest of their business key and
    numbered within the bucket. So there is one shuffle, evenly loaded because
    business keys are (nearly) unique, no global sort, no count first and no
    cached frame; and a lost executor, a retry or a re-run on another cluster
    yields the same keys, which a partition-numbered id would not.
    ``ties`` orders rows that share a business key and spreads them too.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*business_key, *ties)]
    digest = F.md5(F.concat_ws("|", *parts))
    bucket = F.conv(F.substring(digest, 1, BUCKET_HEX_DIGITS), 16, 10).cast("bigint")
    window = Window.partitionBy("_bucket").orderBy(*business_key, *ties)
    return (
        df.withColumn("_bucket", bucket)
        .withColumn("_position", F.row_number().over(window))
        .select((F.shiftleft("_bucket", POSITION_BITS) + F.col("_position")).alias(name), *df.columns)
    )


PARTITION_BITS = 33


def dense_key(stored: DataFrame, name: str) -> DataFrame:
    """Prepend a key 1, 2, 3, ... without moving a row: counts per task, their exclusive prefix sum, position in the task.

    ``stored`` must be a stored table, so that every reading of it deals the same rows to
    the same tasks. Only the counts are shuffled, one row per task; they are broadcast, 16 bytes a
    task. Unlike :func:`surrogate_key` the keys depend on the table's files and splits, not on the data alone.
    """
    placed = stored.withColumn("_place", F.monotonically_increasing_id())
    task = F.shiftright("_place", PARTITION_BITS)
    counts = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per task of a scan in one window: bounded by the number of tasks
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    position = F.col("_place").bitwiseAND(F.lit((1 << PARTITION_BITS) - 1)) + 1
    return (
        placed.withColumn("_task", task)
        .join(F.broadcast(starts), "_task")
        .select((F.col("_start") + position).alias(name), *stored.columns)
    )


def with_unknown(dimension: DataFrame, key: str, values: Mapping[str, Column | str | bool | int]) -> DataFrame:
    """Append the -1 member; columns not given are NULL."""
    given = {key: UNKNOWN_KEY, **values}
    member = dimension.sparkSession.range(1).select(
        *[
            (given[f.name] if isinstance(given.get(f.name), Column) else F.lit(given.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in dimension.schema
        ]
    )
    return dimension.unionByName(member)
