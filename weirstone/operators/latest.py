"""Change events -> current rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest_first(df: DataFrame, ts: str) -> list[Column]:
    """Newest event first. Events of one millisecond follow the log; failing that, their content."""
    content = F.xxhash64("op", "after")
    if "log_offset" not in df.columns:
        return [F.col(ts).desc_nulls_last(), content.desc()]
    offset = F.col("log_offset")
    return [F.col(ts).desc_nulls_last(), offset.desc_nulls_last(), F.when(offset.isNull(), content).desc()]


def first_per(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under the given order."""
    # Kept as a rank filter: the optimiser turns it into a group limit that
    # runs before the shuffle too, so each map task sends one event per key
    # however often a hot key changed.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def latest_events(changes: DataFrame, keys: Sequence[str], ts: str = "ts_ms") -> DataFrame:
    """Newest event per business key, deletes included, in the columns of the feed.

    The key is read from ``after``, or for a delete from ``before``.
    """
    named = changes.withColumns({f"_key{i}": F.coalesce(f"after.{k}", f"before.{k}") for i, k in enumerate(keys)})
    newest = first_per(named, [f"_key{i}" for i in range(len(keys))], _newest_first(named, ts))
    return newest.select(*changes.columns)


def latest_images(changes: DataFrame, keys: Sequence[str], ts: str = "ts_ms") -> DataFrame:
    """Latest ``after`` image per business key.

    With a ``before`` image deletes count: a key whose newest event is a
    delete is gone, and comes back if it is inserted again later. Without one
    a delete cannot name its key, so deletes are merely skipped.
    """
    if "before" in changes.columns:
        return latest_events(changes, keys, ts).where(F.col("op") != "d").select("after.*")
    alive = changes.where(F.col("op") != "d")
    newest = first_per(alive, [F.col(f"after.{k}") for k in keys], _newest_first(alive, ts))
    return newest.select("after.*")


def latest_rows(changes: DataFrame, keys: Sequence[str], ts: str = "ts_ms") -> DataFrame:
    """As :func:`latest_images` for events whose columns are not nested: all columns but ``ts`` stay."""
    alive = changes.where(F.col("op") != "d")
    rest = [F.col(c).desc() for c in alive.columns if c not in (ts, *keys)]
    order = [F.col(ts).desc_nulls_last(), *rest]
    return first_per(alive, keys, order).drop(ts)


def images(changes: DataFrame) -> DataFrame:
    """Every image that is not a delete, updates included: for tables that are not reduced per key."""
    return changes.where(F.col("op") != "d").select("after.*")
