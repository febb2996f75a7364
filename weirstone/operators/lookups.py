"""Left lookups of surrogate keys in dimensions and other facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirstone.operators.keys import UNKNOWN_KEY

# Rows without a real key are scattered over this many join keys.
SCATTER = 4096


def resolve(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    take: Mapping[str, str],
    scatter_by: str | None = None,
) -> DataFrame:
    """Left-join surrogate keys onto facts; ``take`` maps dimension column -> new
    fact column, its first entry being the dimension's own key. Misses become -1.

    The dimension's UNKNOWN row takes no part in the match, so a real value
    that happens to read UNKNOWN cannot double fact rows. There is no
    broadcast hint: dimensions such as customers grow with the data. A stored
    dimension under the planner's threshold is broadcast because its file size
    is known; otherwise the join shuffles and adaptive execution splits hot
    keys. ``scatter_by`` names a column by which the rows without a key are
    spread, for facts where they are a large share.
    """
    (surrogate, *_) = take
    match = F.col(fact_key)
    if scatter_by is not None:
        match = scattered(match, by=F.col(scatter_by))
    right = dimension.where(F.col(surrogate) != UNKNOWN_KEY).select(
        F.col(dimension_key).alias("_match"),
        *[F.col(source).alias(f"_got_{target}") for source, target in take.items()],
    )
    found = [
        F.coalesce(F.col(f"_got_{target}"), F.lit(UNKNOWN_KEY)).cast("bigint").alias(target)
        for target in take.values()
    ]
    return facts.join(right, match == F.col("_match"), "left").select(*facts.columns, *found)


def scattered(key: Column, by: Column) -> Column:
    """Join key under which rows without a real key do not all meet in one task.

    A key that is NULL or negative matches nothing, yet a shuffle join would
    send all such rows to one partition. They get one of 4096 keys below -1.
    """
    stand_in = F.lit(-2).cast("bigint") - F.pmod(F.xxhash64(by), F.lit(SCATTER))
    return F.when(key >= 0, key.cast("bigint")).otherwise(stand_in)
