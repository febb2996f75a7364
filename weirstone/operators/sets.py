"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_values(column: str, *frames: DataFrame) -> DataFrame:
    """Distinct non-NULL values of a column over several frames.

    Partial aggregation keeps one row per value and task before the shuffle,
    so a value that fills a third of the rows costs no more than a rare one.
    """
    union = None
    for frame in frames:
        values = frame.select(column).where(F.col(column).isNotNull())
        union = values if union is None else union.union(values)
    return union.distinct()
