"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirstone.functions.cleaning import date_key

# The calendar used when there is no dated row at all.
DEFAULT_FIRST_DAY = "2016-01-01"
DEFAULT_LAST_DAY = "2020-12-31"


def date_spine(dated: DataFrame, column: str) -> DataFrame:
    """One row per day from 1 January of the first year to 31 December of the last."""
    span = dated.agg(F.year(F.min(column)).alias("first_year"), F.year(F.max(column)).alias("last_year"))
    first = F.coalesce(F.make_date("first_year", F.lit(1), F.lit(1)), F.lit(DEFAULT_FIRST_DAY).cast("date"))
    last = F.coalesce(F.make_date("last_year", F.lit(12), F.lit(31)), F.lit(DEFAULT_LAST_DAY).cast("date"))
    return span.select(F.explode(F.sequence(first, last)).alias("day"))


def calendar(days: DataFrame) -> DataFrame:
    day = F.col("day")
    return days.select(
        date_key(day).alias("date_sk"),
        day.cast("timestamp").alias("full_date"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.concat_ws("-Q", F.year(day), F.quarter(day)).alias("year_quarter"),
    )
