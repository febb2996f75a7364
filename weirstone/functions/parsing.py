"""Lenient parsing: a bad value becomes NULL, whatever the session's ANSI flag says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wire formats.
DIGITS = "^[0-9]+$"
ISO_DATE_OR_DATETIME = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?$"
US_DATE = "M/d/yyyy"
EDGE_QUOTES = r"""^["']|["']$"""
MILLIS_ABOVE = 10_000_000_000
SECONDS_ABOVE = 1_000_000

# Last whole second a microsecond timestamp can hold; beyond it the value is NULL.
_LAST_SECOND = 9_223_372_036_854


def _from_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(F.when(seconds <= _LAST_SECOND, seconds))


def _millis_to_seconds(text: Column) -> Column:
    return F.floor(text.try_cast("bigint") / F.lit(1000)).cast("bigint")


def whole(column: Column) -> Column:
    """Integer from text; decimals are truncated (``'3.7'`` -> 3), garbage is NULL."""
    return F.coalesce(
        column.try_cast("bigint"),
        column.try_cast("decimal(38,18)").try_cast("bigint"),
    )


def whole32(column: Column) -> Column:
    return whole(column).try_cast("int")


def real(column: Column) -> Column:
    """Number from text; NaN and the infinities are no amounts and become NULL, as garbage does."""
    value = column.try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def flag(column: Column) -> Column:
    return column.try_cast("boolean")


def epoch_or_timestamp(column: Column) -> Column:
    """All digits: epoch milliseconds cut to the second. Otherwise a timestamp literal."""
    text = column.cast("string")
    return F.when(text.rlike(DIGITS), _from_seconds(_millis_to_seconds(text))).otherwise(text.try_cast("timestamp"))


def any_timestamp(column: Column) -> Column:
    """As :func:`epoch_or_timestamp` on trimmed text.

    The timestamp cast already accepts every layout seen on the wire (ISO with
    zone and millis, ISO with zone, ISO bare, ``yyyy-MM-dd HH:mm:ss``), so no
    chain of patterns is tried row by row; the tests compare it to that chain.
    """
    return epoch_or_timestamp(F.trim(column.cast("string")))


def any_date(column: Column) -> Column:
    """US dates, ISO dates, ISO datetimes, and epoch millis / seconds / days told apart by size."""
    text = F.trim(F.regexp_replace(column.cast("string"), EDGE_QUOTES, ""))
    number = text.try_cast("bigint")
    epoch = (
        F.when(number > MILLIS_ABOVE, _from_seconds(_millis_to_seconds(text)).cast("date"))
        .when(number > SECONDS_ABOVE, _from_seconds(number).cast("date"))
        .otherwise(F.date_add(F.lit("1970-01-01").cast("date"), number.try_cast("int")))
    )
    return (
        F.when(text.contains("/"), F.try_to_timestamp(text, F.lit(US_DATE)).cast("date"))
        .when(text.rlike(ISO_DATE_OR_DATETIME), text.try_cast("timestamp").cast("date"))
        .when(text.rlike(DIGITS), epoch)
    )
