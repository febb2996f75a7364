"""Cleaning and derivation expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region of each state.
STATE_REGION = {
    "SP": "SUDESTE",
    "RJ": "SUDESTE",
    "MG": "SUDESTE",
    "ES": "SUDESTE",
    "PR": "SUL",
    "SC": "SUL",
    "RS": "SUL",
    "MT": "CENTRO-OESTE",
    "MS": "CENTRO-OESTE",
    "GO": "CENTRO-OESTE",
    "DF": "CENTRO-OESTE",
    "BA": "NORDESTE",
    "SE": "NORDESTE",
    "AL": "NORDESTE",
    "PE": "NORDESTE",
    "PB": "NORDESTE",
    "RN": "NORDESTE",
    "CE": "NORDESTE",
    "PI": "NORDESTE",
    "MA": "NORDESTE",
    "AM": "NORTE",
    "PA": "NORTE",
    "AC": "NORTE",
    "RO": "NORTE",
    "RR": "NORTE",
    "AP": "NORTE",
    "TO": "NORTE",
}
OTHER_REGION = "OUTROS"

# Class of each order status.
STATUS_CLASS = {
    "DELIVERED": "COMPLETED",
    "SHIPPED": "IN_PROGRESS",
    "INVOICED": "IN_PROGRESS",
    "PROCESSING": "IN_PROGRESS",
    "APPROVED": "IN_PROGRESS",
    "CREATED": "PENDING",
    "CANCELED": "FAILED",
    "UNAVAILABLE": "FAILED",
}
OTHER_STATUS = "OTHER"

# Exclusive upper bounds of the size (cm3) and weight (g) classes.
SIZE_CLASSES = ((1000, "SMALL"), (10000, "MEDIUM"), (50000, "LARGE"), (None, "EXTRA_LARGE"))
WEIGHT_CLASSES = ((500, "LIGHT"), (2000, "MEDIUM"), (10000, "HEAVY"), (None, "VERY_HEAVY"))


def text(column: Column) -> Column:
    return F.trim(column)


def code(column: Column) -> Column:
    return F.upper(F.trim(column))


def has_text(*columns: Column) -> Column:
    """TRUE if any of the columns holds more than blanks; never NULL."""
    return reduce(or_, [F.coalesce(F.trim(c) != "", F.lit(False)) for c in columns])


def mapped(column: Column, table: Mapping[str, str], default: str) -> Column:
    """Look the value up in a small constant table."""
    entries = F.create_map(*[F.lit(item) for pair in table.items() for item in pair])
    return F.coalesce(F.try_element_at(entries, column), F.lit(default))


def region_of(state: Column) -> Column:
    return mapped(state, STATE_REGION, OTHER_REGION)


def status_class(status: Column) -> Column:
    return mapped(status, STATUS_CLASS, OTHER_STATUS)


def banded(column: Column, bands: Sequence[tuple[int | None, str]], default: str = "UNKNOWN") -> Column:
    """First band whose upper bound exceeds the value; NULL falls to the default."""
    bounds = [F.when(column < limit if limit is not None else column.isNotNull(), label) for limit, label in bands]
    return F.coalesce(*bounds, F.lit(default))


def score_label(score: Column, when_missing: str) -> Column:
    """4 and up POSITIVE, 3 NEUTRAL, 2 and down NEGATIVE."""
    return (
        F.when(score.isNull(), when_missing)
        .when(score >= 4, "POSITIVE")
        .when(score == 3, "NEUTRAL")
        .otherwise("NEGATIVE")
    )


def indicator(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient, NULL unless the denominator is positive."""
    return F.when(denominator > 0, F.round(F.try_divide(numerator, denominator), digits))


def item_total(price: Column, freight: Column) -> Column:
    """What an order item costs with its freight."""
    return price + freight


def installment(amount: Column, count: Column) -> Column:
    """Amount per installment, or the whole amount where there are none."""
    return F.coalesce(ratio(amount, count, 2), amount)


def product_of(*columns: Column) -> Column:
    """Product as bigint, NULL if any factor is or if it does not fit."""
    result = columns[0].cast("bigint")
    for column in columns[1:]:
        result = F.try_multiply(result, column.cast("bigint"))
    return result


def hours_between(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.round(micros / F.lit(3_600_000_000.0), 2)


def date_key(column: Column) -> Column:
    """yyyyMMdd as int."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("int")
