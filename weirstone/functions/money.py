"""Exact sums and averages of amounts.

Amounts are NUMERIC(…,2) at the source and doubles from the silver layer on.
Adding doubles gives a result that depends on the order of the partitions, so
amounts are added as whole cents (bigint, one addition inside code generation)
and turned back at the end. A bigint holds 9e16 units of currency.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(column: Column) -> Column:
    return F.rint(column * 100).try_cast("bigint")  # what no bigint holds is NULL and does not stop a report


def total(column: Column) -> Column:
    return from_cents(F.sum(cents(column)))


def from_cents(column: Column) -> Column:
    return column / F.lit(100.0)


def quotient(part: Column, whole: Column, digits: int) -> Column:
    """part / whole for whole numbers, rounded half up on the exact value; NULL if whole is 0."""
    exact = F.try_divide(part.cast("decimal(25,2)"), whole.cast("decimal(15,0)"))
    return F.round(exact, digits).cast("double")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return quotient(part * 100, whole, digits)


def mean_of(cents_sum: Column, count: Column, digits: int | None = None) -> Column:
    """Average in currency units from a sum of cents; rounded only when asked."""
    if digits is None:
        return F.try_divide(cents_sum.cast("double"), count * F.lit(100.0))
    return quotient(cents_sum.cast("decimal(25,2)") / F.lit(100).cast("decimal(3,0)"), count, digits)


def mean(column: Column, digits: int | None = None) -> Column:
    return mean_of(F.sum(cents(column)), F.count(cents(column)), digits)
