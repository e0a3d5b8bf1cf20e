"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names for Spark's dayofweek numbering (1 = Sunday).
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def rate(numerator: Column, denominator: Column) -> Column:
    """Ratio that is 0 where the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def ladder(value: Column, steps: list[tuple[object, str]], below: str) -> Column:
    """Label of the first step whose lower bound the value reaches."""
    (bound, label), *rest = steps
    branches = F.when(value >= bound, label)
    for bound, label in rest:
        branches = branches.when(value >= bound, label)
    return branches.otherwise(below)


def day_name(day_of_week: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, DAY_NAMES)), day_of_week)


def cents(amount: Column) -> Column:
    """Two-decimal money as whole cents, so that sums do not depend on row order.

    Amounts are rounded to cents one by one; NaN, infinities and amounts beyond
    a long count as NULL.
    """
    return F.rint(amount * 100).try_cast("long")


def money_sum(amount: Column) -> Column:
    return F.sum(cents(amount)) / 100


def money_avg(amount: Column) -> Column:
    return money_sum(amount) / F.count(amount)


def distinct_count(column: str, exact: bool = True) -> Column:
    return F.count_distinct(F.col(column)) if exact else F.approx_count_distinct(column)
