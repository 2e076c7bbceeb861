"""Aggregate expressions with the null rules the reports rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def total(value: Column | str) -> Column:
    """Sum that is 0, not null, when there is nothing to add."""
    return F.coalesce(F.sum(_col(value)), F.lit(0))


def total_where(condition: Column, value: Column | str) -> Column:
    """Sum over the rows that meet a condition; 0 when none does."""
    return F.coalesce(F.sum(F.when(condition, _col(value))), F.lit(0))


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; null comparisons do not count."""
    return F.count_if(condition)


def distinct_values(value: Column | str) -> Column:
    """Distinct count in which null is one more value."""
    column = _col(value)
    return F.count_distinct(column) + F.coalesce(
        F.max(F.when(column.isNull(), F.lit(1)).otherwise(F.lit(0))), F.lit(0)
    )


def is_single_valued(value: Column | str) -> Column:
    """True when the group holds exactly one value, null being a value.

    Minimum, maximum and a count say so without a distinct aggregate, which would
    multiply the rows once per column checked.
    """
    column = _col(value)
    filled = F.count(column)
    return (filled == 0) | ((filled == F.count(F.lit(1))) & (F.min(column) == F.max(column)))


def all_true(condition: Column) -> Column:
    """True over no rows; a null comparison is left out."""
    return F.coalesce(F.bool_and(condition), F.lit(True))
