"""Predicates that give true or false, never NULL, plus aggregates over them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(predicate: Column) -> Column:
    """The predicate with NULL counted as false."""
    return F.coalesce(predicate, F.lit(False))


def is_not(predicate: Column) -> Column:
    """Negation under which a NULL comparison counts as a miss, so the row is kept."""
    return ~is_true(predicate)


def in_list(column: Column, values) -> Column:
    return is_true(column.isin(list(values)))


def above_up_to(column: Column, low, high) -> Column:
    """``low < column <= high``."""
    return (column > low) & (column <= high)


def on_days(ts: Column, first: dt.date, last: dt.date) -> Column:
    """Timestamps on the days ``first`` to ``last``, both included.

    Written as a half-open range on the bare column, so that it reaches the scan.
    """
    stop = last + dt.timedelta(days=1)
    return (ts >= F.lit(first)) & (ts < F.lit(stop))


def shorter_than(column: Column, n: int) -> Column:
    """Fewer than ``n`` code points; a missing text counts as empty."""
    return F.length(F.coalesce(column, F.lit(""))) < n


def share(predicate: Column) -> Column:
    """Share of all rows, NULL ones included, for which the predicate holds."""
    return F.avg(is_true(predicate).cast("double"))


def holds_for_all(predicate: Column) -> Column:
    """Whether the predicate holds on every row; true over no rows."""
    return F.coalesce(F.bool_and(is_true(predicate)), F.lit(True))
