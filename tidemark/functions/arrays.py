"""Expressions on array columns: one series or one matrix row per table row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def negate_between(values: Column, low, high) -> Column:
    return F.transform(values, lambda x: F.when(x.between(low, high), -x).otherwise(x))


def blank_first_max(values: Column, filler=0) -> Column:
    """The first occurrence of the maximum replaced by ``filler``."""
    at = F.array_position(values, F.array_max(values)) - 1
    return F.transform(values, lambda x, i: F.when(i == at, F.lit(filler)).otherwise(x))


def first_max_index(values: Column) -> Column:
    """Zero-based position of the first maximum."""
    return F.array_position(values, F.array_max(values)) - 1


def not_all_equal(values: Column) -> Column:
    return F.array_min(values) != F.array_max(values)


def covers_rows(values: Column, wanted_rows: Column) -> Column:
    """Whether, for each wanted row, exactly as many cells of ``values`` lie in it as it is long."""
    return F.forall(
        wanted_rows,
        lambda row: F.size(F.filter(values, lambda x: F.array_contains(row, x))) == F.size(row),
    )


def same_multiset(a: Column, b: Column) -> Column:
    return F.array_sort(a) == F.array_sort(b)


def row_products(*rows: Column) -> Column:
    """All combinations of one element per row, the first row varying slowest."""
    start = F.transform(rows[0], lambda x: F.array(x))
    return reduce(
        lambda done, row: F.flatten(
            F.transform(done, lambda head: F.transform(row, lambda x: F.concat(head, F.array(x))))
        ),
        rows[1:],
        start,
    )


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def after_zero_max(values: Column) -> Column:
    """Largest element whose predecessor is 0; NULL if there is none."""
    return F.array_max(F.filter(values, lambda x, i: F.get(values, i - 1) == 0))


def words(text: Column) -> Column:
    """Distinct lower-case tokens of letters and digits."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), "[^\\p{L}\\p{N}]+")), "")
