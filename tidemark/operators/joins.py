"""Joins in which one key of the other side may hold a large part of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_join_many(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """Left join of a table with a unique key to a table in which a key may be hot.

    Adaptive execution cannot split the side that an outer join fills with
    NULL. The inner part can be split there, and the rows without a match are
    found against the distinct keys.
    """
    matched = one.join(many, key)
    alone = without(one, many, key)
    return matched.unionByName(alone, allowMissingColumns=True)


def having(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``other``, which travels as distinct keys."""
    return df.join(other.select(key).distinct(), key, "left_semi")


def without(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``other``, which travels as distinct keys."""
    return df.join(other.select(key).distinct(), key, "left_anti")
