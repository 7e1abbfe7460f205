"""Reading a change log as the table it describes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import moment
from tidemark.operators.ranking import first_per_key


def state_as_of(
    log: DataFrame, keys: list[str], ts: str, order: list[str], as_of: dt.datetime, deleted: Column
) -> DataFrame:
    """The last row per key with ``ts <= as_of``, keys whose last row is a deletion left out."""
    seen = log.filter(F.col(ts) <= moment(as_of))
    last = first_per_key(seen, keys, F.desc(ts), *[F.desc(c) for c in order])
    return last.filter(~F.coalesce(deleted, F.lit(False)))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """The rows that stay; a NULL comparison deletes nothing."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def restore_where(current: DataFrame, old: DataFrame, predicate: Column, keys: list[str]) -> DataFrame:
    """The current rows plus those old ones that match and are missing now."""
    back = old.filter(predicate).join(current.select(*keys), keys, "left_anti")
    return current.unionByName(back.select(*current.columns))
