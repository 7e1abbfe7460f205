"""Questions on one vector of numbers, held as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import share
from tidemark.operators.stats import percentiles


def mean_minus(df: DataFrame, val: str, amount) -> DataFrame:
    return df.agg((F.avg(val) - F.lit(amount)).alias("mean_minus"))


def ascending(df: DataFrame, val: str) -> DataFrame:
    """The values in order; equal ones are spread over tasks by where they were read."""
    return df.select(val).orderBy(val, F.monotonically_increasing_id()).select(val)


def median_and_percentile(df: DataFrame, val: str, p: float = 0.04) -> DataFrame:
    return percentiles(df, val, {"median": 0.5, "percentile": p})


def share_above(df: DataFrame, val: str, bound) -> DataFrame:
    return df.agg(share(F.col(val) > bound).alias("share"))


def deviation(df: DataFrame, val: str) -> DataFrame:
    return df.agg(F.stddev_pop(val).alias("std"))
