"""Top-k, ranks with ties, first rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ordering import down, up


def top_k(df: DataFrame, k: int, *order: str | Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def highest_levels(df: DataFrame, measure: str, k: int, rank: str = "rank") -> DataFrame:
    """Rows holding one of the ``k`` highest distinct values, with their dense rank.

    Only the ``k`` distinct values are ranked; ties of any number stay spread
    over the cluster and meet their rank in a join with at most ``k`` rows.
    """
    levels = df.select(measure).filter(F.col(measure).isNotNull()).distinct().orderBy(F.desc(measure)).limit(k)
    ordered = levels.agg(F.sort_array(F.collect_list(measure), asc=False).alias("levels"))
    ranked = ordered.select(F.posexplode("levels").alias("at", measure)).select(
        measure, (F.col("at") + 1).alias(rank)
    )
    return df.join(F.broadcast(ranked), measure)


def reaching_kth(df: DataFrame, measure: str, k: int) -> DataFrame:
    """Rows whose value reaches that of the ``k``-th highest row; all rows if there are fewer.

    The same rows as ``rank() <= k``, through a scalar threshold instead of a
    window over the whole input.
    """
    top = df.select(measure).filter(F.col(measure).isNotNull()).orderBy(F.desc(measure)).limit(k)
    return df.filter(F.col(measure) >= top.agg(F.min(measure)).scalar())


def first_per_key(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The first row of each key in the given order; NULL keys form a group of their own.

    The rank is used for nothing but the filter, so Spark keeps one row per key
    of every input partition before the shuffle (``WindowGroupLimit``), and a
    key that holds a large part of the rows arrives as a few.
    """
    along = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(along)).filter(F.col("_rank") == 1).drop("_rank")


def largest_group(counts: DataFrame, label: str, size: str) -> DataFrame:
    """The label of the largest group, the first label on a tie."""
    return counts.orderBy(down(size), up(label)).limit(1)


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Rows per value, missing values left out, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), F.asc(column))
    )


def most_frequent(df: DataFrame, column: str, id_column: str, k: int, name: str = "count") -> DataFrame:
    """The ``k`` most frequent values of a wide text column.

    Texts are counted by digest, so the shuffle carries 64 characters per
    distinct text; the texts of the ``k`` winners are fetched afterwards by
    the smallest id that holds each of them. Ties go to the smaller id.
    """
    counted = df.groupBy(F.sha2(F.col(column), 256).alias("digest")).agg(
        F.count(F.lit(1)).alias(name), F.min(id_column).alias(id_column)
    )
    winners = counted.orderBy(F.desc(name), F.asc(id_column)).limit(k).select(id_column, name)
    return (
        df.select(id_column, column)
        .join(F.broadcast(winners), id_column)
        .orderBy(F.desc(name), F.asc(id_column))
        .select(column, name)
    )
