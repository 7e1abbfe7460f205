"""Running totals over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed


def block_of(column: str, block: int) -> Column:
    """The number of the block of ``block`` consecutive integers that holds a value, in whole numbers throughout."""
    return F.expr(f"(`{column}` - pmod(`{column}`, {int(block)})) div {int(block)}")


def running_total(
    df: DataFrame, keys: list[str], order: list[str], weight: Column, name: str, total: str | None = None
) -> DataFrame:
    """Exact running total of ``weight`` within ``keys`` along ``order``.

    The rows are range-partitioned by key and order, so a large group spreads
    over many slices. Each slice adds up its own rows, and the totals of the
    slices before it, a few rows per slice, are joined back. The checkpoint
    fixes which slice a row belongs to. ``keys`` + ``order`` must be unique.
    ``total`` names a column for the sum over the whole group.
    """
    cut = checkpointed(
        df.withColumn("_weight", weight)
        .repartitionByRange(*keys, *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    totals = cut.groupBy(*keys, "_slice").agg(F.sum("_weight").alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        F.col("_slice").alias("_in"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_total").over(Window.partitionBy(*keys)).alias("_whole"),
    )
    inside = (
        Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = F.col("_slice") == F.col("_in")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    return (
        cut.withColumn("_inside", F.sum("_weight").over(inside))
        .join(before, same)
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .select(*df.columns, name, *([F.col("_whole").alias(total)] if total else []))
    )
