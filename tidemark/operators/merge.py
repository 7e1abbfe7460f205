"""Insert-only and additive merges as joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import greatest_or_null
from tidemark.operators.ranking import first_per_key

# Rows of a batch whose key hashes, eight bytes each, may be broadcast to a scan of the target.
BROADCAST_KEYS = 500_000


def absent_from(batch: DataFrame, target: DataFrame, key: str, batch_rows: int | None = None) -> DataFrame:
    """Batch rows whose key the target lacks; a NULL key is never found.

    Of a small batch the 64-bit hashes of the keys are sent to the target's
    key column, so the target is scanned in place and only the keys that may
    match travel to the exact anti-join; a larger batch shuffles both sides.
    """
    known = target.select(key)
    if batch_rows is not None and batch_rows <= BROADCAST_KEYS:
        hashes = batch.select(F.xxhash64(key).alias("_hash")).distinct()
        known = known.join(F.broadcast(hashes), F.xxhash64(key) == F.col("_hash"), "left_semi")
    return batch.join(known, key, "left_anti")


def insert_if_absent(batch: DataFrame, target: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """Rows to append so that the first row per key wins and existing rows never change."""
    return absent_from(first_per_key(batch, [key], *order), target, key)


def merge_daily_stats(gold: DataFrame, batch: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """The gold table after adding a batch of ``stat_date, airport_name`` aggregates.

    Counts add up, ``unique_pilots`` keeps the larger of the two numbers, and
    only rows that the batch touches get a new ``updated_at``. A NULL key
    matches nothing, so such a row is added again with every batch. Where both
    sides have ``pilots_sketch``, the sketches are united: unlike the larger
    number they tell, to a few per cent, how many distinct pilots all batches had.
    """
    keys = ["stat_date", "airport_name"]
    stamp = F.lit(at) if at is not None else F.current_timestamp()
    old, new = gold.alias("old"), batch.alias("new")
    both = old.join(new, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys], "full_outer")
    is_new = F.col("new.total_flights").isNotNull()
    is_old = F.col("old.total_flights").isNotNull()

    def added(c: str) -> Column:
        return (F.coalesce(F.col(f"old.{c}"), F.lit(0)) + F.coalesce(F.col(f"new.{c}"), F.lit(0))).alias(c)

    a, b = F.col("old.pilots_sketch"), F.col("new.pilots_sketch")
    optional = {
        "pilots_sketch": F.when(a.isNotNull() & b.isNotNull(), F.hll_union(a, b)).otherwise(F.coalesce(a, b)),
        "last_batch": F.when(is_new, F.col("new.last_batch")).otherwise(F.col("old.last_batch")),
    }
    return both.select(
        *[F.coalesce(F.col(f"old.{k}"), F.col(f"new.{k}")).alias(k) for k in keys],
        added("total_flights"),
        F.when(is_old & is_new, greatest_or_null(F.col("old.unique_pilots"), F.col("new.unique_pilots")))
        .otherwise(F.coalesce(F.col("old.unique_pilots"), F.col("new.unique_pilots")))
        .alias("unique_pilots"),
        added("passengers_served"),
        F.when(is_new, stamp).otherwise(F.col("old.updated_at")).alias("updated_at"),
        *[column.alias(c) for c, column in optional.items() if c in gold.columns and c in batch.columns],
    )


def add_batch(known: DataFrame, batch: DataFrame, name: str, at: dt.datetime | None = None) -> DataFrame:
    """``merge_daily_stats`` where rows of ``known`` name their ``last_batch``: what ``name`` has added before stays as it is."""
    done = known.filter(F.col("last_batch") == name).select(F.col("stat_date").alias("_date"), F.col("airport_name").alias("_name"))
    same = F.col("stat_date").eqNullSafe(F.col("_date")) & F.col("airport_name").eqNullSafe(F.col("_name"))
    return merge_daily_stats(known, batch.join(done, same, "left_anti").withColumn("last_batch", F.lit(name)), at)


def stamp_changes(old: DataFrame, new: DataFrame, key: str, at: Column) -> DataFrame:
    """``new`` with ``last_update`` set to ``at`` on rows that differ from ``old`` or are not in it."""
    data = [c for c in new.columns if c not in (key, "last_update")]
    before = old.select(
        F.col(key).alias("_key"), F.struct(*data).alias("_before"), F.col("last_update").alias("_stamp")
    )
    met = new.join(before, F.col(key) == F.col("_key"), "left")
    unchanged = F.col("_key").isNotNull() & F.struct(*data).eqNullSafe(F.col("_before"))
    return met.select(key, *data, F.when(unchanged, F.col("_stamp")).otherwise(at).alias("last_update"))
