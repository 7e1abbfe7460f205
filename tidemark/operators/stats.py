"""Descriptive statistics."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.predicates import holds_for_all
from tidemark.operators.ordered import running_total

# Distinct values per group up to which one aggregation buffer may hold them.
BUFFERED_VALUES = 200_000


def _fits_buffer(df: DataFrame, value: str, keys: list[str], limit: int) -> bool:
    """Whether no group holds more than ``limit`` distinct values, judged by a sketch with ample margin."""
    per_group = df.groupBy(*keys).agg(F.approx_count_distinct(value).alias("n"))
    widest = per_group.agg(F.max("n").alias("n")).first()["n"]
    return (widest or 0) * 2 <= limit


def percentiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    keys: list[str] | None = None,
    buffered_values: int = BUFFERED_VALUES,
) -> DataFrame:
    """Exact percentiles with linear interpolation, one column per named probability.

    Repeated values are counted first, map-side. Groups with few distinct
    values then use the built-in aggregate, whose buffer is bounded by the
    check. Otherwise ranks come from a distributed running total, and no task
    sees a whole group.
    """
    keys = keys or []
    present = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    if _fits_buffer(present, "_v", keys, buffered_values):
        return present.groupBy(*keys).agg(
            *[F.percentile("_v", p).alias(name) for name, p in probabilities.items()]
        )
    counted = present.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(counted, keys, ["_v"], F.col("_n"), "_upto", total="_size")

    def at(position: Column) -> Column:
        """The value at a zero-based rank."""
        holds = (F.col("_upto") > position) & (F.col("_upto") - F.col("_n") <= position)
        return F.max(F.when(holds, F.col("_v")))

    out = []
    for name, p in probabilities.items():
        exact = (F.col("_size") - 1) * F.lit(float(p))
        low, high = at(F.floor(exact)), at(F.ceil(exact))
        part = F.max(exact - F.floor(exact))
        out.append((low + (high - low) * part).alias(name))
    return placed.groupBy(*keys).agg(*out)


def quantile_sketches(df: DataFrame, value: str, keys: list[str] | None = None, k: int = 400) -> DataFrame:
    """``keys, n, sketch``: one KLL sketch of the known values of each group.

    A sketch holds some thousands of bytes however many rows it stands for.
    Sketches of parts merge into one of the whole with ``merge_sketches``, so a
    stored table of them answers for any union of its rows without reading them.
    """
    v = F.col(value).cast("double")
    known = df.filter(v.isNotNull() & ~F.isnan(v))
    return known.groupBy(*(keys or [])).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, k).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: list[str] | None = None, k: int = 400) -> DataFrame:
    """The sketches of coarser groups from those of finer ones or of several batches."""
    return sketches.groupBy(*(keys or [])).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def from_sketches(sketches: DataFrame, probabilities: dict[str, float]) -> DataFrame:
    """The sketch replaced by one column per named probability: a value whose rank is near that share of the rows."""
    kept = [c for c in sketches.columns if c != "sketch"]
    named = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in probabilities.items()]
    return sketches.select(*kept, *named)


def approx_percentiles(
    df: DataFrame, value: str, probabilities: dict[str, float], keys: list[str] | None = None, k: int = 400
) -> DataFrame:
    """Percentiles from one pass with partial results, one column per named probability.

    The approximate form of ``percentiles``: each is a value of the group whose
    rank differs from the asked one by less than about 1% of the group's rows
    (``k`` = 400; the error falls as 1/``k``). NULL and NaN do not count, and a group
    without other values has no row. No job runs while the frame is built.
    """
    out = from_sketches(quantile_sketches(df, value, keys, k), probabilities)
    return out.select(*(keys or []), *probabilities)


def describe(
    df: DataFrame,
    value: str,
    keys: list[str],
    buffered_values: int = BUFFERED_VALUES,
    values_from: DataFrame | None = None,
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per group; NULL keys are left out.

    ``values_from`` is a cheaper frame that holds every value of the column,
    such as a table before its joins, on which to judge how many there are.
    """
    known = df.select(*keys, value)
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    moments = [
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    few = values_from is not None and _fits_buffer(values_from, value, [], buffered_values)
    if few or _fits_buffer(known, value, keys, buffered_values):
        out = known.groupBy(*keys).agg(*moments, *[F.percentile(value, p).alias(n) for n, p in quartiles.items()])
    else:
        spread = percentiles(known, value, quartiles, keys, buffered_values)
        out = known.groupBy(*keys).agg(*moments).join(spread, keys, "left")
    return out.select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max").orderBy(*keys)


def group_mean(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Mean per key tuple; rows with a NULL key are left out."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


# Rows of a group that one Python call may get.
MOST_GROUP_ROWS = 1_000_000
# Rows of the groups that are handed over together, on average.
BATCH_ROWS = 20_000


def groups_where_any(
    df: DataFrame, key: str, columns: list[str], predicate: Callable[[pd.DataFrame], bool], most_rows: int = MOST_GROUP_ROWS
) -> DataFrame:
    """Groups for which a function of all their rows holds: ``key, group_size, passes``; rows with a NULL key are left out.

    For conditions that aggregates cannot express; ``groups_where`` is the form
    to prefer otherwise. ``predicate`` gets the named columns of one group as
    a pandas frame, in no order. The sizes of groups are counted first, with
    partial counts, and a group of more than ``most_rows`` raises a ValueError
    before any is gathered. Groups travel to the function in batches of about
    ``BATCH_ROWS`` rows, dealt by a hash of the key, as a batch of its own for
    every small group takes longer than the function.
    """
    known = df.filter(F.col(key).isNotNull()).select(key, *[c for c in columns if c != key])
    rows, largest = known.groupBy(key).count().agg(F.coalesce(F.sum("count"), F.lit(1)), F.coalesce(F.max("count"), F.lit(0))).first()
    if largest > most_rows:
        raise ValueError(f"a group of {largest} rows; at most {most_rows} are handed to a function")

    # Whole numbers and truth values travel with a mark for NULL, as pandas would turn those of a whole batch into others.
    marked = [c for c in columns if isinstance(known.schema[c].dataType, T.IntegralType | T.BooleanType)]
    plain = [c for c in columns if c not in marked]
    hashed = F.col(key) + F.lit(0) if isinstance(known.schema[key].dataType, T.FractionalType) else F.col(key)  # -0.0 is 0.0
    packed = known.select(
        F.pmod(F.xxhash64(hashed), F.lit(-(-rows // BATCH_ROWS))).alias("_batch"), F.col(key).alias("_key"), *plain,
        *[F.coalesce(F.col(c), F.lit(0).cast(known.schema[c].dataType)).alias(c) for c in marked],
        *[F.col(c).isNull().alias(f"_no_{c}") for c in marked])

    def judge(batch: pd.DataFrame) -> pd.DataFrame:
        number, keys = pd.factorize(batch["_key"], use_na_sentinel=False)
        order = np.argsort(number, kind="stable")
        edges = np.append(np.searchsorted(number[order], np.arange(len(keys))), len(order))
        batch = batch.take(order).reset_index(drop=True)
        wanted, missing = batch[columns], {c: batch[f"_no_{c}"].to_numpy() for c in marked}
        missing = {c: gone for c, gone in missing.items() if gone.any()}
        passes = []
        for start, end in zip(edges, edges[1:]):
            group = wanted.iloc[start:end].reset_index(drop=True)
            for c, gone in missing.items():
                if gone[start:end].any():
                    kind = object if group[c].dtype == bool else float
                    group = group.assign(**{c: group[c].astype(kind).mask(gone[start:end], None if kind is object else np.nan)})
            passes.append(bool(predicate(group)))
        return pd.DataFrame({key: batch["_key"].iloc[edges[:-1]].array, "group_size": np.diff(edges), "passes": passes})

    kind = known.schema[key].dataType.simpleString()
    return packed.groupBy("_batch").applyInPandas(judge, f"`{key}` {kind}, group_size long, passes boolean")


def groups_where(df: DataFrame, key: str, mean_of: str, mean_at_most, all_of: str, all_above) -> DataFrame:
    """Keys whose mean stays at or below a bound and whose rows all lie above another, with group sizes."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("group_size"),
            (F.avg(mean_of) <= F.lit(mean_at_most)).alias("mean_ok"),
            holds_for_all(F.col(all_of) > F.lit(all_above)).alias("all_ok"),
        )
        .withColumn("passes", F.coalesce(F.col("mean_ok") & F.col("all_ok"), F.lit(False)))
        .select(key, "group_size", "passes")
    )
