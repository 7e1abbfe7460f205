"""Mixing sources to target weights by cube-method sampling."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import INK, ROW, numbered, row_key, stored, text_or_empty, with_row_key

#: Units that one flight phase takes together.
BLOCK = 4096
#: Sources, and characters of their names, up to which the targets are broadcast; else they are joined by a shuffle.
BROADCAST_SOURCES, BROADCAST_CHARS = 100_000, 16_000_000
_EDGE = 1e-9


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(INK)).cast("long")


def source_targets(sizes: DataFrame, weights: list[float], most: float) -> DataFrame:
    """``source, source_size, n_units, target`` from one row per unit (``source``, ``total``).

    Sources in code point order, null last, take the weights in turn. Their
    targets are ``min(most * size, level * weight)`` with the one level at which
    they add up to all sizes. Sources by how early they reach their limit: the
    level is the largest of what is left after those before, per weight left.
    The windows run over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("total").cast("long").alias("source_size"), F.count("*").alias("n_units"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (turn % len(weights)).cast("int"))
    weighed = per_source.select("*", weight.alias("weight"), (F.col("source_size") * F.lit(float(most))).alias("limit"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)

    def left(name: str, total: str) -> Column:
        return F.sum(total).over(everything) - F.coalesce(F.sum(name).over(before), F.lit(0.0))

    levels = weighed.select("*", F.try_divide(left("limit", "source_size"), left("weight", "weight")).alias("level"))
    level = F.coalesce(F.max("level").over(everything), F.lit(0.0))
    return levels.select("source", "source_size", "n_units", F.least("limit", level * F.col("weight")).alias("target"))


def _flight(chance: list[float], count: list[float], total: list[float], draw: random.Random) -> None:
    """Move the chances in place until at most two stay between 0 and 1.

    Three open units at a time: the chances move along the one direction that
    keeps the sums of ``count`` and ``total`` over chances, to either side with
    the probability that keeps every mean, until one of them is 0 or 1.
    """
    open_, waiting = [], iter([i for i, p in enumerate(chance) if _EDGE < p < 1 - _EDGE])
    while True:
        while len(open_) < 3 and (i := next(waiting, None)) is not None:
            open_.append(i)
        if len(open_) < 3:
            return
        a, b, c = open_
        u = [count[b] * total[c] - count[c] * total[b], count[c] * total[a] - count[a] * total[c], count[a] * total[b] - count[b] * total[a]]
        if not any(u):  # proportional units: exchange two of them
            u = [count[b], -count[a], 0.0] if count[a] or count[b] else [1.0, 0.0, 0.0]
        up = min((1 - chance[i]) / d if d > 0 else -chance[i] / d for i, d in zip(open_, u) if d)
        down = min(chance[i] / d if d > 0 else (chance[i] - 1) / d for i, d in zip(open_, u) if d)
        step = up if draw.random() * (up + down) < down else -down
        for i, d in zip(open_, u):
            p = chance[i] + step * d
            chance[i] = 0.0 if p < _EDGE else 1.0 if p > 1 - _EDGE else p
        still = [i for i in open_ if 0.0 < chance[i] < 1.0]
        if len(still) == 3:  # rounding left none at an edge
            i = min(still, key=lambda i: min(chance[i], 1 - chance[i]))
            chance[i] = float(round(chance[i]))
            still.remove(i)
        open_ = still


def _land(chance: list[float], total: list[float], free: list[int], wish: float) -> None:
    """Decide the last open units so that the words taken come nearest to ``wish``.

    First the at most two open units, all ways tried; then single units of
    ``free`` are exchanged while that brings the sum nearer, 32 at most.
    """
    left = [i for i in free if 0.0 < chance[i] < 1.0]
    sure = sum(p * t for p, t in zip(chance, total)) - sum(chance[i] * total[i] for i in left)
    error, bits = min((abs(sure + sum(total[i] for k, i in enumerate(left) if bits >> k & 1) - wish), bits) for bits in range(1 << len(left)))
    for k, i in enumerate(left):
        chance[i] = float(bits >> k & 1)
    error = sum(p * t for p, t in zip(chance, total)) - wish
    for _ in range(32):
        best = min(free, key=lambda i: abs(error + (1 - 2 * chance[i]) * total[i]), default=None)
        if best is None or abs(error + (1 - 2 * chance[best]) * total[best]) >= abs(error) - 1e-6:
            return
        error += (1 - 2 * chance[best]) * total[best]
        chance[best] = 1.0 - chance[best]


def _decide(level: int, landing: bool):
    def block(df: pd.DataFrame) -> pd.DataFrame:
        # Large units first, so that those left open at the end are small.
        df = df.sort_values(["total", "unit_hash", "row_key"], ascending=[False, True, True], kind="stable")
        chance, total, count = df["chance"].tolist(), df["total"].astype(float).tolist(), df["n_rows"].astype(float).tolist()
        draw = random.Random(f"{df['unit_hash'].min()} {len(df)} {level}")
        free, wish = [i for i, p in enumerate(chance) if _EDGE < p < 1 - _EDGE], sum(p * t for p, t in zip(chance, total))
        _flight(chance, count, total, draw)
        if landing:
            _land(chance, total, free, wish)
        return df.assign(chance=chance)

    return block


def mix_units(units: DataFrame, weights: list[float], most: float = 3.0) -> DataFrame:
    """``units`` (``source, doc_id, row_key, size, n_rows``) with ``source_size, target, copies``.

    ``copies`` is how often each unit is taken: the whole part of target by size
    for all, and one more for those that the cube method draws for the rest. Its
    first flights run in blocks of 4,096 units of a source, chosen by a hash; the
    at most two open units of each block meet in further blocks until one block
    per source is left, whose open units land. So a source of any size is never
    gathered, and each level is written to the shared folder. Targets, one row
    per source, are broadcast after their number and length were checked.
    """
    units = stored(units.withColumn("total", F.col("size") * F.col("n_rows")), "mix-units")
    targets = stored(source_targets(units, weights, most).select(F.col("source").alias("__source"), "source_size", "n_units", "target"), "mix-targets")
    count, chars, most_blocks = targets.agg(
        F.count("*"), F.coalesce(F.sum(F.length(F.col("__source").cast("string"))), F.lit(0)),
        F.coalesce(F.max(F.ceil(F.col("n_units") / BLOCK).cast("long")), F.lit(1))).first()
    hinted = F.broadcast(targets) if count <= BROADCAST_SOURCES and chars <= BROADCAST_CHARS else targets
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    rows = units.join(hinted, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source").select(
        "*", F.floor(ratio + 1e-12).alias("whole"), F.greatest(ratio - F.floor(ratio + 1e-12), F.lit(0.0)).alias("chance"),
        F.xxhash64("doc_id", "row_key").alias("unit_hash"),
        F.ceil(F.col("n_units") / BLOCK).cast("long").alias("blocks"))
    decided, level = [], 0
    while True:
        landing = most_blocks <= 1
        rows = rows.withColumn("block", F.pmod(F.xxhash64("unit_hash", F.lit(level)), "blocks"))
        rows = stored(rows.groupBy("source", "block").applyInPandas(_decide(level, landing), rows.schema), "mix-level")
        is_open = (F.col("chance") > 0) & (F.col("chance") < 1)
        decided.append(rows.where(~is_open))
        if landing:
            break
        # At most two units of each block are open.
        rows = rows.where(is_open).withColumn("blocks", F.ceil(F.col("blocks") * 2 / BLOCK).cast("long"))
        most_blocks, level = -(-most_blocks * 2 // BLOCK), level + 1
    out = decided[0]
    for more in decided[1:]:
        out = out.union(more)
    return out.select("source", "doc_id", "row_key", "size", "n_rows", "source_size", "target", (F.col("whole") + F.col("chance").cast("long")).alias("copies"))


def units_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    rows = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"), word_count(F.col(text_col)).alias("size"))
    return rows.groupBy("source", "doc_id", "row_key", "size").agg(F.count("*").alias("n_rows"))


def mix_report(docs: DataFrame, weights: list[float], most: float = 3.0, **columns: str) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken`` (words taken).

    A null text has size 0 and is taken in name only. Rows equal in source, id
    and text share one decision. Sources are told apart by value, null being one
    of them; an empty table gives no rows; other columns are not read. The draw
    depends on ids and texts alone, so reruns agree.
    """
    mixed = mix_units(units_of(docs, **columns), weights, most)
    return mixed.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("row")).drop("row")


def mix(docs: DataFrame, weights: list[float], most: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: rows not taken go, and a column ``copies`` says how often each other is taken."""
    mixed = mix_units(units_of(docs, id_col, text_col, source_col), weights, most).where("copies > 0").select(
        F.col("row_key").alias(ROW), F.col("source").alias("__source"), F.col("copies").alias("__copies"))
    names = docs.columns
    docs, id_col, text_col, source_col = numbered(docs, id_col, text_col, source_col)
    keyed = with_row_key(docs, id_col, text_col)
    joined = keyed.join(mixed, (keyed[ROW] == mixed[ROW]) & keyed[source_col].eqNullSafe(mixed["__source"]), "inner")
    return joined.select(*(keyed[c].alias(name) for c, name in zip(docs.columns, names) if name != "copies"), F.col("__copies").alias("copies"))
