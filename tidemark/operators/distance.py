"""Distances between the vectors of two tables."""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.arrays import euclidean
from tidemark.operators.ordered import running_total
from tidemark.session import checkpointed

# Total cells of the right-hand vectors that may travel with every task.
HELD_CELLS = 1_000_000
# Right-hand vectors that are compared with all left ones; more are refused.
MOST_RIGHT = 100_000


def _packed(id_column: str, vector: str):
    return F.sort_array(
        F.collect_list(F.struct(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vec")))
    )


def _cells(right: DataFrame, vector: str, most_right: int) -> int:
    found = right.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size(vector)).alias("cells")).first()
    if found["rows"] > most_right:
        raise ValueError(f"{found['rows']} vectors on the right; at most {most_right} are compared with every left one")
    return found["cells"] or 0


def _meet(left, left_id, left_vector, right, right_id, right_vector, held_cells, most_right) -> tuple[DataFrame, int]:
    """Rows ``left_id, x, held``, and how many of them each left vector has.

    ``held`` packs right vectors in an array; over its rows a left vector meets every right one.

    A right side of checked size is held as one array value and the left rows
    never move. A larger one is packed into blocks of that size, and each left
    row visits the blocks through an equi-join on the block number, salted so
    that the left rows of one block spread over many tasks.
    """
    x = left.select(F.col(left_id).alias("left_id"), F.col(left_vector).cast("array<double>").alias("x"))
    cells = _cells(right, right_vector, most_right)
    if cells <= held_cells:
        return x.withColumn("held", right.agg(_packed(right_id, right_vector).alias("held")).scalar()), 1
    blocks, salts = -(-cells // held_cells), 64
    packed = (
        right.groupBy(F.pmod(F.xxhash64(right_id), F.lit(blocks)).cast("int").alias("block"))
        .agg(_packed(right_id, right_vector).alias("held"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    visiting = x.withColumn("salt", F.pmod(F.xxhash64("left_id"), F.lit(salts)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    return visiting.join(packed, ["block", "salt"]).select("left_id", "x", "held"), blocks


def distance_matrix(
    left: DataFrame,
    left_id: str,
    left_vector: str,
    right: DataFrame,
    right_id: str,
    right_vector: str,
    held_cells: int = HELD_CELLS,
    most_right: int = MOST_RIGHT,
) -> DataFrame:
    """Euclidean distance of every left vector to every right one: ``left_id, right_id, distance``.

    The right side is a stated set of reference vectors; one of more than
    ``most_right`` raises a ValueError, so the rows out stay in proportion to
    the left side.
    """
    met, _ = _meet(left, left_id, left_vector, right, right_id, right_vector, held_cells, most_right)
    return met.select("left_id", "x", F.explode("held").alias("y")).select(
        "left_id", F.col("y.id").alias("right_id"), euclidean(F.col("x"), F.col("y.vec")).alias("distance")
    )


def _sound(vector: str) -> Column:
    return F.col(vector).isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")))


# Blocks of right vectors; more are refused.
MOST_BLOCKS = 200_000
# Visits of left rows to a block that one task holds at once.
VISITS = 50_000


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances, a dimension at a time, as a row by row sum gives them; between infinite entries they are infinite."""
    total = np.zeros((len(x), len(y)))
    with np.errstate(invalid="ignore", over="ignore"):
        for a, b in zip(x.T, y.T, strict=True):
            total += np.square(a[:, None] - b)
    return np.sqrt(np.where(np.isnan(total), np.inf, total))


def _bound(away: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least distance to a vector that is ``low`` to ``high`` from a pivot, less what rounding may add."""
    with np.errstate(invalid="ignore"):
        least = np.maximum(np.maximum(away - high, low - away), 0.0) - (away + high) * 1e-12
    return np.where(np.isnan(least), -np.inf, least)


def _keep(found: np.ndarray, named: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the ``n`` least distances, and the numbers that go with them; ties go to the smaller number."""
    row, at = np.nonzero(found <= np.partition(found, n - 1, axis=1)[:, n - 1 : n])
    order = np.lexsort((named[row, at], found[row, at], row))
    first = np.searchsorted(row, np.arange(len(found)))
    order = order[(first[:, None] + np.arange(n)).ravel()]
    return found[row, at][order].reshape(-1, n), named[row, at][order].reshape(-1, n)


def _search(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances of the ``n`` nearest ``y`` of every ``x``, their numbers (``len(y)``: none), and how many were compared.

    The vectors lie around about as many pivots of their own as have that many
    each, by their distance to them: a row looks at the pivots, at what lies
    around the nearest one, and then only where something may be as near.
    """
    pivots = y[np.sort(np.random.default_rng(0).choice(len(y), max(1, isqrt(len(y))), replace=False))]
    step = max(1, HELD_CELLS // len(pivots))
    owner, reach = np.zeros(len(y), np.int64), np.zeros(len(y))
    for k in range(0, len(y), step):
        away = _apart(y[k : k + step], pivots)
        owner[k : k + step], reach[k : k + step] = away.argmin(axis=1), away.min(axis=1)
    order = np.lexsort((reach, owner))
    y, reach = y[order], reach[order]
    edge = np.searchsorted(owner[order], np.arange(len(pivots) + 1))
    used = np.flatnonzero(np.diff(edge))
    pivots, begin, end = pivots[used], edge[used], edge[used + 1]
    low, high = reach[begin], reach[end - 1]
    best, named, compared = np.full((len(x), n), np.inf), np.full((len(x), n), len(y)), np.zeros(len(x), np.int64)

    def visit(rows: np.ndarray, k: int, away: np.ndarray) -> None:
        worst = best[rows, -1]
        slack = (away + high[k]) * 1e-12
        with np.errstate(invalid="ignore"):
            least = np.nan_to_num(away - worst - slack, nan=-np.inf).min()
        a = begin[k] + np.searchsorted(reach[begin[k] : end[k]], least)
        b = begin[k] + np.searchsorted(reach[begin[k] : end[k]], (away + worst + slack).max(), "right")
        compared[rows] += max(b - a, 0)
        for c in range(a, b, HELD_CELLS):
            several = max(1, HELD_CELLS // (min(b, c + HELD_CELLS) - c))
            for i in range(0, len(rows), several):
                some, to = rows[i : i + several], slice(c, min(b, c + HELD_CELLS))
                found = np.hstack([best[some], _apart(x[some], y[to])])
                best[some], named[some] = _keep(found, np.hstack([named[some], np.broadcast_to(order[to], (len(some), found.shape[1] - n))]), n)

    for k in range(0, len(x), step):
        away = _apart(x[k : k + step], pivots)
        own, bound = away.argmin(axis=1), _bound(away, low, high)
        for p in np.unique(own):
            visit(k + np.flatnonzero(own == p), p, away[own == p, p])
        bound[np.arange(len(own)), own] = np.inf
        for p in np.flatnonzero((bound <= best[k : k + step, -1:]).any(axis=0)):
            to = np.flatnonzero((bound[:, p] <= best[k : k + step, -1]) & (own != p))
            if len(to):
                visit(k + to, p, away[to, p])
    return best, named, compared


def _in_arrow(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    return lambda batches: (fn(batch) for batch in batches)


def _visited(visits: DataFrame, right: DataFrame, n: int) -> DataFrame:
    """The nearest vectors of the block that a left row visits, ``best``, and the number ``compared``.

    A block that very many rows visit is copied, and the rows are dealt over the
    copies, so that a task holds one block and some ``VISITS`` rows.
    """
    counted = {r["block"]: -(-r["count"] // VISITS) for r in visits.groupBy("block").count().collect()}
    several = F.create_map(*(F.lit(v) for b, k in counted.items() if k > 1 for v in (b, k))) if max(counted.values(), default=1) > 1 else None
    copies = F.lit(1) if several is None else F.coalesce(F.try_element_at(several, F.col("block")), F.lit(1))
    salted = right.withColumn("salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    dealt = visits.withColumn("salt", F.pmod(F.xxhash64("left_id"), copies).cast("int"))
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((visits, "left_id"), (right, "id"))]

    def search(met: pa.Table, held: pa.Table) -> pa.Table:
        held = held.take(pc.sort_indices(held, [("id", "ascending")])) if met.num_rows else held.slice(0, 0)
        best, at, compared = _search(_matrix(met["x"]), _matrix(held["vec"]), n) if held.num_rows else (np.zeros((met.num_rows, n)), np.zeros((met.num_rows, n), np.int64), np.zeros(met.num_rows, np.int64))
        real = at < held.num_rows
        finds = pa.StructArray.from_arrays([pa.array(best[real]), held["id"].combine_chunks().take(pa.array(at[real]))], ["distance", "right_id"])
        edges = pa.array(np.concatenate([[0], np.cumsum(real.sum(axis=1))]), pa.int32())
        return pa.table({"left_id": met["left_id"], "x": met["x"], "block": met["block"], "best": pa.ListArray.from_arrays(edges, finds), "compared": pa.array(compared)})

    return dealt.groupBy("block", "salt").cogroup(salted.groupBy("block", "salt")).applyInArrow(
        search, f"left_id {kinds[0]}, x array<double>, block bigint, best array<struct<distance: double, right_id: {kinds[1]}>>, compared bigint")


def nearest(
    left: DataFrame,
    left_id: str,
    left_vector: str,
    right: DataFrame,
    right_id: str,
    right_vector: str,
    n: int = 1,
    held_rows: int = 1024,
    pivots: int = 64,
    compared: str | None = None,
) -> DataFrame:
    """The ``n`` nearest right vectors of every left one, exactly: ``left_id, right_id, distance``; ties go by id.

    The right vectors lie in blocks, rings around pivots, which are a bounded
    sample of them: a vector belongs to its nearest pivot, and those of a pivot
    are cut by their distance to it, where they are more than a task may hold. By
    the triangle inequality, the distances of a left vector to the pivots bound
    those to each block from below. A left row visits the block that may be
    nearest first, and then only blocks that may hold something as near as its
    ``n``-th find; inside a block the same is done around more pivots, and
    vectors are compared as matrices. Left ids are unique, and all vectors have
    one length. Vectors that are NULL or hold NULL or NaN are left out on both
    sides. ``compared`` names a column for the number of right vectors that a left
    row was compared with, the pivots aside. Right sides of more than
    ``MOST_BLOCKS`` times ``held_rows`` vectors raise a ValueError.
    """
    y = right.filter(_sound(right_vector)).select(F.col(right_id).alias("id"), F.col(right_vector).cast("array<double>").alias("vec"))
    x = left.filter(_sound(left_vector)).select(F.col(left_id).alias("left_id"), F.col(left_vector).cast("array<double>").alias("x"))
    if y.count() > MOST_BLOCKS * held_rows:
        raise ValueError(f"more than {MOST_BLOCKS} blocks of {held_rows} vectors; hold more in a block")
    chosen = np.array([r["vec"] for r in y.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()])
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((x, "left_id"), (y, "id"))]

    def owned(batch: pa.RecordBatch) -> pa.RecordBatch:
        away = _apart(_matrix(batch["vec"]), chosen) if batch.num_rows else np.zeros((0, 1))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(away.argmin(axis=1)), pa.array(away.min(axis=1))], ["id", "vec", "pivot", "reach"])

    rows = max(1, HELD_CELLS // max(1, chosen.shape[-1]))
    placed = running_total(y.mapInArrow(_in_arrow(owned), f"id {kinds[1]}, vec array<double>, pivot bigint, reach double"), ["pivot"], ["reach", "id"], F.lit(1), "place")
    placed = checkpointed(placed.select("id", "vec", "reach", "pivot", (F.col("pivot") + len(chosen) * F.expr(f"(place - 1) div {rows}")).alias("block")))
    about = np.array([tuple(r) for r in placed.groupBy("block", "pivot").agg(F.min("reach"), F.max("reach")).orderBy("block").collect()]).reshape(-1, 4)
    block, pivot, low, high = about[:, 0].astype(np.int64), about[:, 1].astype(np.int64), about[:, 2], about[:, 3]
    held = placed.select("block", "id", "vec")

    def away_from(batch: pa.RecordBatch) -> np.ndarray:
        return _apart(_matrix(batch["x"]), chosen)[:, pivot] if batch.num_rows else np.zeros((0, len(block)))

    def to_first(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not len(block):
            batch = batch.slice(0, 0)
        away = away_from(batch)
        bound = _bound(away, low, high)
        off = np.where(bound <= bound.min(axis=1, keepdims=True, initial=np.inf), np.abs(away - (low + high) / 2), np.inf)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(block[off.argmin(axis=1)] if batch.num_rows else [], pa.int64())], ["left_id", "x", "block"])

    def to_others(batch: pa.RecordBatch) -> pa.RecordBatch:
        away = away_from(batch)
        may = _bound(away, low, high) <= batch["worst"].to_numpy(zero_copy_only=False)[:, None]
        row, at = np.nonzero(may & (block != batch["block"].to_numpy()[:, None]))
        taken = pa.array(row)
        return pa.RecordBatch.from_arrays([batch["left_id"].take(taken), batch["x"].take(taken), pa.array(block[at])], ["left_id", "x", "block"])

    schema = f"left_id {kinds[0]}, x array<double>, block bigint"
    first = checkpointed(_visited(x.mapInArrow(_in_arrow(to_first), schema), held, n))
    worst = F.coalesce(F.get("best", F.lit(n - 1))["distance"], F.lit(float("inf"))).alias("worst")
    visits = first.select("left_id", "x", "block", worst).mapInArrow(_in_arrow(to_others), schema)
    each = first.unionByName(_visited(visits, held, n))
    all_of = each.groupBy("left_id").agg(F.flatten(F.collect_list("best")).alias("best"), F.sum("compared").alias("compared"))
    out = all_of.select("left_id", "compared", F.inline(F.slice(F.sort_array("best"), 1, n)))
    return out.select("left_id", "right_id", "distance", *([F.col("compared").alias(compared)] if compared else []))
