"""Operators on ordered series held as rows ``(series, pos, val)``.

``pos`` is an integer, unique within a series. A series is cut into blocks of
``BLOCK`` consecutive positions, so no task holds more than ``BLOCK`` rows of
one series at a time; what crosses a block edge is settled on one summary row
or two per block. Where a series has more than ``FAN`` blocks, blocks are taken
together ``FAN`` at a time, level by level, so that no window holds the
summary rows of a whole series either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import block_of

BLOCK = 65_536
FAN = 65_536


def _blocked(df: DataFrame, series: str, pos: str, val: str, block: int) -> DataFrame:
    return df.select(
        F.col(series).alias("series"),
        block_of(pos, block).alias("block"),
        F.col(pos).alias("pos"),
        F.col(val).alias("val"),
    )


def _levels(df: DataFrame, pos: str, block: int, fan: int) -> int:
    """How often ``fan`` neighbouring blocks are taken together before a series is left with ``fan`` of them at most.

    The first and last position tell; positions of 32 bits in large blocks need no look.
    """
    if df.schema[pos].dataType.simpleString() in ("tinyint", "smallint", "int") and (1 << 32) // block <= fan:
        return 0
    ends = df.agg(F.min(pos).alias("low"), F.max(pos).alias("high")).first()
    wide, levels = 0 if ends["low"] is None else ends["high"] // block - ends["low"] // block + 1, 0
    while wide > fan:
        wide, levels = wide // fan + 1, levels + 1
    return levels


def _pieces(df: DataFrame, series: str, pos: str, val: str, block: int) -> tuple[DataFrame, DataFrame]:
    """The runs of each block that may go on in a neighbouring one, and those that may not.

    Inside a block a run lasts until the next row that starts one, or to the
    last row of the block.
    """
    inside = Window.partitionBy("series", "block").orderBy("pos")
    marked = _blocked(df, series, pos, val, block).select(
        "series", "block", "pos", "val",
        F.row_number().over(inside).alias("at"),
        F.lead("pos").over(inside).isNull().alias("ends"),
        F.coalesce(F.lag("pos").over(inside).isNull() | ~F.col("val").eqNullSafe(F.lag("val").over(inside)),
                   F.lit(True)).alias("starts"),
    )
    turns = marked.filter(F.col("starts") | F.col("ends"))
    next_at, next_starts = F.lead("at").over(inside), F.lead("starts").over(inside)
    runs = turns.select(
        "series", "block", "starts", F.col("pos").alias("start_pos"), "val",
        F.when(F.col("ends"), 1).when(next_starts, next_at - F.col("at")).otherwise(next_at - F.col("at") + 1)
        .alias("n"),
        ((F.col("at") == 1) | F.col("ends") | ~next_starts).alias("at_edge"),
    ).filter("starts")
    kept = ["series", "start_pos", "val"]
    return (runs.filter("at_edge").select("series", "block", "start_pos", "val", "n"),
            runs.filter(~F.col("at_edge")).select(*kept, F.col("n").alias("run_length")))


def _joined(edges: DataFrame, *within: str) -> DataFrame:
    """Edges of neighbouring blocks joined up to runs along the series, with their number ``run_id``."""
    along = Window.partitionBy("series", *within).orderBy("start_pos")
    goes_on = (F.lag("block").over(along) != F.col("block")) & F.col("val").eqNullSafe(F.lag("val").over(along))
    return (
        edges.withColumn("opens", F.when(goes_on, 0).otherwise(1))
        .withColumn("run_id", F.sum("opens").over(along))
        .groupBy("series", *within, "run_id")
        .agg(F.min("start_pos").alias("start_pos"), F.first("val").alias("val"), F.sum("n").alias("n"))
    )


def _merged_levels(edges: DataFrame, done: DataFrame, fan: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """The edges after so many levels, and all runs that are settled by then."""
    for _ in range(levels):
        wide = edges.withColumn("wide", block_of("block", fan))
        joined = _joined(wide, "wide").withColumn("last_id", F.max("run_id").over(Window.partitionBy("series", "wide")))
        at_edge = (F.col("run_id") == 1) | (F.col("run_id") == F.col("last_id"))
        done = done.unionByName(joined.filter(~at_edge).select("series", "start_pos", "val", F.col("n").alias("run_length")))
        edges = joined.filter(at_edge).select("series", F.col("wide").alias("block"), "start_pos", "val", "n")
    return edges, done


def run_lengths(df: DataFrame, series: str, pos: str, val: str, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Runs of adjacent equal values: ``series, start_pos, val, run_length``. NULL equals NULL.

    Only the first and the last run of a block can go on in a neighbouring
    one; those are joined up along the series.
    """
    edges, done = _pieces(df, series, pos, val, block)
    edges, done = _merged_levels(edges, done, fan, _levels(df, pos, block, fan))
    merged = _joined(edges).select("series", "start_pos", "val", F.col("n").alias("run_length"))
    return done.unionByName(merged).withColumnRenamed("series", series)


def max_after(df: DataFrame, series: str, pos: str, val: str, marker=0, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Largest value per series whose predecessor equals ``marker``; NULL if there is none."""
    rows = _blocked(df, series, pos, val, block)
    inside = Window.partitionBy("series", "block").orderBy("pos")
    blocks = (
        rows.withColumn("prev", F.lag("val").over(inside))
        .groupBy("series", "block")
        .agg(
            F.max(F.when(F.col("prev") == marker, F.col("val"))).alias("best"),
            F.min_by("val", "pos").alias("first_val"),
            F.max_by("val", "pos").alias("last_val"),
        )
    )

    def met(blocks: DataFrame, *within: str) -> DataFrame:
        """With ``edge``: the first value of a block whose predecessor is the last one of the block before."""
        along = Window.partitionBy("series", *within).orderBy("block")
        return blocks.withColumn("edge", F.when(F.lag("last_val").over(along) == marker, F.col("first_val")))

    for _ in range(_levels(df, pos, block, fan)):
        blocks = (
            met(blocks.withColumn("wide", block_of("block", fan)), "wide").groupBy("series", "wide")
            .agg(F.max(F.greatest("best", "edge")).alias("best"), F.min_by("first_val", "block").alias("first_val"),
                 F.max_by("last_val", "block").alias("last_val"))
            .withColumnRenamed("wide", "block")
        )
    return (
        met(blocks).groupBy("series")
        .agg(F.max(F.greatest("best", "edge")).alias("max_after"))
        .withColumnRenamed("series", series)
    )


def first_max(df: DataFrame, series: str, pos: str, val: str) -> DataFrame:
    """Position and value of the first maximum per series, by an aggregate with partial results."""
    best = F.max(F.struct(F.col(val).alias("v"), (-F.col(pos)).alias("back"))).alias("best")
    return (
        df.filter(F.col(val).isNotNull())
        .groupBy(series)
        .agg(best)
        .select(series, (-F.col("best.back")).alias("max_pos"), F.col("best.v").alias("max_val"))
    )


def diagonal_product(cells: DataFrame, row: str, col: str, val: str, keys: list[str] | None = None) -> DataFrame:
    """Product of the non-zero diagonal of a matrix given as ``(row, col, val)``."""
    on_diagonal = cells.filter((F.col(row) == F.col(col)) & (F.col(val) != 0))
    return on_diagonal.groupBy(*(keys or [])).agg(F.product(F.col(val)).alias("product"))


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row ``same``: whether two tables hold the same rows with the same multiplicities."""
    columns = a.columns
    counted = (
        a.select(*columns).withColumn("_side", F.lit(1))
        .unionByName(b.select(*columns).withColumn("_side", F.lit(-1)))
        .groupBy(*columns)
        .agg(F.sum("_side").alias("_balance"))
    )
    return counted.agg(F.coalesce(F.bool_and(F.col("_balance") == 0), F.lit(True)).alias("same"))


def distinct_first_seen(df: DataFrame, columns: list[str], pos: str) -> DataFrame:
    """Distinct rows with the position where each was first seen."""
    return df.groupBy(*columns).agg(F.min(pos).alias("first_pos"))
