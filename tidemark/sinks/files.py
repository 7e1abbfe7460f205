"""File writers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.tables.versions import Snapshots


# Lines of a part file: its items, and one for the end of the array.
FILE_LINES = 100_000


def _array_lines(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The lines of one JSON array around the JSON texts of a partition, or of several arrays of ``most`` lines each."""
    mark, held = "[", 0
    for batch in batches:
        lines = []
        for text in batch.column(0).to_pylist():
            if text is not None:
                if most and held == most - 1:
                    lines.append("]")
                    mark, held = "[", 0
                lines.append(mark + text)
                mark, held = ",", held + 1
        yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
    yield pa.RecordBatch.from_pydict({"value": ["[]" if mark == "[" else "]"]})


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """One JSON array per part file, an item per line, written in parallel and row by row at any size.

    A file has ``FILE_LINES`` lines at most, as readers hold an array whole. ``single_file``
    writes one array with one task, in the order of the frame; all but
    the writing is done by many tasks before. A frame with the single column
    ``value`` becomes an array of plain values.
    """
    item = F.array("value") if df.columns == ["value"] else F.struct(*[F.col(f"`{c}`") for c in df.columns])
    text = F.to_json(item, {"ignoreNullFields": "false"})
    if df.columns == ["value"]:
        text = F.substring(text, 2, F.length(text) - 2)  # the value without the brackets of its array
    if single_file:
        # The null row is written as nothing; with it a result without rows is an empty array.
        rows = df.select(text.alias("value"), F.monotonically_increasing_id().alias("_at"))
        rows = rows.union(df.sparkSession.range(1).select(F.lit(None).cast("string"), F.lit(-1).cast("long")))
        rows.repartition(1).sortWithinPartitions("_at").select("value").mapInArrow(_array_lines, "value string").write.mode("overwrite").text(path)
        return
    most = FILE_LINES
    rows = df.select(text.alias("value")).mapInArrow(lambda batches: _array_lines(batches, most), "value string")
    rows.write.mode("overwrite").option("maxRecordsPerFile", most).text(path)


def write_json_arrays(df: DataFrame, path: str, block: str) -> None:
    """One folder ``block=<b>`` with one JSON array file per value of the bounded block column."""
    columns = [c for c in df.columns if c != block]
    (
        df.groupBy(F.col(block).alias("block"))
        .agg(F.to_json(F.collect_list(F.struct(*columns)), {"ignoreNullFields": "false"}).alias("value"))
        .write.mode("overwrite")
        .partitionBy("block")
        .text(path)
    )


def write_xml(df: DataFrame, path: str, root: str = "items", item: str = "item", single_file: bool = False) -> None:
    """XML with one ``item`` element per row below ``root``; a missing value is the text ``None``.

    One document per part file, written in parallel at any size; ``single_file``
    writes one document with one task, for results known to be small. A frame
    with the single column ``value`` gives elements with plain content.
    """
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("None")).alias(c) for c in df.columns]
    rows = df.select(*text)
    if df.columns == ["value"]:
        rows = rows.select(F.col("value").alias("_VALUE"))
    if single_file:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").format("xml").option("rootTag", root).option("rowTag", item).save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header and no row numbers; blanks at either end of a text are kept."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def append_documents(df: DataFrame, path: str) -> None:
    """Plain append; writing the same rows again doubles them."""
    df.write.mode("append").parquet(path)


# Files that the rows of one month are spread over at most.
MONTH_FILES = 8


class StoredView:
    """A query result kept as a table and computed on request; readers see the last finished refresh."""

    def __init__(self, spark: SparkSession, path: str, build: Callable[[], DataFrame]):
        self.spark, self.path, self.build = spark, path, build

    def refresh(self) -> None:
        result = self.build()
        Snapshots(self.spark, self.path, result.schema).write(result)

    def read(self) -> DataFrame:
        """Raises until the view has been refreshed once."""
        stored = Snapshots(self.spark, self.path, self.build().schema)
        if not stored.commits.state().last_write:
            raise LookupError(f"view at {self.path} has not been refreshed yet")
        return stored.current()


def write_by_month(
    df: DataFrame, ts: str, path: str, first: dt.date, stop: dt.date, month: str = "pay_month"
) -> DataFrame:
    """Rows of ``[first, stop)`` written to one folder per month; returns the rows outside that range."""
    inside = (F.col(ts) >= F.lit(first)) & (F.col(ts) < F.lit(stop))
    kept = df.filter(inside).withColumn(month, F.date_format(ts, "yyyy-MM"))
    # Rows of a month meet in a few tasks, so that a month has a few files and not one per task.
    kept = kept.withColumn("_salt", F.pmod(F.xxhash64(ts), F.lit(MONTH_FILES))).repartition(month, "_salt").drop("_salt")
    kept.write.mode("overwrite").partitionBy(month).parquet(path)
    return df.filter(~F.coalesce(inside, F.lit(False)))
