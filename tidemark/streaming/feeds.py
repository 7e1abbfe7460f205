"""File feeds: reading what has arrived, and asking whether something has."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def consume(
    source: DataFrame, handle: Callable[[DataFrame, str], None], checkpoint: str, skip_empty: bool = True
) -> int:
    """Hand everything new in ``source`` to ``handle`` and return the number of batches handled.

    The offset moves only after ``handle`` returns, so a failed batch comes
    again under the same name. Names hold the id that the stream keeps in its
    checkpoint, so a stream behind a new checkpoint never takes up old names.
    Empty batches are only reported back.
    """
    handled, started, ids = [0], threading.Event(), []

    def each(batch: DataFrame, number: int) -> None:
        if skip_empty and batch.isEmpty():
            return
        started.wait()
        handle(batch, f"{ids[0]}-{number}")
        handled[0] += 1

    query = (
        source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    ids.append(query.id)
    started.set()
    query.awaitTermination()
    return handled[0]


def files_below(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path`` of the files below a folder; none if there is no such folder."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    try:
        return listing.load(folder).select(bare_path("path").alias("path"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")


def bare_path(column: str) -> Column:
    """A path without the ways to write that it is local."""
    return F.regexp_replace(column, "^file:/+", "/")


class Ledger:
    """Which files the runs of one stream have taken, in tables of its own.

    A run that takes all that has arrived notes the files it finds before it
    starts, and confirms the note when it has ended well. Files that arrive
    meanwhile may be taken without a note; they count as waiting until the next
    run, which then finds nothing new in them. Notes of a run that failed are
    not read.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def taken(self) -> DataFrame:
        """``path`` of the files in confirmed notes."""
        return self._read("notes", "path string, run string").join(self._read("runs", "run string"), "run", "left_semi").select("path")

    def pending(self, folder: str, pattern: str = "*") -> DataFrame:
        """``path`` of the files below ``folder`` that no run has taken yet."""
        return files_below(self.spark, folder, pattern).join(self.taken(), "path", "left_anti")

    def note(self, folder: str, pattern: str = "*") -> str:
        """Write down what waits and return the name of the note."""
        run = uuid.uuid4().hex
        self.pending(folder, pattern).write.mode("overwrite").parquet(f"{self.path}/notes/run=r-{run}")
        return f"r-{run}"

    def confirm(self, run: str) -> None:
        self.spark.range(1, numPartitions=1).select(F.lit(run).alias("run")).write.mode("append").parquet(f"{self.path}/runs")
