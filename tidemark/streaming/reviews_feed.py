"""Review files as they arrive: cleaned once, appended to the document table, then reported."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import reviews
from tidemark.sources.files import NA_VALUES
from tidemark.streaming.feeds import consume


def ingest(
    spark: SparkSession, landing: str, documents: str, checkpoint: str, columns: list[str],
    at: str = "at", content: str = "content", multi_line: bool = True,
) -> int:
    """Clean every new, non-empty file and append its rows; returns the batches handled.

    Reviews may hold line feeds, which makes every file one task: land them in
    files of bounded size, or say ``multi_line=False`` where they hold none.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = (
        spark.readStream.schema(schema)
        .option("header", True).option("multiLine", multi_line).option("escape", '"')
        .csv(landing)
    )

    def handle(batch: DataFrame, name: str) -> None:
        known = batch.select(*[F.when(~F.col(c).isin(NA_VALUES), F.col(c)).alias(c) for c in columns])
        rows = reviews.filled_and_stripped(known, content)
        rows.sortWithinPartitions(at).write.mode("overwrite").parquet(f"{documents}/batch=of-{name}")

    return consume(raw, handle, checkpoint)


def follow(spark: SparkSession, documents: str, schema: T.StructType, handle, checkpoint: str) -> int:
    """A second job started by what the first one wrote."""
    return consume(spark.readStream.schema(schema).parquet(documents), handle, checkpoint)


def report(documents: DataFrame, date: str = "created_date") -> dict[str, DataFrame]:
    """The three reports on the document table."""
    short = reviews.short_contents(documents)
    return {
        "frequent": reviews.frequent_contents(documents),
        "short": short,
        "short_count": short.agg(F.count(F.lit(1)).alias("n")),
        "score_by_day": reviews.score_by_day(documents, date),
    }


