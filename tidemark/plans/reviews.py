"""App reviews: cleaning and the three reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordering import up
from tidemark.functions.predicates import shorter_than
from tidemark.functions.scalars import day_text, fill_missing, strip_symbols


def stripped(df: DataFrame, content: str = "content") -> DataFrame:
    """Symbols removed from the content, if there is one."""
    return df.withColumn(content, strip_symbols(F.col(content))) if content in df.columns else df


def filled_and_stripped(raw: DataFrame, content: str = "content") -> DataFrame:
    """Missing values filled in every column, symbols removed from the content."""
    return stripped(fill_missing(raw), content)


def clean(raw: DataFrame, at: str = "at", content: str = "content") -> DataFrame:
    """The clean table in text order of ``at``; filled gaps sort before any digit.

    Rows of one ``at`` go by the hash of the row, so that a gap shared by many
    rows is sorted by many tasks. Contents are cleaned after the sort has
    spread the rows.
    """
    filled = fill_missing(raw)
    return stripped(filled.orderBy(at, F.xxhash64(*[f"`{c}`" for c in filled.columns])), content)


def frequent_contents(docs: DataFrame, k: int = 5, content: str = "content") -> DataFrame:
    """The most frequent contents; a missing content counts as the empty text, ties go by text."""
    counted = docs.groupBy(F.coalesce(content, F.lit("")).alias(content)).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), up(content)).limit(k)


def short_contents(docs: DataFrame, n: int = 5, content: str = "content") -> DataFrame:
    return docs.filter(shorter_than(F.col(content), n))


def score_by_day(docs: DataFrame, date: str = "created_date", score: str = "score") -> DataFrame:
    """Mean of the numeric scores per day; rows without a date form the day of empty name."""
    return (
        docs.groupBy(day_text(F.col(date)).alias("day"))
        .agg(F.avg(F.col(score).try_cast("double")).alias("avg_score"))
        .orderBy("day")
    )
