"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(column.cast("string").cast("binary")) % parts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, label`` of about ``per_class`` documents with each label.

    Rows are chosen by a hash of the id against the share that the count of each
    class allows, so the same are chosen in every run. Labels other than 0 and 1
    and those of ids with two different labels do not count; ids without a
    document fall away. The chosen labels are few by construction and broadcast.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & allowed).groupBy(id_col).agg(
        F.min(label).alias("label"), F.max(label).alias("other")).where("label = other").select(F.col(id_col).alias("__id"), "label")
    counts = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("label") == 1, F.lit(min(1.0, per_class / max(1, counts.get(1, 0))))).otherwise(F.lit(min(1.0, per_class / max(1, counts.get(0, 0)))))
    chosen = known.where(F.pmod(F.xxhash64("__id", F.lit(label)), F.lit(1_000_000)) < share * 1_000_000)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "text", "label")
