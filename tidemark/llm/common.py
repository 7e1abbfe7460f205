"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run of characters that are none of space, tab, line feed, vertical tab, form feed and carriage return.
INK = r"[^\x20\x09-\x0D]+"


def text_or_empty(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and all else as it is; ``lower`` is exact and quicker where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: The column that names a row while decisions about it travel without its text.
ROW = "__row"


def row_key(id_col: str, text_col: str) -> Column:
    """A digest of id and text; rows equal in both share it."""
    named = F.coalesce(F.concat(F.lit("+"), F.col(id_col).cast("string")), F.lit("-"))
    return F.md5(F.concat(named, F.lit("\n"), text_or_empty(text_col)))


def with_row_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.withColumn(ROW, row_key(id_col, text_col))


def numbered(docs: DataFrame, *used: str) -> tuple:
    """``docs`` with columns named c0, c1, …, and the new names of those used; no name of a caller meets one of an operator."""
    names = docs.columns
    return docs.toDF(*(f"c{i}" for i in range(len(names)))), *(f"c{names.index(u)}" for u in used)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that a lost executor costs no recomputation."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path below the shared folder, and the place in it."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with ``fn(batch) -> batch or table``, called batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)
