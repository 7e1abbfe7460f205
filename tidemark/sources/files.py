"""File readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that a CSV reader counts as missing.
NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_json_arrays(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON array of objects; one task per file."""
    wanted = _struct(schema)
    return spark.read.schema(wanted).option("multiLine", True).json(path).select(*wanted.names)


def read_item_lines(spark: SparkSession, path: str | list[str], schema: T.StructType | T.DataType | str) -> DataFrame:
    """The columns, or the plain values as ``value``, of JSON arrays with an item per line, as ``write_json`` writes them; large files are split over tasks."""
    lines = spark.read.text(path).filter(~F.col("value").isin("]", "[]"))
    wanted = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    item = F.from_json(F.concat(F.lit("["), F.expr("substring(value, 2)"), F.lit("]")), T.ArrayType(wanted))[0].alias("value")
    items = lines.select(item)
    return items.select("value.*") if isinstance(wanted, T.StructType) else items


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    na_values: list[str] = NA_VALUES,
    multi_line: bool = False,
    trim: bool = True,
) -> DataFrame:
    """CSV with a header; texts in ``na_values`` become NULL before the columns get their types.

    Large files are split over tasks. ``multi_line`` allows line feeds inside
    quoted texts, and makes every file one task.
    """
    wanted = _struct(schema)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
    raw = (
        spark.read.schema(as_text)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", trim)
        .csv(path)
    )
    return raw.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(na_values), F.col(f"`{f.name}`")).try_cast(f.dataType).alias(f.name)
            for f in wanted.fields
        ]
    )


def read_vector(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headerless lines of numbers: ``pos, val`` with the place of each number in its line."""
    lines = spark.read.text(path)
    return lines.select(F.posexplode(F.split("value", ",")).alias("pos", "val")).select(
        "pos", F.trim("val").cast("double").alias("val")
    )


def load_staged(
    spark: SparkSession, folder: str, columns: list[str], pattern: str = "*.csv.gz", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """All files of a folder that match ``pattern``: the rows that parse, and the lines that do not.

    Every column is text. A line with too many or too few fields goes to the
    second frame, whole, and does not stop the load.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_bad_line"]])
    rows = (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad_line")
        .option("pathGlobFilter", pattern)
        .option("columnPruning", False)  # every field is parsed, whichever columns are wanted
        .csv(folder)
    )
    good = rows.filter(F.col("_bad_line").isNull()).select(*columns)
    # The reader refuses a scan of the raw line alone, so the line is shown through an expression
    # that also names a parsed column.
    parsed = F.length(F.concat_ws("", "_bad_line", columns[0])) >= 0
    bad = rows.filter(F.col("_bad_line").isNotNull()).select(F.when(parsed, F.col("_bad_line")).alias("line"))
    return good, bad
