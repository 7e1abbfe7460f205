"""String aggregation and word indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.arrays import words
from tidemark.operators.ordered import block_of


def text_pieces(df: DataFrame, keys: list[str], value: str, sep: str, distinct: bool) -> DataFrame:
    """``keys, piece, text``: the ordered values of a group, joined in consecutive pieces.

    Equal values are counted first, with partial counts. The counted ones are
    range-partitioned by key and value, so a large group spreads over
    many slices whose numbers ascend with the values, and each slice of a
    group is joined on its own. Groups whose values are all NULL have a NULL text.
    """
    counted = df.groupBy(*keys, value).agg(F.count(value).alias("_n"))
    sliced = counted.repartitionByRange(*keys, value).withColumn("piece", F.spark_partition_id())
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("_n").cast("int").alias("n")))
    listed = sliced.groupBy(*keys, "piece").agg(F.sort_array(F.collect_list(known)).alias("_values"))

    def text(x: Column) -> Column:
        one = x["v"].cast("string")
        return one if distinct else F.when(x["n"] == 1, one).otherwise(F.array_join(F.array_repeat(one, x["n"]), sep))

    return listed.select(*keys, "piece", F.when(F.size("_values") > 0, F.array_join(F.transform("_values", text), sep)).alias("text"))


def string_agg(
    df: DataFrame, keys: list[str], value: str, name: str, sep: str = ", ", distinct: bool = False
) -> DataFrame:
    """One row per group: its values joined in ascending order, NULL skipped, NULL if there are none.

    Values are sorted and joined in pieces, many of them for a large group,
    and only the few texts of a group's pieces meet in one task. A text is one
    value of a row and has to fit one (2 GB); beyond that the query fails and
    cuts nothing.
    """
    part = F.when(F.col("text").isNotNull(), F.struct("piece", "text"))
    grouped = text_pieces(df, keys, value, sep, distinct).groupBy(*keys).agg(F.sort_array(F.collect_list(part)).alias("_parts"))
    return grouped.select(*keys, F.when(F.size("_parts") > 0, F.array_join(F.transform("_parts", lambda x: x["text"]), sep)).alias(name))


def word_index(df: DataFrame, id_column: str, text: Column, block: int = 4096) -> DataFrame:
    """Word to ids, in blocks of consecutive ids: ``term, block, n_ids, ids``.

    Ids are unique integers, so a posting list holds at most ``block`` ids
    however frequent the word is. Most words are rare in a block, so lists are
    built once, after the shuffle: partial ones cost more than they save.
    """
    return (
        df.select(F.col(id_column).alias("id"), F.explode(words(text)).alias("term"))
        .withColumn("block", block_of("id", block))
        .repartition("term", "block").groupBy("term", "block")
        .agg(F.count(F.lit(1)).alias("n_ids"), F.sort_array(F.collect_list("id")).alias("ids"))
    )
