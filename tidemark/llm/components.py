"""Connected components of a link table by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(lowest.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns); root is the smallest node reachable.

    A round links the neighbours of each node to the smallest of them, first the
    larger ones and then the smaller ones; only minima per node are gathered, no
    group is. Rounds end when the links no longer change, after about the
    logarithm of the longest chain. Every round is checkpointed. Links with a
    null end and links of a node with itself are left out.
    """
    a, b = edges.columns
    spark = edges.sparkSession
    links = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links, before = checkpointed(links), None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return spark.createDataFrame([], "node bigint, root bigint") if now[0] == 0 else links.select(
                F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
        links = checkpointed(_small_star(_large_star(links)))
