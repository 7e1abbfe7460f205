"""Aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.predicates import holds_for_all, share
from tidemark.functions.scalars import rounded
from tidemark.operators.ranking import largest_group, value_counts
from tidemark.operators.stats import (
    approx_percentiles, describe, from_sketches, group_mean, groups_where, groups_where_any, merge_sketches, percentiles, quantile_sketches,
)
from tidemark.operators.text import string_agg
from tidemark.plans.registered.rental import AMOUNT_SQL, amount, in_units
from tidemark.registry import query



@query("A01_count_rows", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def a01(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("A02_count_column", """
SELECT o_custkey, count(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END) AS n FROM orders GROUP BY o_custkey
""")
def a02(t):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    return t.orders.groupBy("o_custkey").agg(F.count(known).alias("n"))


@query("A03_count_distinct", "SELECT l_suppkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY l_suppkey")
def a03(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("n"))


@query("A04_count_filter", """
SELECT l_partkey, count(*) FILTER (WHERE l_returnflag = 'R') AS n FROM lineitem GROUP BY l_partkey
""")
def a04(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("n"))


@query("A05_sum_case", """
SELECT l_partkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n FROM lineitem GROUP BY l_partkey
""")
def a05(t):
    returned = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    return t.lineitem.groupBy("l_partkey").agg(F.sum(returned).alias("n"))


@query("A06_sum_money", f"""
SELECT l_suppkey, CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS total FROM lineitem GROUP BY l_suppkey
""")
def a06(t):
    return t.lineitem.groupBy("l_suppkey").agg(in_units(F.sum(amount())).alias("total"))


@query("A07_sum_or_zero", """
SELECT CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(12,2))), 0) AS DOUBLE) AS total FROM orders
WHERE o_orderstatus = 'nothing'
""")
def a07(t):
    none = t.orders.filter(F.col("o_orderstatus") == "nothing")
    return none.agg(F.coalesce(F.sum(F.col("o_totalprice").cast("decimal(12,2)")), F.lit(0)).cast("double").alias("total"))


@query("A08_rounded_mean", """
SELECT l_partkey, CAST(round(CAST(avg(l_quantity) AS DECIMAL(18,10)), 2) AS DOUBLE) AS mean FROM lineitem GROUP BY l_partkey
""")
def a08(t):
    return t.lineitem.groupBy("l_partkey").agg(F.avg("l_quantity").alias("m")).select(
        "l_partkey", rounded(F.col("m"), 2).cast("double").alias("mean")
    )


@query("A09_mean_of_numbers", """
SELECT event_type, round(avg(TRY_CAST(score AS DOUBLE)), 6) AS mean FROM (
  SELECT event_type, CASE WHEN user_id > 100 THEN props ELSE CAST(value AS VARCHAR) END AS score FROM events)
GROUP BY event_type
""")
def a09(t):
    score = F.when(F.col("user_id") > 100, F.col("props")).otherwise(F.col("value").cast("string"))
    return t.events.groupBy("event_type").agg(F.round(F.avg(score.try_cast("double")), 6).alias("mean"))


@query("A10_min_max", """
SELECT o_custkey, min(o_totalprice) AS low, max(o_totalprice) AS high,
       round(max(o_totalprice) - min(o_totalprice), 2) AS spread FROM orders GROUP BY o_custkey
""")
def a10(t):
    price = F.col("o_totalprice")
    return t.orders.groupBy("o_custkey").agg(
        F.min(price).alias("low"), F.max(price).alias("high"), F.round(F.max(price) - F.min(price), 2).alias("spread")
    )


@query("A11_only_value", """
SELECT l_orderkey, max(l_returnflag) AS flag FROM lineitem GROUP BY l_orderkey
HAVING count(DISTINCT l_returnflag) = 1
""")
def a11(t):
    flags = t.lineitem.groupBy("l_orderkey").agg(F.min("l_returnflag").alias("low"), F.max("l_returnflag").alias("flag"))
    return flags.filter(F.col("low") == F.col("flag")).select("l_orderkey", "flag")


@query("A12_having", """
SELECT o_custkey FROM orders GROUP BY o_custkey
HAVING sum(CAST(o_totalprice AS DECIMAL(12,2))) > 3000000 AND count(*) > 10
""")
def a12(t):
    sums = t.orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("spent"), F.count(F.lit(1)).alias("n")
    )
    return sums.filter((F.col("spent") > 3000000) & (F.col("n") > 10)).select("o_custkey")


@query("A13_value_counts", """
SELECT o_orderpriority, count(*) AS "count" FROM orders WHERE o_orderpriority IS NOT NULL
GROUP BY o_orderpriority ORDER BY 2 DESC, 1
""")
def a13(t):
    return value_counts(t.orders, "o_orderpriority")


@query("A14_filtered_mean", "SELECT round(avg(l_quantity), 6) AS mean FROM lineitem WHERE l_returnflag = 'R'")
def a14(t):
    return t.lineitem.filter(F.col("l_returnflag") == "R").agg(F.round(F.avg("l_quantity"), 6).alias("mean"))


@query("A15_share", """
SELECT round(count(*) FILTER (WHERE shipped > TIMESTAMP '2000-01-01') / count(*), 6) AS share
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
""")
def a15(t):
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
    late = F.col("shipped") > F.lit(dt.date(2000, 1, 1))
    return t.orders.select("o_orderkey").join(shipped, "o_orderkey", "left").agg(F.round(share(late), 6).alias("share"))


@query("A16_sample_deviation", """
SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS std FROM lineitem GROUP BY l_returnflag
""")
def a16(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.stddev_samp("l_quantity"), 6).alias("std"))


@query("A17_population_deviation", """
SELECT l_returnflag, round(stddev_pop(l_quantity), 6) AS std FROM lineitem GROUP BY l_returnflag
""")
def a17(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.stddev_pop("l_quantity"), 6).alias("std"))


@query("A18_all", """
SELECT l_partkey, bool_and(l_quantity > 2) AS holds FROM lineitem GROUP BY l_partkey
""")
def a18(t):
    return t.lineitem.groupBy("l_partkey").agg(holds_for_all(F.col("l_quantity") > 2).alias("holds"))


@query("A18_all_over_no_rows", """
SELECT coalesce(bool_and(l_quantity > 2), true) AS holds FROM lineitem WHERE l_returnflag = 'nothing'
""")
def a18_empty(t):
    return t.lineitem.filter(F.col("l_returnflag") == "nothing").agg(holds_for_all(F.col("l_quantity") > 2).alias("holds"))


@query("A19_describe", """
SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS "count", round(avg(l_extendedprice), 4) AS mean,
       round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
       round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, max(l_extendedprice) AS max
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def a19(t):
    rounded = {c: F.round(c, 4) for c in ("mean", "std", "p25", "p50", "p75")}
    return describe(t.lineitem, "l_extendedprice", ["l_returnflag", "l_linestatus"]).withColumns(rounded)


@query("A20_median", "SELECT round(median(o_totalprice), 4) AS median FROM orders")
def a20(t):
    return percentiles(t.orders, "o_totalprice", {"median": 0.5}).select(F.round("median", 4).alias("median"))


@query("A21_percentile", """
SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.04), 4) AS p4 FROM orders GROUP BY o_orderpriority
""")
def a21(t):
    return percentiles(t.orders, "o_totalprice", {"p4": 0.04}, ["o_orderpriority"]).select(
        "o_orderpriority", F.round("p4", 4).alias("p4")
    )


@query("A21_percentile_spread_out", """
SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.9), 4) AS p90 FROM orders GROUP BY o_orderstatus
""")
def a21_spread(t):
    found = percentiles(t.orders, "o_totalprice", {"p90": 0.9}, ["o_orderstatus"], buffered_values=0)
    return found.select("o_orderstatus", F.round("p90", 4).alias("p90"))


# Ranks of an approximate percentile may differ from the asked ones by this share of the rows.
_RANK_ERROR = 0.02


def _ranked_within(rows, found, keys, value, p):
    """Whether the share of rows below the found value and the share up to it hold the asked one, within the error."""
    met = rows.join(F.broadcast(found), keys) if keys else rows.crossJoin(F.broadcast(found))
    below, upto = F.avg((F.col(value) < F.col("found")).cast("int")), F.avg((F.col(value) <= F.col("found")).cast("int"))
    return met.groupBy(*keys).agg(((below <= p + _RANK_ERROR) & (upto >= p - _RANK_ERROR)).alias("within"), F.count(F.lit(1)).alias("n"))


@query("A21_percentile_in_one_pass", """
SELECT o_orderpriority, true AS within, count(*) AS n FROM orders GROUP BY o_orderpriority
""")
def a21_sketch(t):
    """The approximate form, held against the exact ranks; at most as many keys as there are priorities are broadcast."""
    found = approx_percentiles(t.orders, "o_totalprice", {"found": 0.9}, ["o_orderpriority"])
    return _ranked_within(t.orders.select("o_orderpriority", "o_totalprice"), found, ["o_orderpriority"], "o_totalprice", 0.9)


@query("A20_median_of_merged_sketches", "SELECT true AS within, count(*) AS n FROM orders")
def a20_sketch(t):
    """The median of all orders from the sketches of each day's."""
    by_day = quantile_sketches(t.orders, "o_totalprice", ["o_orderdate"])
    found = from_sketches(merge_sketches(by_day), {"found": 0.5}).select("found")
    return _ranked_within(t.orders.select("o_totalprice"), found, [], "o_totalprice", 0.5)


@query("A03_approx_distinct", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, true AS within FROM lineitem GROUP BY l_returnflag
""")
def a03_sketch(t):
    """Distinct parts by sketches per line status that are merged, held against the exact numbers."""
    by_mode = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.hll_sketch_agg("l_partkey", 12).alias("sketch"))
    merged = by_mode.groupBy("l_returnflag").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("found"))
    exact = t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))
    near = F.abs(F.col("found") - F.col("parts")) <= F.greatest(F.lit(1.0), F.col("parts") * 0.07)
    return exact.join(merged, "l_returnflag").select("l_returnflag", "parts", near.alias("within"))


@query("A22_group_mean", """
SELECT l_returnflag, l_linestatus, round(avg(l_tax), 6) AS mean FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY l_returnflag, l_linestatus
""")
def a22(t):
    return group_mean(t.lineitem, ["l_returnflag", "l_linestatus"], "l_tax", "mean").withColumn("mean", F.round("mean", 6))


@query("A23_largest_group", """
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority ORDER BY n DESC, o_orderpriority LIMIT 1
""")
def a23(t):
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return largest_group(counts, "o_orderpriority", "n")


@query("A24_group_filter", """
SELECT l_partkey, count(*) AS group_size, avg(l_quantity) <= 25 AND bool_and(l_quantity > 1) AS passes
FROM lineitem GROUP BY l_partkey
""")
def a24(t):
    return groups_where(t.lineitem, "l_partkey", "l_quantity", 25, "l_quantity", 1)


@query("A24_any_predicate", """
SELECT l_partkey, count(*) AS group_size, avg(l_quantity) <= 25 AND bool_and(l_quantity > 1) AS passes
FROM lineitem GROUP BY l_partkey
""")
def a24_any(t):
    """The same condition as a function of the group's rows."""
    def holds(group):
        return group["l_quantity"].mean() <= 25 and (group["l_quantity"] > 1).all()

    return groups_where_any(t.lineitem, "l_partkey", ["l_quantity"], holds)


@query("A24_member_rows", """
SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (
  SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING avg(l_quantity) <= 25 AND bool_and(l_quantity > 1))
""")
def a24_rows(t):
    good = a24(t).filter("passes").select("l_partkey")
    return t.lineitem.join(good, "l_partkey", "left_semi").select("l_partkey", "l_orderkey", "l_linenumber")


@query("A25_product", """
SELECT l_orderkey, CAST(product(l_linenumber) AS BIGINT) AS product FROM lineitem GROUP BY l_orderkey
""")
def a25(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.product(F.col("l_linenumber")).cast("long").alias("product"))


@query("A26_group_concat", """
SELECT c_nationkey, string_agg(c_name, ', ' ORDER BY c_name, c_custkey) AS names FROM customer GROUP BY c_nationkey
""")
def a26(t):
    return string_agg(t.customer, ["c_nationkey"], "c_name", "names")


@query("A26_group_concat_distinct", """
SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ', ' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY l_orderkey
""")
def a26_distinct(t):
    return string_agg(t.lineitem, ["l_orderkey"], "l_returnflag", "flags", distinct=True)


@query("A27_row_count", "SELECT count(*) AS n FROM lineitem")
def a27(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("A28_value_count_pairs", "SELECT l_quantity AS val, count(*) AS n FROM lineitem GROUP BY l_quantity ORDER BY 1")
def a28(t):
    return t.lineitem.groupBy(F.col("l_quantity").alias("val")).agg(F.count(F.lit(1)).alias("n")).orderBy("val")
