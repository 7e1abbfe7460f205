"""Scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import scalars as s
from tidemark.operators.joins import left_join_many
from tidemark.plans.registered.reviews import PATTERN_SQL
from tidemark.registry import query

AS_OF = dt.date(2002, 1, 1)


@query("F01_double_bar", """
SELECT c_custkey, c_name || ' / ' || CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS label FROM customer
""")
def f01(t):
    segment = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", s.joined(F.col("c_name"), F.lit(" / "), segment).alias("label"))


@query("F02_concat_null", """
SELECT c_custkey, (c_name || CASE WHEN c_acctbal > 0 THEN c_mktsegment END) IS NULL AS is_missing FROM customer
""")
def f02(t):
    segment = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", s.joined(F.col("c_name"), segment).isNull().alias("is_missing"))


@query("F03_md5", "SELECT doc_id, md5(text) AS digest FROM documents")
def f03(t):
    return t.documents.select("doc_id", F.md5("text").alias("digest"))


@query("F04_first_letter_up", """
SELECT p_partkey, upper(substring(p_name, 1, 1)) || lower(substring(p_name, 2)) AS name FROM part
""")
def f04(t):
    return t.part.select("p_partkey", s.first_letter_up(F.col("p_name")).alias("name"))


@query("F05_strip_symbols", f"""
SELECT conv_id, turn, regexp_replace(coalesce(text, ''), '{PATTERN_SQL}', '', 'g') AS clean
FROM conversations
""")
def f05(t):
    return t.conversations.select("conv_id", "turn", s.strip_symbols(F.col("text")).alias("clean"))


@query("F06_fill_missing", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, coalesce(CAST(l_linenumber AS VARCHAR), '-') AS l_linenumber
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_quantity = 50
""")
def f06(t):
    full = t.lineitem.filter(F.col("l_quantity") == 50).select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    return s.fill_missing(left_join_many(t.orders.select("o_orderkey"), full, "o_orderkey"))


@query("F07_to_text", "SELECT CAST(o_orderkey AS VARCHAR) AS key_text, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def f07(t):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("key_text"), F.to_date("o_orderdate").cast("string").alias("day")
    )


@query("F08_length", "SELECT doc_id, length(text) AS n FROM documents")
def f08(t):
    return t.documents.select("doc_id", F.length("text").alias("n"))


@query("F09_day_text", """
SELECT coalesce(CASE WHEN event_type <> 'view' THEN strftime(ts, '%Y-%m-%d') END, '') AS day, count(*) AS n
FROM events GROUP BY 1
""")
def f09(t):
    stamp = F.when(F.col("event_type") != "view", F.col("ts"))
    return t.events.groupBy(s.day_text(stamp).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("F10_age_years", """
SELECT o_orderkey, extract(year FROM age(DATE '2002-01-01', o_orderdate)) AS years FROM orders
""")
def f10(t):
    return t.orders.select("o_orderkey", s.age_years(AS_OF, F.col("o_orderdate")).alias("years"))


@query("F11_as_of_day", """
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS days FROM orders
""")
def f11(t):
    return t.orders.select("o_orderkey", F.date_diff(F.lit(AS_OF), F.to_date("o_orderdate")).alias("days"))


@query("F12_month_arithmetic", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate - INTERVAL 3 MONTH), '%Y-%m-%d') AS first_day,
       strftime(last_day(date_trunc('month', o_orderdate - INTERVAL 3 MONTH)), '%Y-%m-%d') AS last_day FROM orders
""")
def f12(t):
    first = s.month_start(F.to_date("o_orderdate"), 3)
    return t.orders.select(
        "o_orderkey", first.cast("string").alias("first_day"), s.month_end(first).cast("string").alias("last_day")
    )


@query("F13_year_month", """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1, 2
""")
def f13(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("F14_days_over", """
SELECT l_orderkey, l_linenumber, greatest(date_diff('day', o_orderdate, l_shipdate) - l_quantity, 0)::BIGINT AS over_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def f14(t):
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    over = s.days_over(F.col("o_orderdate"), F.col("l_shipdate"), F.col("l_quantity"))
    return both.select("l_orderkey", "l_linenumber", over.alias("over_days"))


@query("F15_to_date", "SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day FROM events")
def f15(t):
    return t.events.select("event_id", F.to_date("ts").cast("string").alias("day"))


@query("F16_case", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'open' ELSE '' END AS state
FROM orders
""")
def f16(t):
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey", F.when(status == "F", "done").when(status == "O", "open").otherwise("").alias("state")
    )


@query("F17_coalesce", """
SELECT o_orderkey, coalesce(max(l_linenumber), 0) AS last_line
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
""")
def f17(t):
    last = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_linenumber").alias("n"))
    return t.orders.select("o_orderkey").join(last, "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("n", F.lit(0)).alias("last_line")
    )


@query("F18_round", "SELECT p_partkey, CAST(round(CAST(p_retailprice AS DECIMAL(18,10)), 0) AS DOUBLE) AS price FROM part")
def f18(t):
    return t.part.select("p_partkey", s.rounded(F.col("p_retailprice"), 0).cast("double").alias("price"))


@query("F19_try_number", """
SELECT event_id, TRY_CAST(TRY_CAST(CASE WHEN event_type = 'error' THEN props ELSE CAST(value AS VARCHAR) END
  AS DECIMAL(38,0)) AS BIGINT) AS number FROM events
""")
def f19(t):
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", s.whole_number(text).cast("long").alias("number"))


@query("F20_try_date", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS day FROM events
""")
def f20(t):
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.date_format("ts", "M/d/yyyy"))
    return t.events.select("event_id", s.us_date(text).cast("string").alias("day"))


@query("F21_greatest", """
SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN greatest(s_acctbal, 5000.0) END AS larger FROM supplier
""")
def f21(t):
    balance = F.when(F.col("s_acctbal") > 0, F.col("s_acctbal"))
    return t.supplier.select("s_suppkey", s.greatest_or_null(balance, F.lit(5000.0)).alias("larger"))


@query("F22_arithmetic", """
SELECT o_orderkey, -o_orderkey AS negative, o_orderkey * 2 + o_custkey - 1 AS mixed FROM orders
""")
def f22(t):
    key = F.col("o_orderkey")
    return t.orders.select("o_orderkey", (-key).alias("negative"), (key * 2 + F.col("o_custkey") - 1).alias("mixed"))


@query("F23_percent_text", """
SELECT o_orderstatus, printf('%.2f%%', 100.0 * count(*) / (SELECT count(*) FROM orders)) AS share
FROM orders GROUP BY o_orderstatus
""")
def f23(t):
    total = t.orders.agg(F.count(F.lit(1))).scalar()
    return t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).select(
        "o_orderstatus", s.percent_text(F.col("n") / total).alias("share")
    )


@query("F23_one_digit_text", """
SELECT l_returnflag, printf('%.1f', avg(l_quantity)) AS mean FROM lineitem GROUP BY l_returnflag
""")
def f23_digit(t):
    return t.lineitem.groupBy("l_returnflag").agg(s.fixed_text(F.avg("l_quantity")).alias("mean"))


@query("F25_parameters", """
SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate >= DATE '1999-01-01' AND o_orderstatus = 'O' GROUP BY o_custkey
""")
def f25(t):
    text = (
        "SELECT o_custkey, count(*) AS n FROM {orders} "
        "WHERE o_orderdate >= :first AND o_orderstatus = :status GROUP BY o_custkey"
    )
    return t.spark.sql(text, args={"first": dt.date(1999, 1, 1), "status": "O"}, orders=t.orders)


@query("G07_last_day", "SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') AS last_day FROM orders")
def g07(t):
    return t.orders.select("o_orderkey", s.month_end(F.to_date("o_orderdate")).cast("string").alias("last_day"))
