"""Projections, filters, joins, sorts and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.arrays import row_products
from tidemark.functions.ordering import down, up
from tidemark.functions.predicates import above_up_to, in_list, is_not, on_days, shorter_than
from tidemark.operators.joins import having, left_join_many, without
from tidemark.operators.merge import absent_from, insert_if_absent
from tidemark.operators.ranking import top_k
from tidemark.operators.series import distinct_first_seen, same_rows
from tidemark.operators.text import string_agg
from tidemark.plans.registered.rental import AMOUNT_SQL, amount, casts, in_units
from tidemark.registry import query


@query("P01_projection", "SELECT o_orderkey AS id, o_totalprice AS price FROM orders")
def p01(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))


@query("P02_constant_column", "SELECT 'order' AS group_name, o_orderkey FROM orders")
def p02(t):
    return t.orders.select(F.lit("order").alias("group_name"), "o_orderkey")


@query("P03_equality_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def p03(t):
    return t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey")


@query("P04_negated_masks", """
SELECT p_partkey FROM part LEFT JOIN (SELECT DISTINCT l_partkey, 'R' AS flag FROM lineitem
  WHERE l_returnflag = 'R' AND l_quantity = 50) ON p_partkey = l_partkey
WHERE p_size > 10 AND NOT coalesce(flag = 'R', false)
""")
def p04(t):
    full = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50)).select(
        F.col("l_partkey").alias("p_partkey"), F.lit("R").alias("flag")
    ).distinct()
    marked = t.part.select("p_partkey", "p_size").join(full, "p_partkey", "left")
    return marked.filter((F.col("p_size") > 10) & is_not(F.col("flag") == "R")).select("p_partkey")


@query("P05_is_null", """
SELECT o_orderkey FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1)
  ON o_orderkey = l_orderkey WHERE shipped IS NULL
""")
def p05(t):
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
    return t.orders.select("o_orderkey").join(shipped, "o_orderkey", "left").filter(
        F.col("shipped").isNull()
    ).select("o_orderkey")


@query("P06_in_list", """
SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS pressing FROM orders
WHERE NOT o_orderstatus IN ('F', 'P')
""")
def p06(t):
    return t.orders.filter(~in_list(F.col("o_orderstatus"), ["F", "P"])).select(
        "o_orderkey", in_list(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"]).alias("pressing")
    )


@query("P07_pattern", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%' OR p_name LIKE '%g w%'")
def p07(t):
    name = F.col("p_name")
    return t.part.filter(name.like("s%") | name.like("%g w%")).select("p_partkey", "p_name")


@query("P08_ranges", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_discount BETWEEN 0.03 AND 0.05 AND l_quantity > 35 AND l_quantity <= 40
""")
def p08(t):
    return t.lineitem.filter(
        F.col("l_discount").between(0.03, 0.05) & above_up_to(F.col("l_quantity"), 35, 40)
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query("P09_days", """
SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-02-01' AND DATE '1997-04-30'
""")
def p09(t):
    days = on_days(F.col("o_orderdate"), dt.date(1997, 2, 1), dt.date(1997, 4, 30))
    return t.orders.filter(days).select("o_orderkey")


@query("P10_scalar_subquery", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)
""")
def p10(t):
    largest = t.lineitem.agg(F.max("l_quantity")).scalar()
    return t.lineitem.filter(F.col("l_quantity") == largest).select("l_orderkey", "l_linenumber", "l_quantity")


@query("P11_short_text", "SELECT doc_id, n_chars FROM documents WHERE length(coalesce(text, '')) < 100")
def p11(t):
    return t.documents.filter(shorter_than(F.col("text"), 100)).select("doc_id", "n_chars")


@query("P12_inserts_only", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'INSERT' END AS action
FROM events WHERE event_type <> 'error'
""")
def p12(t):
    feed = t.events.withColumn("action", F.when(F.col("event_type") == "error", "DELETE").otherwise("INSERT"))
    return feed.filter(F.col("action") == "INSERT").select("event_id", "action")


@query("P13_preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 10")
def p13(t):
    return top_k(t.customer, 10, "c_custkey")


@query("J01_inner_join", """
SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
""")
def j01(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("J02_star_chain", f"""
SELECT r_name, p_type, count(*) AS n, CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey
GROUP BY r_name, p_type
""")
def j02(t):
    lands = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    buyers = t.customer.join(lands, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    bought = t.orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "r_name")
    per_part = (
        t.lineitem.select("l_orderkey", "l_partkey", amount().alias("amount"))
        .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("r_name", "l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    )
    return (
        per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("r_name", "p_type")
        .agg(F.sum("n").alias("n"), in_units(F.sum("total")).alias("total"))
    )


@query("J03_left_join", """
SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_quantity = 50
""")
def j03(t):
    full = t.lineitem.filter(F.col("l_quantity") == 50).select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber"
    )
    return left_join_many(t.orders.select("o_orderkey"), full, "o_orderkey")


@query("J04_anti_join", """
SELECT p_partkey, p_name FROM part LEFT JOIN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50 AND l_tax = 0)
  ON p_partkey = l_partkey WHERE l_partkey IS NULL
""")
def j04(t):
    sold = t.lineitem.filter((F.col("l_quantity") == 50) & (F.col("l_tax") == 0)).select(
        F.col("l_partkey").alias("p_partkey")
    )
    return without(t.part.select("p_partkey", "p_name"), sold, "p_partkey")


@query("J05_left_then_inner", """
SELECT n_name, count(*) AS n FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey
JOIN orders ON c_custkey = o_custkey GROUP BY n_name
""")
def j05(t):
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    per_nation = (
        t.customer.select("c_custkey", "c_nationkey").join(per_customer, "c_custkey")
        .groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("n").alias("n"))
    )
    return t.nation.join(per_nation, "n_nationkey").select("n_name", "n")


@query("J06_semi_join", """
SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)
""")
def j06(t):
    dear = t.orders.filter(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey"))
    return having(t.customer.select("c_custkey"), dear, "c_custkey")


@query("J07_conditions_in_where", """
SELECT s_name, n_name FROM supplier, nation WHERE s_nationkey = n_nationkey AND s_acctbal > 0
""")
def j07(t):
    return t.supplier.filter(F.col("s_acctbal") > 0).join(
        t.nation, F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_name", "n_name")


@query("J08_count_right_key", """
SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
""")
def j08(t):
    counts = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("l_orderkey").alias("n"))
    return t.orders.select("o_orderkey").join(counts, "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("n", F.lit(0)).alias("n")
    )


@query("J09_correlated_list", """
SELECT s_suppkey, p_type, (SELECT string_agg(p2.p_name, ', ' ORDER BY p2.p_name, p2.p_partkey)
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) x JOIN part p2 ON x.l_partkey = p2.p_partkey
  WHERE x.l_suppkey = s_suppkey AND p2.p_type = types.p_type) AS names
FROM (SELECT DISTINCT l_suppkey AS s_suppkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey) types
""")
def j09(t):
    titles = casts(t).join(t.part.select("p_partkey", "p_type", "p_name"), "p_partkey")
    return string_agg(titles, ["s_suppkey", "p_type"], "p_name", "names")


@query("J10_row_products", """
SELECT p_partkey, i * len(b) + j + 1 AS pos, a[i + 1] AS word, b[j + 1] AS mark
FROM (SELECT p_partkey, string_split(p_name, ' ') AS a, [p_brand, p_type] AS b FROM part),
  LATERAL (SELECT unnest(range(len(a))) AS i), LATERAL (SELECT unnest(range(len(b))) AS j)
""")
def j10(t):
    rows = t.part.select(
        "p_partkey",
        F.posexplode(row_products(F.split("p_name", " "), F.array("p_brand", "p_type"))).alias("at", "combination"),
    )
    return rows.select(
        "p_partkey", (F.col("at") + 1).cast("long").alias("pos"),
        F.col("combination")[0].alias("word"), F.col("combination")[1].alias("mark"),
    )


@query("J12_absent_from_target", """
SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def j12(t):
    batch = t.lineitem.select("l_orderkey").distinct()
    target = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    return absent_from(batch, target, "l_orderkey")


@query("S06_insert_if_absent", """
SELECT o_custkey AS id, min(o_orderkey) AS first_order FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_custkey
""")
def s06(t):
    batch = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("first_order"))
    target = t.customer.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("id"))
    return insert_if_absent(batch, target, "id", "first_order")


@query("O01_order_by_aggregate", """
SELECT o_orderpriority, max(o_totalprice) FILTER (WHERE o_orderpriority <> '5-LOW') AS top
FROM orders GROUP BY o_orderpriority ORDER BY top DESC NULLS FIRST, o_orderpriority LIMIT 3
""")
def o01(t):
    top = F.max(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))).alias("top")
    return t.orders.groupBy("o_orderpriority").agg(top).orderBy(down("top"), up("o_orderpriority")).limit(3)


@query("O02_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def o02(t):
    return top_k(t.orders.select("o_orderkey", "o_totalprice"), 10, F.desc("o_totalprice"), "o_orderkey")


@query("O03_sort", "SELECT p_name, p_partkey FROM part ORDER BY p_name, p_partkey")
def o03(t):
    return t.part.select("p_name", "p_partkey").orderBy("p_name", "p_partkey")


@query("O04_sort_filled_text", """
SELECT event_id, CASE WHEN event_type = 'view' THEN '-' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "at"
FROM events ORDER BY "at", event_id
""")
def o04(t):
    at = F.when(F.col("event_type") != "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", F.coalesce(at, F.lit("-")).alias("at")).orderBy("at", "event_id")


@query("O05_two_keys_limit", """
SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
ORDER BY o_orderpriority DESC, o_totalprice DESC, o_orderkey LIMIT 10
""")
def o05(t):
    return top_k(
        t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice"), 10,
        F.desc("o_orderpriority"), F.desc("o_totalprice"), "o_orderkey",
    )


@query("U01_union_of_limits", """
SELECT * FROM (SELECT 'dearest' AS group_name, p_name, p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'cheapest' AS group_name, p_name, p_partkey FROM part ORDER BY p_retailprice, p_partkey LIMIT 1)
""")
def u01(t):
    def one(label, *order):
        return t.part.orderBy(*order).limit(1).select(F.lit(label).alias("group_name"), "p_name", "p_partkey")

    return one("dearest", F.desc("p_retailprice"), "p_partkey").unionByName(
        one("cheapest", F.asc("p_retailprice"), "p_partkey")
    )


@query("U02_distinct_first_seen", """
SELECT event_type, user_id, min(event_id) AS first_pos FROM events GROUP BY event_type, user_id
""")
def u02(t):
    return distinct_first_seen(t.events, ["event_type", "user_id"], "event_id")


@query("U03_same_rows", """
WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1),
     b AS (SELECT c_custkey AS k, count(*) AS n FROM customer GROUP BY 1)
SELECT NOT EXISTS (SELECT 1 FROM a FULL JOIN b USING (k) WHERE a.n IS DISTINCT FROM b.n) AS same
""")
def u03(t):
    return same_rows(t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k")))


@query("U03_same_rows_after_split", """
WITH a AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1),
     b AS (SELECT o_orderkey AS k, count(*) AS n
           FROM (SELECT * FROM orders WHERE o_totalprice >= 250000 UNION ALL SELECT * FROM orders WHERE o_totalprice < 250000) GROUP BY 1)
SELECT NOT EXISTS (SELECT 1 FROM a FULL JOIN b USING (k) WHERE a.n IS DISTINCT FROM b.n) AS same
""")
def u03_split(t):
    low, high = t.orders.filter("o_totalprice < 250000"), t.orders.filter("o_totalprice >= 250000")
    return same_rows(t.orders, high.unionByName(low))
