"""Array columns: embeddings scaled to small whole numbers, and their distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import arrays as a
from tidemark.operators.distance import distance_matrix, nearest
from tidemark.operators.ranking import first_per_key
from tidemark.operators.series import diagonal_product, distinct_first_seen, run_lengths
from tidemark.operators.text import word_index
from tidemark.registry import Tables, query

_INTS = """
WITH ints AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 20) AS BIGINT)) AS v
  FROM embeddings)
"""


def _ints(t: Tables) -> DataFrame:
    scaled = F.transform("embedding", lambda x: F.round(x.cast("double") * 20).cast("long"))
    return t.embeddings.select("vec_id", "label", scaled.alias("v"))


def _text(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: x.cast("string")), ",")


@query("X01_negate_between", _INTS + """
SELECT vec_id, array_to_string(list_transform(v, lambda x: CASE WHEN x BETWEEN 3 AND 8 THEN -x ELSE x END), ',') AS v FROM ints
""")
def x01(t):
    return _ints(t).select("vec_id", _text(a.negate_between(F.col("v"), 3, 8)).alias("v"))


@query("X02_blank_first_max", _INTS + """
SELECT vec_id, array_to_string(list_transform(v, lambda x, i: CASE WHEN i = list_position(v, list_max(v)) THEN 0 ELSE x END), ',') AS v
FROM ints
""")
def x02(t):
    return _ints(t).select("vec_id", _text(a.blank_first_max(F.col("v"))).alias("v"))


@query("X03_row_products", """
SELECT p_partkey, array_to_string(list_transform(flatten(list_transform(string_split(p_name, ' '),
  lambda x: list_transform([p_brand, p_type], lambda y: x || '/' || y))), lambda z: z), ',') AS combinations FROM part
""")
def x03(t):
    combos = a.row_products(F.split("p_name", " "), F.array("p_brand", "p_type"))
    return t.part.select(
        "p_partkey", F.array_join(F.transform(combos, lambda c: F.array_join(c, "/")), ",").alias("combinations")
    )


@query("X04_covers_rows", _INTS + """
SELECT vec_id FROM ints
WHERE len(list_filter(v, lambda x: x IN (5, 6))) = 2 AND len(list_filter(v, lambda x: x IN (-6, -5))) = 2
""")
def x04(t):
    wanted = F.array(
        F.array(F.lit(5).cast("long"), F.lit(6).cast("long")), F.array(F.lit(-6).cast("long"), F.lit(-5).cast("long"))
    )
    return _ints(t).filter(a.covers_rows(F.col("v"), wanted)).select("vec_id")



def _lines(t: Tables) -> DataFrame:
    """Smallest, middle and largest line number of each order as a row of three."""
    return t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_linenumber").alias("low"), F.max("l_linenumber").alias("high"), F.count(F.lit(1)).alias("n")
    ).select("l_orderkey", F.array(F.col("low").cast("long"), F.col("high").cast("long"), F.col("n")).alias("v"))


_ROWS = """
WITH rows AS (SELECT l_orderkey, min(l_linenumber)::BIGINT AS low, max(l_linenumber)::BIGINT AS high, count(*) AS n
  FROM lineitem GROUP BY l_orderkey)
"""


@query("X05_not_all_equal", _ROWS + """
SELECT l_orderkey, low || ',' || high || ',' || n AS v FROM rows WHERE NOT (low = high AND high = n)
""")
def x05(t):
    return _lines(t).filter(a.not_all_equal(F.col("v"))).select("l_orderkey", _text(F.col("v")).alias("v"))


@query("X06_distinct_rows", _ROWS + """
SELECT low || ',' || high || ',' || n AS v, min(l_orderkey) AS first_pos FROM rows GROUP BY 1
""")
def x06(t):
    return distinct_first_seen(_lines(t), ["v"], "l_orderkey").select(_text(F.col("v")).alias("v"), "first_pos")


@query("X07_diagonal_product", _INTS + """
, cells AS (SELECT vec_id, unnest(v) AS val, unnest(range(64)) AS p FROM ints)
SELECT vec_id, product(val) AS product FROM cells WHERE p // 16 = p % 16 AND val <> 0 GROUP BY vec_id
""")
def x07(t):
    cells = _ints(t).select("vec_id", F.posexplode("v").alias("p", "val")).select(
        "vec_id", F.floor(F.col("p") / 16).alias("row"), (F.col("p") % 16).alias("col"), "val"
    )
    return diagonal_product(cells, "row", "col", "val", ["vec_id"])


@query("X08_same_multiset", _INTS + """
SELECT vec_id, list_sort(v[1:32]) = list_sort(v[33:64]) AS halves, list_sort(v) = list_sort(list_reverse(v)) AS reversed
FROM ints
""")
def x08(t):
    v = F.col("v")
    return _ints(t).select(
        "vec_id", a.same_multiset(F.slice(v, 1, 32), F.slice(v, 33, 32)).alias("halves"),
        a.same_multiset(v, F.reverse(v)).alias("reversed"),
    )


@query("X09_after_zero_max", _INTS + """
SELECT vec_id, max(val) FILTER (WHERE prev = 0) AS best FROM (
  SELECT vec_id, val, lag(val) OVER (PARTITION BY vec_id ORDER BY p) AS prev
  FROM (SELECT vec_id, unnest(v) AS val, unnest(range(64)) AS p FROM ints)) GROUP BY vec_id
""")
def x09(t):
    return _ints(t).select("vec_id", a.after_zero_max(F.col("v")).alias("best"))


@query("X10_run_lengths", _INTS + """
, cells AS (SELECT vec_id, unnest(v) AS val, unnest(range(64)) AS p FROM ints),
marked AS (SELECT *, CASE WHEN val = lag(val) OVER (PARTITION BY vec_id ORDER BY p) THEN 0 ELSE 1 END AS starts FROM cells),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY vec_id ORDER BY p) AS run FROM marked)
SELECT vec_id, min(p) AS start_pos, val, count(*) AS run_length FROM numbered GROUP BY vec_id, run, val
""")
def x10(t):
    return run_lengths(_ints(t).select("vec_id", F.posexplode("v").alias("p", "val")), "vec_id", "p", "val")


_EXEMPLARS = """
WITH exemplars AS (SELECT arg_min(vec_id, vec_id) AS right_id, arg_min(embedding, vec_id) AS e FROM embeddings GROUP BY label),
pairs AS (SELECT vec_id AS left_id, right_id, list_distance(embedding::DOUBLE[], e::DOUBLE[]) AS d FROM embeddings, exemplars)
"""


def _exemplars(t: Tables) -> DataFrame:
    """The first vector of each label."""
    first = first_per_key(t.embeddings.select("label", "vec_id", "embedding"), ["label"], "vec_id")
    return first.select(F.col("vec_id").alias("right_id"), F.col("embedding").alias("e"))


@query("X11_distance_matrix", _EXEMPLARS + "SELECT left_id, right_id, round(d, 6) AS distance FROM pairs")
def x11(t):
    found = distance_matrix(t.embeddings, "vec_id", "embedding", _exemplars(t), "right_id", "e")
    return found.withColumn("distance", F.round("distance", 6))


@query("X11_distance_matrix_in_blocks", _EXEMPLARS + "SELECT left_id, right_id, round(d, 6) AS distance FROM pairs")
def x11_blocks(t):
    found = distance_matrix(t.embeddings, "vec_id", "embedding", _exemplars(t), "right_id", "e", held_cells=200)
    return found.withColumn("distance", F.round("distance", 6))


_NEAREST = _EXEMPLARS + """
SELECT left_id, right_id, round(d, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY d, right_id) AS rn FROM pairs) WHERE rn <= 2
"""


@query("J11_nearest", _NEAREST)
def j11(t):
    found = nearest(t.embeddings, "vec_id", "embedding", _exemplars(t), "right_id", "e", n=2)
    return found.withColumn("distance", F.round("distance", 6))


@query("J11_nearest_suppliers", """
WITH pairs AS (SELECT c_custkey AS left_id, s_suppkey AS right_id,
  sqrt(pow(c_acctbal - s_acctbal, 2) + pow(100 * (c_nationkey - s_nationkey), 2)) AS d FROM customer, supplier)
SELECT left_id, right_id, round(d, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY d, right_id) AS rn FROM pairs) WHERE rn <= 3
""")
def j11_suppliers(t):
    """The three suppliers whose balance and nation are nearest to each customer's, in blocks of at most 16 suppliers."""
    def place(balance, nation):
        return F.array(F.col(balance).cast("double"), 100 * F.col(nation).cast("double"))

    customers = t.customer.select("c_custkey", place("c_acctbal", "c_nationkey").alias("x"))
    suppliers = t.supplier.select("s_suppkey", place("s_acctbal", "s_nationkey").alias("y"))
    found = nearest(customers, "c_custkey", "x", suppliers, "s_suppkey", "y", n=3, held_rows=16, pivots=16)
    return found.withColumn("distance", F.round("distance", 6))


@query("X12_word_index", """
WITH tokens AS (SELECT doc_id, unnest(list_distinct(list_filter(
    regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''))) AS term FROM documents)
SELECT term, doc_id // 4096 AS block, count(*) AS n_ids, string_agg(doc_id, ',' ORDER BY doc_id) AS ids
FROM tokens GROUP BY term, block
""")
def x12(t):
    return word_index(t.documents, "doc_id", F.col("text")).withColumn("ids", _text(F.col("ids")))
