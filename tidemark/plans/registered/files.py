"""Files written from the tables and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.registry import Tables, query
from tidemark.session import new_folder
from tidemark.sinks import files as sinks
from tidemark.sources import files as sources
from tidemark.streaming import reviews_feed


@query("S02_json_arrays", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def s02(t):
    path = new_folder(t.spark, "json_arrays")
    rows = t.supplier.select("s_suppkey", "s_name", "s_nationkey", F.floor(F.col("s_suppkey") / 10_000).alias("block"))
    sinks.write_json_arrays(rows, path, "block")
    return sources.read_json_arrays(t.spark, path, "s_suppkey long, s_name string, s_nationkey int")


@query("S03_csv_missing_values", """
SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority, o_totalprice FROM orders
""")
def s03(t):
    path = new_folder(t.spark, "csv")
    sinks.write_csv(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), path)
    schema = "o_orderkey long, o_orderpriority string, o_totalprice double"
    return sources.read_csv(t.spark, path, schema, [*sources.NA_VALUES, "4-NOT SPECIFIED"])


@query("S04_vector_lines", """
SELECT p_partkey % 1000 AS pos, count(*) AS n, round(sum(p_retailprice), 2) AS total FROM part GROUP BY 1
""")
def s04(t):
    path = new_folder(t.spark, "vector")
    lines = t.part.groupBy(F.floor(F.col("p_partkey") / 1000).alias("line")).agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", "p_retailprice"))).alias("items")
    )
    text = F.array_join(F.transform("items", lambda i: i["p_retailprice"].cast("string")), " , ")
    lines.select(text.alias("value")).write.text(path)
    return sources.read_vector(t.spark, path).groupBy(F.col("pos").cast("long").alias("pos")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("val"), 2).alias("total")
    )


def _staged(t: Tables):
    """Gzip lines of two fields, a third one too many on error rows, next to a file of another name."""
    path = new_folder(t.spark, "stage")
    fields = [F.col("event_id").cast("string"), F.col("event_type")]
    line = F.when(F.col("event_type") == "error", F.concat_ws(",", *fields, F.lit("extra"))).otherwise(
        F.when(F.col("event_type") == "view", fields[0]).otherwise(F.concat_ws(",", *fields))
    )
    t.events.select(line.alias("value")).write.option("compression", "gzip").text(path)
    t.events.select(F.lit("1,decoy").alias("value")).write.mode("append").option("compression", "none").text(path)
    return path


def _load(t: Tables):
    return sources.load_staged(t.spark, _staged(t), ["event_id", "event_type"], "*.txt.gz", header=False)


@query("S05_staged_rows", """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events WHERE event_type NOT IN ('error', 'view')
""")
def s05(t):
    return _load(t)[0]


@query("S05_staged_bad_lines", """
SELECT CASE WHEN event_type = 'error' THEN event_id || ',error,extra' ELSE CAST(event_id AS VARCHAR) END AS line
FROM events WHERE event_type IN ('error', 'view')
""")
def s05_bad(t):
    return _load(t)[1]


@query("S07_json_export", "SELECT n_nationkey, n_name FROM nation JOIN customer ON n_nationkey = c_nationkey")
def s07(t):
    path = new_folder(t.spark, "json")
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_nationkey", "n_name")
    sinks.write_json(rows, path)
    return sources.read_json_arrays(t.spark, path, "n_nationkey int, n_name string")


@query("S08_xml_export", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'None') AS state
FROM orders
""")
def s08(t):
    path = new_folder(t.spark, "xml")
    state = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("state")
    sinks.write_xml(t.orders.select("o_orderkey", state), path, "orders", "order")
    return t.spark.read.format("xml").option("rowTag", "order").schema("o_orderkey string, state string").load(path)


@query("S09_csv_round_trip", "SELECT doc_id, md5(text) AS digest, n_chars FROM documents")
def s09(t):
    path = new_folder(t.spark, "csv")
    sinks.write_csv(t.documents.select("doc_id", "n_chars", "text"), path)
    back = sources.read_csv(t.spark, path, "doc_id long, n_chars long, text string", na_values=[], multi_line=True, trim=False)
    return back.select("doc_id", F.md5("text").alias("digest"), "n_chars")


@query("S10_append_twice", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY event_type")
def s10(t):
    path = new_folder(t.spark, "documents")
    for _ in range(2):
        sinks.append_documents(t.events.select("event_id", "event_type"), path)
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("S13_stored_view", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def s13(t):
    view = sinks.StoredView(
        t.spark, new_folder(t.spark, "view"),
        lambda: t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")),
    )
    view.refresh()
    return view.read()


def _months(t: Tables):
    path = new_folder(t.spark, "months")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    outside = sinks.write_by_month(rows, "o_orderdate", path, dt.date(1997, 1, 1), dt.date(1998, 1, 1))
    return t.spark.read.parquet(path), outside


@query("S14_one_month", """
SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1997-04-01'
GROUP BY o_custkey
""")
def s14(t):
    stored, _ = _months(t)
    return stored.filter(F.col("pay_month") == "1997-03").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("S14_outside_range", """
SELECT o_orderkey FROM orders WHERE NOT (o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01')
""")
def s14_outside(t):
    return _months(t)[1].select("o_orderkey")


_REVIEW_COLUMNS = ["at", "content", "score", "created_date"]


def _reviews(t: Tables):
    """Events as review files, taken in by the feed."""
    home = new_folder(t.spark, "reviews")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    content = F.concat(F.col("event_type"), F.lit(" <"), F.col("props"), F.lit("> \n"))
    files = t.events.select(
        stamp.alias("at"), F.when(F.col("value") < 90, content).alias("content"),
        F.col("value").cast("string").alias("score"), stamp.alias("created_date"),
    )
    sinks.write_csv(files, f"{home}/landing")
    reviews_feed.ingest(t.spark, f"{home}/landing", f"{home}/documents", f"{home}/checkpoint", _REVIEW_COLUMNS)
    return home, t.spark.read.parquet(f"{home}/documents")


_FEED_SQL = """
WITH docs AS (
  SELECT CASE WHEN value < 90 THEN event_type || ' ' || replace(replace(props, '{', ''), '}', '') || ' ' || chr(10) ELSE '-' END AS content,
         value, strftime(ts, '%Y-%m-%d') AS day FROM events)
"""


@query("S11_file_feed", _FEED_SQL + "SELECT content, count(*) AS n FROM docs GROUP BY content")
def s11(t):
    return _reviews(t)[1].groupBy("content").agg(F.count(F.lit(1)).alias("n"))


@query("S12_downstream_job", "SELECT count(*) AS n FROM events")
def s12(t):
    home, documents = _reviews(t)
    reviews_feed.follow(
        t.spark, f"{home}/documents", documents.drop("batch").schema,
        lambda batch, name: sinks.append_documents(batch, f"{home}/second"), f"{home}/second_checkpoint",
    )
    return t.spark.read.parquet(f"{home}/second").agg(F.count(F.lit(1)).alias("n"))


@query("T08_frequent_reviews", _FEED_SQL + """
SELECT content, count(*) AS "count" FROM docs GROUP BY content ORDER BY 2 DESC, 1 LIMIT 5""")
def t08(t):
    return reviews_feed.report(_reviews(t)[1])["frequent"]


@query("T08_score_by_day", _FEED_SQL + "SELECT day, round(avg(value), 6) AS avg_score FROM docs GROUP BY day")
def t08_days(t):
    return reviews_feed.report(_reviews(t)[1])["score_by_day"].withColumn("avg_score", F.round("avg_score", 6))
