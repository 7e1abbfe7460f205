"""Rooms and students played by customers and orders, or by orders and line items."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.plans import rooms as r
from tidemark.registry import Tables, query
from tidemark.session import new_folder
from tidemark.sinks.files import write_json
from tidemark.sources.files import read_item_lines

AS_OF = dt.date(2002, 1, 1)


def _customers(t: Tables):
    rooms = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    students = t.orders.select(
        F.col("o_custkey").alias("room"), F.col("o_orderdate").alias("birthday"), F.col("o_orderstatus").alias("sex")
    )
    return rooms, students


def _orders(t: Tables):
    rooms = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("name"))
    students = t.lineitem.select(
        F.col("l_orderkey").alias("room"), F.col("l_shipdate").alias("birthday"), F.col("l_linestatus").alias("sex")
    )
    return rooms, students


@query("Q01_count_per_room", """
SELECT c_name AS room_number, count(*) AS amount_of_students
FROM customer JOIN orders ON c_custkey = o_custkey
GROUP BY c_name ORDER BY amount_of_students, room_number
""")
def q01(t):
    return r.students_per_room(*_customers(t))


@query("Q02_lowest_mean_age", """
SELECT c_name AS room_number,
       CAST(round(CAST(avg(extract(year FROM age(DATE '2002-01-01', o_orderdate))) AS DECIMAL(18,10)), 2) AS DOUBLE)
         AS students_avg_age
FROM customer JOIN orders ON c_custkey = o_custkey
GROUP BY c_name ORDER BY students_avg_age ASC NULLS LAST, room_number LIMIT 5
""")
def q02(t):
    return r.youngest_rooms(*_customers(t), AS_OF).withColumn(
        "students_avg_age", F.col("students_avg_age").cast("double")
    )


@query("Q03_age_spread", """
SELECT CAST(o_orderkey AS VARCHAR) AS room_number,
       max(extract(year FROM age(DATE '2002-01-01', l_shipdate)))
       - min(extract(year FROM age(DATE '2002-01-01', l_shipdate))) AS students_age_difference
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY o_orderkey ORDER BY students_age_difference DESC NULLS FIRST, room_number LIMIT 5
""")
def q03(t):
    return r.widest_age_spread(*_orders(t), AS_OF)


def _one_sex(sex: str) -> str:
    return f"""
SELECT CAST(o_orderkey AS VARCHAR) AS room_number
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY o_orderkey
HAVING count(DISTINCT l_linestatus) = 1 AND max(l_linestatus) = '{sex}'
"""


@query("Q04_only_F", _one_sex("F"))
def q04(t):
    return r.rooms_of_one_sex(*_orders(t), "F")


@query("Q05_rooms_job", """
SELECT report, count(*) AS n, min(room_number) AS first_room FROM (
  SELECT 'students_count_in_rooms' AS report, c_name AS room_number FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name
  UNION ALL
  SELECT CASE WHEN max(o_orderstatus) = 'F' THEN 'female_rooms' ELSE 'male_rooms' END, c_name
  FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_name
  HAVING count(DISTINCT o_orderstatus) = 1 AND max(o_orderstatus) IN ('F', 'O'))
GROUP BY report
""")
def q05_job(t):
    """The whole job: two JSON inputs, loaded twice into stored tables, five reports, exported and read back."""
    home = new_folder(t.spark, "rooms-job")
    rooms, students = _customers(t)
    # Orders of open state play the men; the job knows M and F.
    sex = F.when(F.col("sex") == "O", "M").otherwise(F.col("sex")).alias("sex")
    named = t.orders.select(F.col("o_orderkey").alias("id"), F.lit("S").alias("name"), F.to_date("o_orderdate").alias("birthday"),
                            F.col("o_orderstatus").alias("sex"), F.col("o_custkey").alias("room"))
    write_json(rooms, f"{home}/rooms.json")
    write_json(named.select("id", "name", "birthday", sex, "room"), f"{home}/students.json")
    for _ in range(2):
        jobs.rooms_job(t.spark, f"{home}/rooms.json", f"{home}/students.json", f"{home}/tables", f"{home}/out", "json", AS_OF)
    counts = read_item_lines(t.spark, f"{home}/out/json_output/students_count_in_rooms", "room_number string, amount_of_students long")
    found = counts.select(F.lit("students_count_in_rooms").alias("report"), "room_number")
    for name in ("male_rooms", "female_rooms"):
        names = read_item_lines(t.spark, f"{home}/out/json_output/{name}", "string")
        found = found.unionByName(names.select(F.lit(name).alias("report"), F.col("value").alias("room_number")))
    return found.groupBy("report").agg(F.count(F.lit(1)).alias("n"), F.min("room_number").alias("first_room"))


@query("Q05_only_O", _one_sex("O"))
def q05(t):
    return r.rooms_of_one_sex(*_orders(t), "O")
