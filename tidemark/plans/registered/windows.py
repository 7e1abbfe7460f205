"""Ranks and ordered series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.ordered import running_total
from tidemark.operators.ranking import first_per_key, highest_levels, reaching_kth
from tidemark.operators.series import first_max, max_after, run_lengths
from tidemark.registry import query

_COUNTS = "WITH counts AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey)"


def _counts(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))


@query("W01_dense_rank", _COUNTS + """
SELECT l_partkey, n, rank FROM (SELECT *, dense_rank() OVER (ORDER BY n DESC) AS rank FROM counts) WHERE rank <= 3
""")
def w01(t):
    return highest_levels(_counts(t), "n", 3).select("l_partkey", "n", "rank")


@query("W02_rank_with_ties", _COUNTS + """
SELECT l_partkey, n FROM (SELECT *, rank() OVER (ORDER BY n DESC) AS r FROM counts) WHERE r <= 3
""")
def w02(t):
    return reaching_kth(_counts(t), "n", 3)


@query("W03_after_marker", """
SELECT user_id, max(val) FILTER (WHERE prev = 0) AS max_after FROM (
  SELECT user_id, val, lag(val) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM (
    SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END AS val
    FROM events)) GROUP BY user_id
""")
def w03(t):
    val = F.when(F.col("event_type") == "error", 0).otherwise(F.round(F.col("value") * 100).cast("long"))
    return max_after(t.events.select("user_id", "event_id", val.alias("val")), "user_id", "event_id", "val", 0)


_RUNS = """
WITH marked AS (SELECT user_id, event_id, event_type,
    CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS starts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM marked)
SELECT user_id, min(event_id) AS start_pos, event_type AS val, count(*) AS run_length
FROM numbered GROUP BY user_id, run, event_type
"""


@query("W04_run_lengths", _RUNS)
def w04(t):
    return run_lengths(t.events, "user_id", "event_id", "event_type")


@query("W05_first_per_key", """
SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id
""")
def w05(t):
    return first_per_key(t.events.select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("W06_first_max", """
SELECT user_id, event_id AS max_pos, value AS max_val FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn = 1
""")
def w06(t):
    return first_max(t.events, "user_id", "event_id", "value")


@query("W05_positions_in_group", """
SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS pos FROM events
""")
def w05_positions(t):
    return running_total(t.events.select("event_type", "event_id"), ["event_type"], ["event_id"], F.lit(1), "pos")
