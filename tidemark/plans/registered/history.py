"""Reading the past of a change log, and change stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.history import delete_where, restore_where, state_as_of
from tidemark.operators.merge import stamp_changes
from tidemark.registry import query

MOMENT = dt.datetime(2024, 1, 15)

_STATE = """
WITH seen AS (SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-15'),
state AS (SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM seen)
  WHERE rn = 1 AND event_type <> 'error')
"""


def _state(t):
    log = t.events.select("user_id", "ts", "event_id", "event_type", "value")
    state = state_as_of(log, ["user_id"], "ts", ["event_id"], MOMENT, F.col("event_type") == "error")
    return state.select("user_id", "event_id", "event_type", "value")


@query("T09_as_of", _STATE + "SELECT * FROM state")
def t09(t):
    return _state(t)


@query("T10_delete", _STATE + "SELECT * FROM state WHERE event_type <> 'click'")
def t10(t):
    return delete_where(_state(t), F.col("event_type") == "click")


@query("T10_restore", _STATE + "SELECT * FROM state")
def t10_restore(t):
    old = _state(t)
    clicks = F.col("event_type") == "click"
    return restore_where(delete_where(old, clicks), old, clicks, ["user_id"])


@query("T13_change_stamp", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'now' ELSE 'then' END AS last_update FROM customer
""")
def t13(t):
    old = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment", F.lit("then").alias("last_update"))
    raised = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    stamped = stamp_changes(old, old.withColumn("c_acctbal", raised), "c_custkey", F.lit("now"))
    return stamped.select("c_custkey", "c_acctbal", "last_update")
