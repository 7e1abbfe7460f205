"""Flights played by events: one batch, and the incremental chain fed in three arrivals."""

from __future__ import annotations

import datetime as dt
import functools
import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merge import merge_daily_stats
from tidemark.operators.ranking import top_k
from tidemark.plans import flights as f
from tidemark.registry import Tables, query
from tidemark.session import new_folder
from tidemark.streaming.flights_chain import FlightsChain

_TYPES = ["airport_name", "country_name", "arrival_airport", "flight_status"]


def raw(t: Tables) -> DataFrame:
    """Events as landing rows, all text; very large values lack a passenger."""
    day = F.date_format("ts", "M/d/yyyy")
    known = F.when(F.col("value") <= 95, F.col("user_id").cast("string"))
    values = {
        "row_index": F.col("event_id").cast("string"), "passenger_id": known, "age": F.col("value").cast("string"),
        "departure_date": F.when(F.col("user_id") % 10 != 0, day).otherwise("soon"), "pilot_name": F.col("props"),
        **{c: F.col("event_type") for c in _TYPES},
    }
    return t.events.select(*[values.get(c, F.lit(c)).alias(c) for c in f.RAW_COLUMNS])


_RAW_SQL = """
WITH raw AS (
  SELECT CAST(event_id AS VARCHAR) AS row_index, CASE WHEN value <= 95 THEN CAST(user_id AS VARCHAR) END AS passenger_id,
         CAST(value AS VARCHAR) AS age, CASE WHEN user_id % 10 <> 0 THEN strftime(ts, '%-m/%-d/%Y') ELSE 'soon' END AS departure_date,
         CASE WHEN user_id % 10 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS day,
         event_type, props, value FROM events),
silver AS (
  SELECT md5(row_index || passenger_id || departure_date || event_type) AS flight_hash, passenger_id, age, day, event_type, props,
         CASE WHEN value < 10 THEN 1 WHEN value < 50 THEN 2 ELSE 3 END AS arrival
  FROM raw WHERE passenger_id IS NOT NULL),
per_arrival AS (
  SELECT arrival, day, event_type, count(*) AS n, count(DISTINCT props) AS pilots, count(passenger_id) AS passengers
  FROM silver GROUP BY arrival, day, event_type)
"""


@query("Q43_silver_batch", _RAW_SQL + """
SELECT flight_hash, passenger_id, CAST(CAST(age AS DECIMAL(38,0)) AS BIGINT) AS age, event_type AS airport_name,
       event_type AS country_name, day AS departure_date, props AS pilot_name FROM silver
""")
def q43(t):
    return f.silver_batch(raw(t)).select(
        "flight_hash", "passenger_id", F.col("age").cast("long").alias("age"), "airport_name", "country_name",
        F.col("departure_date").cast("string").alias("departure_date"), "pilot_name",
    )


@query("Q43_rejected", _RAW_SQL + "SELECT row_index, age FROM raw WHERE passenger_id IS NULL")
def q43_rejected(t):
    return f.rejected(raw(t)).select("row_index", "age")


_STATS_SQL = """
SELECT day AS stat_date, event_type AS airport_name, count(*) AS total_flights,
       count(DISTINCT props) AS unique_pilots, count(passenger_id) AS passengers_served
FROM silver GROUP BY day, event_type
"""


@query("Q44_daily_stats", _RAW_SQL + _STATS_SQL)
def q44(t):
    return f.daily_stats(f.silver_batch(raw(t))).withColumn("stat_date", F.col("stat_date").cast("string"))


@query("J13_additive_merge", _RAW_SQL + """
SELECT day AS stat_date, event_type AS airport_name, CAST(sum(n) AS BIGINT) AS total_flights,
       max(pilots) AS unique_pilots, CAST(sum(passengers) AS BIGINT) AS passengers_served
FROM (SELECT arrival = 1 AS first, day, event_type, count(*) AS n, count(DISTINCT props) AS pilots,
      count(passenger_id) AS passengers FROM silver WHERE day IS NOT NULL GROUP BY 1, 2, 3)
GROUP BY day, event_type
""")
def j13(t):
    silver = f.silver_batch(raw(t)).filter(F.col("departure_date").isNotNull()).join(
        t.events.select(
            F.col("event_id").cast("string").alias("row_index"), (F.col("value") < 10).alias("is_first"),
            F.col("user_id").cast("string").alias("who"), "ts", "event_type",
        ).select(
            F.md5(F.concat("row_index", "who", F.date_format("ts", "M/d/yyyy"), "event_type")).alias("flight_hash"),
            "is_first",
        ),
        "flight_hash",
    )
    at = dt.datetime(2024, 2, 1)
    gold = f.daily_stats(silver.filter("is_first")).withColumn("updated_at", F.lit(at))
    return merge_daily_stats(gold, f.daily_stats(silver.filter("not is_first")), at).drop("updated_at").withColumn(
        "stat_date", F.col("stat_date").cast("string")
    )


def _new_chain(t: Tables, label: str) -> FlightsChain:
    minutes = itertools.count()
    start = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    return FlightsChain(
        t.spark, new_folder(t.spark, label), clock=lambda: start + dt.timedelta(minutes=next(minutes))
    )


def _arrive(t: Tables, chain: FlightsChain) -> Iterator[int]:
    """Land three overlapping arrivals, one at a time."""
    value = F.col("age").cast("double")
    for number, wanted in enumerate((value < 10, value < 50, F.lit(True))):
        chain.land(raw(t).filter(wanted))
        yield number


class _Story:
    """The chain after three overlapping arrivals, a replay, a deletion, a restore and a clone.

    It keeps folders and moments only; results are read from the tables.
    """

    def __init__(self, t: Tables):
        chain = self.chain = _new_chain(t, "flights")
        self.landed = _new_chain(t, "flights-landed")
        next(_arrive(t, self.landed))
        for _ in _arrive(t, chain):
            chain.run()
        chain.restarted("second").process_silver()
        clicks = F.col("country_name") == "click"
        silver = chain.silver
        before = chain.clock()
        silver.delete_where(clicks, at=chain.clock())
        deleted = chain.clock()
        silver.restore(before, clicks, at=chain.clock())
        self.moments = {"loaded": before, "deleted": deleted, "as of before": before, "restored": chain.clock()}
        self.copy = silver.clone(f"{chain.home}/copy", at=chain.clock())
        self.cloned = chain.clock()
        self.copy.drop(at=chain.clock())
        self.copy.undrop(at=chain.clock())
        chain.process_gold()


_STORIES: dict[tuple[str, str], _Story] = {}


def story(t: Tables) -> _Story:
    """Built once per application and folder; the queries below read what it left behind."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _STORIES:
        _STORIES[key] = _Story(t)
    return _STORIES[key]


@query("T01_change_stream", _RAW_SQL + """
SELECT CAST(arrival AS BIGINT) AS version, 'INSERT' AS _action, count(*) AS n FROM silver GROUP BY arrival
UNION ALL SELECT 5, 'DELETE', count(*) FROM silver WHERE event_type = 'click'
UNION ALL SELECT 6, 'RESTORE', count(*) FROM silver WHERE event_type = 'click'
""")
def t01(t):
    log = story(t).chain.silver.log()
    return log.groupBy(F.col("version").cast("long").alias("version"), "_action").agg(F.count(F.lit(1)).alias("n"))


@query("T02_silver_state", _RAW_SQL + "SELECT flight_hash, passenger_id, event_type AS country_name FROM silver")
def t02(t):
    """Three merges into a silver table of this run."""
    chain = _new_chain(t, "flights-silver")
    for _ in _arrive(t, chain):
        chain.process_silver()
    return chain.silver.current().select("flight_hash", "passenger_id", "country_name")


_GOLD_SQL = _RAW_SQL + """
, gold AS (
  SELECT day AS stat_date, event_type AS airport_name, CAST(sum(n) AS BIGINT) AS total_flights,
         max(pilots) AS unique_pilots, CAST(sum(passengers) AS BIGINT) AS passengers_served
  FROM per_arrival WHERE day IS NOT NULL GROUP BY day, event_type
  UNION ALL
  SELECT day, event_type, n, pilots, passengers FROM per_arrival WHERE day IS NULL)
"""


def _gold(t: Tables) -> DataFrame:
    return story(t).chain.gold.current()


@query("T03_gold_state", _GOLD_SQL + "SELECT * FROM gold")
def t03(t):
    """Three runs of both jobs over tables of this run."""
    chain = _new_chain(t, "flights-gold")
    for _ in _arrive(t, chain):
        chain.run()
    return chain.gold.current().drop("updated_at").withColumn("stat_date", F.col("stat_date").cast("string"))


@query("T03_exact_pilots", _GOLD_SQL + """
SELECT stat_date, airport_name, unique_pilots, exact.pilots AS exact_pilots FROM gold
JOIN (SELECT day, event_type, count(DISTINCT props) AS pilots FROM silver GROUP BY day, event_type) exact
  ON stat_date = day AND airport_name = event_type
""")
def t03_exact(t):
    exact = f.daily_stats(story(t).chain.silver.current()).select(
        "stat_date", "airport_name", F.col("unique_pilots").alias("exact_pilots")
    )
    return _gold(t).select("stat_date", "airport_name", "unique_pilots").join(
        exact, ["stat_date", "airport_name"]
    ).withColumn("stat_date", F.col("stat_date").cast("string"))


@query("T03_estimated_pilots", _GOLD_SQL + """
SELECT stat_date, airport_name, unique_pilots, exact.pilots AS exact_pilots, true AS within FROM gold
JOIN (SELECT day, event_type, count(DISTINCT props) AS pilots FROM silver GROUP BY day, event_type) exact
  ON stat_date = day AND airport_name = event_type
""")
def t03_estimated(t):
    """The pilots of all batches as gold's merged sketches estimate them, held against the exact numbers."""
    chain = story(t).chain
    exact = f.daily_stats(chain.silver.current()).select("stat_date", "airport_name", F.col("unique_pilots").alias("exact_pilots"))
    met = f.estimated_pilots(chain.gold.frame()).join(exact, ["stat_date", "airport_name"])
    off = F.abs(F.col("estimated_pilots") - F.col("exact_pilots"))
    return met.select(
        F.col("stat_date").cast("string").alias("stat_date"), "airport_name", "unique_pilots", "exact_pilots",
        (off <= F.greatest(F.lit(1.0), F.col("exact_pilots") * 0.07)).alias("within"),
    )


_RUNS_SQL = _GOLD_SQL + """
, runs AS (
  SELECT 2 * a - 1 AS log_id, 'PROCESS_FLIGHTS_SILVER' AS procedure_name,
         (SELECT count(*) FROM silver WHERE arrival = a) AS rows_affected FROM range(1, 4) r(a)
  UNION ALL
  SELECT 2 * a, 'PROCESS_DAILY_STATS_GOLD', (SELECT count(*) FROM per_arrival WHERE arrival = a) FROM range(1, 4) r(a)
  UNION ALL SELECT 7, 'PROCESS_FLIGHTS_SILVER', 0
  UNION ALL SELECT 8, 'PROCESS_DAILY_STATS_GOLD', 0)
"""


@query("T04_audit", _RUNS_SQL + "SELECT log_id, procedure_name, rows_affected, 'SUCCESS' AS status FROM runs")
def t04(t):
    return story(t).chain.audit().drop("created_at")


@query("Q45_latest_audit", _RUNS_SQL + """
SELECT log_id, procedure_name, rows_affected FROM runs ORDER BY log_id DESC LIMIT 10""")
def q45(t):
    return f.audit_latest(story(t).chain.audit()).select("log_id", "procedure_name", "rows_affected")


@query("F24_messages", _RUNS_SQL + """
SELECT log_id, CASE WHEN procedure_name LIKE '%SILVER' THEN 'Processed ' || rows_affected || ' rows into Silver.'
  ELSE 'Gold Layer Updated. Rows merged: ' || rows_affected END AS message FROM runs""")
def f24(t):
    return story(t).chain.messages()


@query("Q46_silver_preview", _RAW_SQL + """
SELECT flight_hash, passenger_id, event_type AS airport_name FROM silver ORDER BY flight_hash LIMIT 5""")
def q46(t):
    return top_k(story(t).chain.silver.current(), 5, "flight_hash").select("flight_hash", "passenger_id", "airport_name")


@query("Q46_silver_count", _RAW_SQL + "SELECT count(*) AS n FROM silver")
def q46_count(t):
    return story(t).chain.silver.current().agg(F.count(F.lit(1)).alias("n"))


@query("Q47_gold_top", _GOLD_SQL + """
SELECT stat_date, airport_name, total_flights FROM gold
ORDER BY stat_date DESC NULLS FIRST, total_flights DESC, airport_name LIMIT 10""")
def q47(t):
    return f.gold_top(_gold(t)).select(F.col("stat_date").cast("string").alias("stat_date"), "airport_name", "total_flights")


@query("Q48_secure_report", _RAW_SQL + """
SELECT passenger_id, 'first_name' AS first_name, 'last_name' AS last_name, event_type AS country_name,
       event_type AS flight_status FROM silver WHERE event_type = 'view'""")
def q48(t):
    kinds = t.events.select("event_type").distinct()
    mapping = kinds.select(
        F.concat("event_type", F.lit("_manager")).alias("role_name"), F.col("event_type").alias("allowed_country")
    )
    return story(t).chain.secure_report(mapping, "view_manager")


def _pending(t: Tables) -> DataFrame:
    """What waits where the first arrival has just landed, and where everything was taken: ``moment, raw, silver, raw_rows``."""
    moments = {"landed": story(t).landed, "consumed": story(t).chain}
    waits = [c.pending_report().select(F.lit(m).alias("moment"), "raw", "silver", "raw_rows") for m, c in moments.items()]
    return waits[0].unionByName(waits[1])


@query("Q49_pending", _RAW_SQL + """
SELECT 'landed' AS moment, count(*) > 0 AS raw, false AS silver, count(*) AS raw_rows FROM raw WHERE value < 10
UNION ALL SELECT 'consumed', false, false, 0
""")
def q49(t):
    return _pending(t)


@query("Q50_delete_restore_clone", _RAW_SQL + """
SELECT step, CASE WHEN step = 'deleted' THEN (SELECT count(*) FROM silver WHERE event_type <> 'click')
  ELSE (SELECT count(*) FROM silver) END AS n
FROM (SELECT unnest(['loaded', 'deleted', 'as of before', 'restored', 'cloned', 'undropped']) AS step)
""")
def q50(t):
    told = story(t)
    states = {step: told.chain.silver.current(as_of=at) for step, at in told.moments.items()}
    states |= {"cloned": told.copy.current(as_of=told.cloned), "undropped": told.copy.current()}
    counts = [df.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n")) for step, df in states.items()]
    return functools.reduce(DataFrame.unionByName, counts)


@query("T05_replay", _RAW_SQL + """
SELECT (SELECT count(*) FROM raw WHERE value < 10) + (SELECT count(*) FROM raw WHERE value < 50)
       + (SELECT count(*) FROM raw) AS landed, (SELECT count(*) FROM silver) AS kept, 0 AS added_by_replay
""")
def t05(t):
    chain = story(t).chain
    landed = t.spark.read.parquet(chain.landing).agg(F.count(F.lit(1)).alias("landed"))
    replay = chain.audit().filter("log_id = 7").agg(F.max("rows_affected")).scalar()
    kept = chain.silver.current().agg(F.count(F.lit(1))).scalar()
    return landed.select("landed", kept.alias("kept"), replay.alias("added_by_replay"))


@query("T06_has_data", _RAW_SQL + """
SELECT 'landed' AS moment, count(*) > 0 AS raw, count(*) AS raw_rows FROM raw WHERE value < 10
UNION ALL SELECT 'consumed', false, 0
""")
def t06(t):
    return _pending(t).select("moment", "raw", "raw_rows")


@query("T07_layers", _GOLD_SQL + """
SELECT 'silver' AS layer, count(*) AS n FROM silver UNION ALL SELECT 'gold', count(*) FROM gold
UNION ALL SELECT 'rejects', 2 * count(*) FROM raw WHERE passenger_id IS NULL
""")
def t07(t):
    """Rows per layer; the replay set every rejected row aside once more, under its own batch."""
    chain = story(t).chain
    layers = {"silver": chain.silver.current(), "gold": chain.gold.current(), "rejects": chain.rejects()}
    counts = [df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("n")) for name, df in layers.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("T11_clone", _RAW_SQL + "SELECT flight_hash, day AS departure_date FROM silver")
def t11(t):
    return story(t).copy.current().select("flight_hash", F.col("departure_date").cast("string").alias("departure_date"))


@query("T12_drop_undrop", """
SELECT unnest(['cloned', 'dropped', 'undropped']) AS moment, unnest([true, false, true]) AS readable
""")
def t12(t):
    kind = F.col("kind")
    moment = F.when(kind == "DROP", "dropped").when(kind == "UNDROP", "undropped").otherwise("cloned")
    return story(t).copy.commits.frame().select(moment.alias("moment"), (kind != "DROP").alias("readable"))


@query("G11_job_results", _RUNS_SQL + """
SELECT procedure_name, count(*) AS runs, CAST(sum(rows_affected) AS BIGINT) AS rows_affected
FROM runs GROUP BY procedure_name
""")
def g11(t):
    return story(t).chain.audit().groupBy("procedure_name").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("rows_affected").alias("rows_affected")
    )
