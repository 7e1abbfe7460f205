import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.merge import insert_if_absent, merge_daily_stats, stamp_changes
from tidemark.operators.policy import apply_row_policy
from tidemark.plans import flights as f
from tidemark.streaming.flights_chain import FlightsChain
from tidemark.tables.versions import ChangeLog

BATCHES = [
    [("0", "P1", "25.6", "6/28/2022", "A", "X", "France"), ("1", "P2", "x", "06/28/2022", "A", "Y", "Spain"),
     ("2", "P3", "40", "not-a-date", "A", "X", "France")],
    [("0", "P1", "25.6", "6/28/2022", "A", "X", "France"), ("3", "P4", "30", "6/28/2022", "A", "X", None),
     ("4", None, "31", "6/29/2022", "B", "Z", "Spain")],
]


def raw(spark, batch):
    named = ["row_index", "passenger_id", "age", "departure_date", "airport_name", "pilot_name", "country_name"]
    df = spark.createDataFrame(batch, ", ".join(f"{c} string" for c in named)).withColumn("arrival_airport", F.lit("ZZZ"))
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in f.RAW_COLUMNS])


def clock():
    minutes = itertools.count()
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return lambda: start + dt.timedelta(minutes=next(minutes))


@pytest.fixture(scope="module")
def mapping(spark):
    return spark.createDataFrame([("ACCOUNTADMIN", "ALL"), ("FRANCE_MANAGER", "France")], "role_name string, allowed_country string")


def gold(chain):
    return sorted(rows(chain.gold.current(), *[F.col("stat_date").cast("string"), "airport_name", "total_flights",
                                               "unique_pilots", "passengers_served"]), key=str)


def test_chain(spark, tmp_path, mapping):
    chain = FlightsChain(spark, str(tmp_path), clock=clock())
    assert chain.pending() == {"raw": False, "silver": False}
    assert chain.run() == ["Processed 0 rows into Silver.", "Gold Layer Updated. Rows merged: 0"]
    chain.land(raw(spark, BATCHES[0]))
    assert chain.pending()["raw"] and chain.pending()["raw"]
    assert chain.run() == ["Processed 3 rows into Silver.", "Gold Layer Updated. Rows merged: 2"]
    assert chain.pending() == {"raw": False, "silver": False}
    assert gold(chain) == [("2022-06-28", "A", 2, 2, 2), (None, "A", 1, 1, 1)]
    chain.land(raw(spark, BATCHES[1]))
    chain.process_silver()
    assert chain.pending() == {"raw": False, "silver": True}
    assert chain.process_gold() == "Gold Layer Updated. Rows merged: 1"
    assert gold(chain) == [("2022-06-28", "A", 3, 2, 3), (None, "A", 1, 1, 1)]
    silver = chain.silver.current()
    ages = dict(rows(silver, "passenger_id", F.col("age").cast("int")))
    assert ages == {"P1": 26, "P2": None, "P3": 40, "P4": 30}
    assert rows(chain.rejects(), "row_index") == [("4",)]

    chain.run()  # nothing new
    assert [r[2] for r in rows(f.audit_latest(chain.audit()))] == [0, 0, 1, 1, 2, 3, 0, 0]
    assert gold(chain)[0][2] == 3

    def visible(role):
        return sorted(r[0] for r in rows(chain.secure_report(mapping, role)))

    assert visible("FRANCE_MANAGER") == ["P1", "P3"]
    assert visible("ACCOUNTADMIN") == ["P1", "P2", "P3", "P4"]
    assert visible("NOBODY") == []
    assert chain.secure_report(mapping, "NOBODY").columns == f.SECURE_COLUMNS

    again = chain.restarted("second")
    assert again.process_silver() == "Processed 0 rows into Silver."

    france = F.col("country_name") == "France"
    before = chain.clock()
    assert chain.silver.delete_where(france, at=chain.clock()) == 2
    assert sorted(rows(chain.silver.current(), "passenger_id")) == [("P2",), ("P4",)]
    assert chain.silver.current(as_of=before).count() == 4
    assert chain.silver.restore(before, france, at=chain.clock()) == 2
    assert chain.silver.current().count() == 4
    assert chain.process_gold() == "Gold Layer Updated. Rows merged: 0"
    assert gold(chain) == [("2022-06-28", "A", 3, 2, 3), (None, "A", 1, 1, 1)]

    copy = chain.silver.clone(f"{tmp_path}/copy", at=chain.clock())
    chain.silver.delete_where(F.lit(True), at=chain.clock())
    assert copy.current().count() == 4 and chain.silver.current().count() == 0
    copy.drop()
    with pytest.raises(LookupError):
        copy.current()
    copy.undrop()
    assert copy.current().count() == 4


def test_failed_run_leaves_an_audit_row_and_repeats(spark, tmp_path, monkeypatch):
    chain = FlightsChain(spark, str(tmp_path), clock=clock())
    chain.land(raw(spark, BATCHES[0]))
    with monkeypatch.context() as patch:
        def broken(*args, **kwargs):
            raise RuntimeError("lost")

        patch.setattr(ChangeLog, "append", broken)
        with pytest.raises(Exception):
            chain.process_silver()
    assert rows(chain.audit(), "status") == [("FAILED",)]
    assert chain.pending()["raw"]
    assert chain.process_silver() == "Processed 3 rows into Silver."


def ids(spark, first, stop):
    return spark.range(first, stop).select(F.col("id").cast("int").alias("id"))


def orphan(df, log, write="w-lost"):
    """A write that was lost before its commit."""
    df.withColumn("_action", F.lit("INSERT")).write.parquet(log._folder(write))


def test_write_that_was_never_committed(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path), "id int", "id")
    log.append(ids(spark, 0, 3), batch="a")
    orphan(ids(spark, 10, 17), log)
    orphan(ids(spark, 20, 29), log, "batch-b")
    assert log.current().count() == 3
    assert log.append(ids(spark, 50, 52), batch="b") == 2
    assert sorted(rows(log.current())) == [(0,), (1,), (2,), (50,), (51,)]
    assert log.append(ids(spark, 0, 9), batch="b") == 2  # what the batch added the first time
    assert log.current().count() == 5
    log.drop()
    log.undrop()
    assert log.current().count() == 5


def test_two_writers_keep_the_rows_of_both(spark, tmp_path, monkeypatch):
    one, two = (ChangeLog(spark, str(tmp_path), "id int", "id") for _ in range(2))
    one.append(ids(spark, 0, 2))
    held = two.commits.state()
    assert one.append(ids(spark, 10, 20)) == 10
    with monkeypatch.context() as patch:
        patch.setattr(two.commits, "state", lambda *args, **kwargs: held)
        assert two.append(ids(spark, 30, 33)) == 3
        assert two.append(ids(spark, 0, 1), "DELETE") == 1
    assert one.current().count() == 14
    assert sorted(r[0] for r in rows(one.log(), "version")) == [1] * 2 + [2] * 14


def recount(chain):
    kept = ["stat_date", "airport_name", "total_flights", "passengers_served"]
    whole = f.daily_stats(chain.silver.current()).select(*kept)
    return sorted(rows(whole), key=str) == sorted(rows(chain.gold.current().select(*kept)), key=str)


def test_gold_counts_committed_rows_once(spark, tmp_path):
    chain = FlightsChain(spark, str(tmp_path), clock=clock())
    batch = raw(spark, BATCHES[0])
    orphan(f.silver_batch(batch, True, chain.clock()).select(*chain.silver.schema.names), chain.silver)
    assert chain.process_gold() == "Gold Layer Updated. Rows merged: 0"
    assert chain.gold.current().count() == 0
    chain.land(batch)
    assert chain.run() == ["Processed 3 rows into Silver.", "Gold Layer Updated. Rows merged: 2"]
    assert recount(chain)


def test_new_checkpoint_drops_no_rows(spark, tmp_path):
    """Streams of the same generation behind new checkpoints count their batches from nought again."""
    chain = FlightsChain(spark, str(tmp_path), clock=clock())
    chain.land(raw(spark, BATCHES[0]))
    chain.run()
    chain.land(raw(spark, BATCHES[1]))
    moved = FlightsChain(spark, str(tmp_path), clock=clock())
    moved._checkpoint = lambda job: f"{tmp_path}/moved/{job}" if job == "silver" else chain._checkpoint(job)
    assert moved.run() == ["Processed 1 rows into Silver.", "Gold Layer Updated. Rows merged: 1"]
    assert moved.pending() == {"raw": False, "silver": False}
    assert moved.silver.current().count() == 4 and recount(moved)


def test_batch_that_fails_after_its_commit_is_reported_when_it_comes_again(spark, tmp_path, monkeypatch):
    chain = FlightsChain(spark, str(tmp_path), clock=clock())
    chain.land(raw(spark, BATCHES[0]))

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(f, "rejected", broken)
        with pytest.raises(Exception):
            chain.process_silver()
    assert chain.silver.current().count() == 3
    assert chain.process_silver() == "Processed 3 rows into Silver."
    merge = chain.gold.write
    with monkeypatch.context() as patch:
        patch.setattr(chain.gold, "write", lambda *args: (merge(*args), broken()))
        with pytest.raises(Exception):
            chain.process_gold()
    assert chain.process_gold() == "Gold Layer Updated. Rows merged: 2"
    assert chain.silver.current().count() == 3 and recount(chain)


def test_same_state_without_broadcasts(spark, tmp_path, monkeypatch):
    """The ways for large batches and large deletions give the same table."""
    from tidemark.operators import merge
    from tidemark.tables import versions

    monkeypatch.setattr(merge, "BROADCAST_KEYS", -1)
    monkeypatch.setattr(versions, "BROADCAST_KEYS", -1)
    chain = FlightsChain(spark, str(tmp_path), clock=clock())
    for batch in BATCHES:
        chain.land(raw(spark, batch))
        chain.process_silver()
    france = F.col("country_name") == "France"
    before = chain.clock()
    assert chain.silver.delete_where(france, at=chain.clock()) == 2
    assert chain.silver.restore(before, france, at=chain.clock()) == 2
    assert chain.silver.restore(before, france, at=chain.clock()) == 0
    assert sorted(rows(chain.silver.current(), "passenger_id")) == [("P1",), ("P2",), ("P3",), ("P4",)]


def test_backlog_in_several_batches(spark, tmp_path):
    chain = FlightsChain(spark, str(tmp_path), clock=clock(), files_per_batch=1)
    for batch in BATCHES:
        chain.land(raw(spark, batch).coalesce(1))
    assert chain.run()[0] == "Processed 4 rows into Silver."
    assert chain.silver.commits.state().last == 2
    assert gold(chain)[0][2] == 3


def test_twins_in_one_batch(spark, tmp_path):
    twins = raw(spark, [BATCHES[0][0], BATCHES[0][0]])
    assert f.silver_batch(twins).count() == 1
    assert f.silver_batch(twins, dedupe_source=False).count() == 2


def test_gold_from_batches_equals_gold_from_one(spark):
    data = raw(spark, [(str(i), f"P{i}", "1", f"6/{1 + i % 3}/2022", "AB"[i % 2], f"L{i % 5}", "x") for i in range(60)])
    silver = f.silver_batch(data)
    at = dt.datetime(2024, 1, 1)
    state = f.daily_stats(silver.limit(0)).withColumn("updated_at", F.lit(at))
    for k in range(3):
        part = silver.filter(F.pmod(F.xxhash64("flight_hash"), F.lit(3)) == k)
        state = merge_daily_stats(state, f.daily_stats(part), at)
    whole = f.daily_stats(silver)
    keep = ["stat_date", "airport_name", "total_flights", "passengers_served"]
    assert sorted(rows(state, *keep)) == sorted(rows(whole, *keep))
    bound = {r[:2]: r[2] for r in rows(whole, "stat_date", "airport_name", "unique_pilots")}
    assert all(r[2] <= bound[r[:2]] for r in rows(state, "stat_date", "airport_name", "unique_pilots"))


def test_null_key_is_added_again(spark):
    kind = "stat_date date, airport_name string, total_flights long, unique_pilots long, passengers_served long"
    batch = spark.createDataFrame([(None, "A", 1, 1, 1)], kind)
    gold_now = batch.withColumn("updated_at", F.lit(dt.datetime(2024, 1, 1)))
    assert merge_daily_stats(gold_now, batch).count() == 2


def test_insert_if_absent_and_stamp(spark):
    batch = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "c", 3)], "id int, v string, pos int")
    target = spark.createDataFrame([(2,)], "id int")
    assert rows(insert_if_absent(batch, target, "id", "pos")) == [(1, "b", 1)]
    old = spark.createDataFrame([(1, "a", "old"), (2, None, "old")], "id int, v string, last_update string")
    new = spark.createDataFrame([(1, "b", "old"), (2, None, "old"), (3, "n", None)], "id int, v string, last_update string")
    assert sorted(rows(stamp_changes(old, new, "id", F.lit("now")), "id", "last_update")) == [(1, "now"), (2, "old"), (3, "now")]


def test_policy_hides_null_countries(spark, mapping):
    df = spark.createDataFrame([(1, "France"), (2, None), (3, "Spain")], "id int, country string")
    assert rows(apply_row_policy(df, mapping, "country", "FRANCE_MANAGER"), "id") == [(1,)]
    assert apply_row_policy(df, mapping, "country", "ACCOUNTADMIN").count() == 3
    assert apply_row_policy(df, mapping, "country").count() == 0


def test_merge_leaves_bucketed_silver_where_it_lies(spark, tmp_path):
    """The batch is dealt to the buckets; above the scan of silver there is no exchange."""
    from tidemark.operators.merge import absent_from

    chain = FlightsChain(spark, str(tmp_path), clock=clock(), buckets=4)
    for batch in BATCHES:
        chain.land(raw(spark, batch))
        chain.process_silver()
    assert chain.silver.current().count() == 4
    files = list((tmp_path / "silver" / "data").glob("write=*/*.parquet"))
    assert files and all(int(file.name.rsplit("_", 1)[1][:5]) < 4 for file in files)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        batch = f.silver_batch(raw(spark, BATCHES[1]))
        fresh = absent_from(batch, chain.silver.current(), "flight_hash")
        assert fresh.count() == 0
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    join = next(i for i, line in enumerate(plan.splitlines()) if "LeftAnti" in line)
    silver = [line for line in plan.splitlines()[join:] if "Bucketed: true" in line]
    assert len(silver) == 1 and "SelectedBucketsCount: 4 out of 4" in silver[0]
    # One exchange deals the batch; the only other one sends the commit rows.
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and plan.index("Exchange hashpartitioning") < plan.index("Bucketed: true")


def test_bucketed_log_keeps_its_number_of_buckets(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"), "id int, v string", "id", buckets=3)
    rows_of = lambda a, b: ids(spark, a, b).withColumn("v", F.lit("x"))
    assert log.append(rows_of(0, 5), batch="a") == 5
    other = ChangeLog(spark, str(tmp_path / "log"), "id int, v string", "id", buckets=7)
    assert other.append(rows_of(5, 9), batch="b") == 4 and other.append(rows_of(0, 99), batch="b") == 4
    assert log.delete_where(F.col("id") < 2) == 2 and sorted(r[0] for r in rows(other.current(), "id")) == list(range(2, 9))
    spark.sql(f"DROP TABLE {log._table()}")  # as in a new application: the folders are found again
    again = ChangeLog(spark, str(tmp_path / "log"), "id int, v string", "id", buckets=9)
    assert again.current().count() == 7 and again.buckets == 3
    orphan(rows_of(50, 60), again)
    assert again.current().count() == 7


def test_gold_rewrites_only_the_dates_of_a_batch(spark, tmp_path):
    chain = FlightsChain(spark, str(tmp_path), clock=clock())
    chain.land(raw(spark, BATCHES[0]))
    chain.run()

    def files():
        return {str(p) for p in (tmp_path / "gold").rglob("*.parquet")}

    before = files()
    assert any("stat_date=2022-06-28" in p for p in before) and any("__HIVE_DEFAULT_PARTITION__" in p for p in before)
    chain.land(raw(spark, [("9", "P9", "30", "7/1/2022", "C", "X", "Spain")]))
    assert chain.run()[1] == "Gold Layer Updated. Rows merged: 1"
    assert before < files() and all("stat_date=2022-07-01" in p for p in files() - before)
    chain.land(raw(spark, [("10", "P9", "30", "6/28/2022", "A", "Q", "Spain"), ("11", "P9", "30", "never", "A", "Q", "Spain")]))
    chain.run()
    kept = before & files()
    assert not kept and recount(chain) is False  # rows without a date are added, not merged
    assert gold(chain) == [("2022-06-28", "A", 3, 2, 3), ("2022-07-01", "C", 1, 1, 1), (None, "A", 1, 1, 1), (None, "A", 1, 1, 1)]


def test_lost_dates_of_gold_are_counted_again(spark, tmp_path):
    import shutil

    chain = FlightsChain(spark, str(tmp_path), clock=clock())
    for batch in BATCHES:
        chain.land(raw(spark, batch))
        chain.run()
    before = gold(chain)
    shutil.rmtree(tmp_path / "gold" / "stat_date=2022-06-28")
    assert gold(chain) == [r for r in before if r[0] != "2022-06-28"]
    assert chain.recount_gold([dt.date(2022, 6, 28)]) == 1
    assert gold(chain) == before
    chain.land(raw(spark, [("9", "P9", "30", "6/28/2022", "A", "Q", "Spain")]))
    chain.run()
    assert gold(chain)[0][2] == before[0][2] + 1


def test_batch_that_comes_again_adds_nothing_to_gold(spark):
    from tidemark.operators.merge import add_batch

    at = dt.datetime(2024, 1, 1)
    data = raw(spark, [(str(i), f"P{i}", "1", "6/1/2022" if i % 3 else "x", "AB"[i % 2], f"L{i % 5}", "x") for i in range(30)])
    silver = f.silver_batch(data)
    empty = f.daily_stats(silver.limit(0), sketch=True).withColumn("updated_at", F.lit(at)).withColumn("last_batch", F.lit("0"))
    stats = f.daily_stats(silver, sketch=True)
    once = add_batch(empty, stats, "b1", at)
    again = add_batch(once, stats, "b1", at)
    counts = ["stat_date", "airport_name", "total_flights", "unique_pilots", "passengers_served", "last_batch"]
    assert sorted(rows(once, *counts), key=str) == sorted(rows(again, *counts), key=str)
    more = rows(add_batch(once, stats, "b2", at).filter("stat_date is not null"), *counts)
    assert {r[2] for r in more} == {2 * r[2] for r in rows(once.filter("stat_date is not null"), *counts)}


def test_sketches_of_batches_estimate_all_pilots(spark):
    from tidemark.operators.merge import add_batch

    at = dt.datetime(2024, 1, 1)
    people = spark.range(60_000).select(
        F.lit(dt.date(2022, 6, 1)).alias("departure_date"), F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("airport_name"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("L"), F.col("id") % 30_011)).alias("pilot_name"),
        F.col("id").cast("string").alias("flight_hash"), F.col("id").alias("passenger_id"))
    state = f.daily_stats(people.limit(0), sketch=True).withColumn("updated_at", F.lit(at)).withColumn("last_batch", F.lit("0"))
    for k in range(3):
        state = add_batch(state, f.daily_stats(people.filter(F.col("id") % 3 >= 0).filter(F.pmod(F.xxhash64("id"), F.lit(3)) == k), sketch=True), f"b{k}", at)
    exact = {r[0]: r[1] for r in rows(f.daily_stats(people), "airport_name", "unique_pilots")}
    once = {r[0]: r[1] for r in rows(f.estimated_pilots(f.daily_stats(people, sketch=True)), "airport_name", "estimated_pilots")}
    for name, bound, estimate in rows(f.estimated_pilots(state), "airport_name", "unique_pilots", "estimated_pilots"):
        assert bound < exact[name] and abs(estimate - exact[name]) <= 0.05 * exact[name] and abs(estimate - once[name]) <= 0.03 * exact[name]
