from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import reviews as r
from tidemark.streaming import reviews_feed


def test_clean_and_reports(spark):
    raw = spark.createDataFrame(
        [("2024-01-02 05:00", "Good 👍!", 5, "2024-01-02 05:00"), (None, None, None, None),
         ("2024-01-01 01:00", "Good 👍!", 2, "2024-01-01 01:00")],
        "at string, content string, score int, created_date string")
    clean = r.clean(raw)
    assert rows(clean, "at", "content", "score") == [
        ("-", "-", "-"), ("2024-01-01 01:00", "Good !", "2"), ("2024-01-02 05:00", "Good !", "5")]
    assert rows(r.frequent_contents(clean)) == [("Good !", 2), ("-", 1)]
    assert rows(r.short_contents(clean), "content") == [("-",)]
    assert rows(r.score_by_day(clean)) == [("-", None), ("2024-01-01", 2.0), ("2024-01-02", 5.0)]
    assert "content" not in r.clean(raw.drop("content")).columns


def test_feed(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    paths = (str(landing), str(tmp_path / "docs"), str(tmp_path / "cp"))
    columns = ["at", "content", "score", "created_date"]
    (landing / "empty.csv").write_text("")
    assert reviews_feed.ingest(spark, *paths, columns) == 0
    (landing / "one.csv").write_text('at,content,score,created_date\n2024-01-01,"a, b",5,2024-01-01\n,NA,x,\n')
    assert reviews_feed.ingest(spark, *paths, columns) == 1
    assert reviews_feed.ingest(spark, *paths, columns) == 0
    docs = spark.read.parquet(paths[1])
    assert sorted(rows(docs, "at", "content", "score")) == [("-", "-", "x"), ("2024-01-01", "a, b", "5")]
    found = reviews_feed.report(docs)
    assert rows(found["short_count"]) == [(2,)]
    assert rows(found["score_by_day"]) == [("-", None), ("2024-01-01", 5.0)]

    seen = []
    schema = docs.drop("batch").schema
    for _ in range(2):
        reviews_feed.follow(spark, paths[1], schema, lambda b, n: seen.append(b.count()), str(tmp_path / "cp2"))
    assert seen == [2]
