import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import predicates as p
from tidemark.functions import scalars as s
from tidemark.functions.ordering import down, up


def col(spark, values, expression, kind="string"):
    return [r[0] for r in rows(spark.createDataFrame([(v,) for v in values], f"x {kind}").select(expression(F.col("x"))))]


def test_strip_symbols(spark):
    texts = ["Good 👍!", "Ёж — да", None, "👍", "a b", "x\u001fy z", "it's \"q\" (1-2); a_b*"]
    assert col(spark, texts, s.strip_symbols) == [
        "Good !", "Ёж  да", "", "", "a b", "x\u001fy z", "it's \"q\" (1-2); ab"]


def test_text(spark):
    assert col(spark, ["mARY ann", "", None], s.first_letter_up) == ["Mary ann", "", None]
    assert col(spark, ["2024-01-02 03:04", None], s.day_text) == ["2024-01-02", ""]
    assert col(spark, ["a", None], lambda c: s.joined(c, F.lit("b"))) == ["ab", None]
    assert col(spark, ["", "abcd", "abcde", None, "👍👍👍👍"], lambda c: p.shorter_than(c, 5)) == [True, True, False, True, True]


def test_hash_keys(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), (None, "3")], "a string, b string")
    bare = [r[0] for r in rows(df.select(s.hash_key(F.col("a"), F.col("b"))))]
    assert bare[0] == bare[1] and bare[2] is None
    safe = [r[0] for r in rows(df.select(s.hash_key_delimited(F.col("a"), F.col("b"))))]
    assert len(set(safe)) == 3 and None not in safe


def test_numbers(spark):
    assert col(spark, ["25.6", "x", " 7 ", None], lambda c: s.whole_number(c).cast("int")) == [26, None, 7, None]
    assert col(spark, [1.005, 2.345, -2.345], lambda c: s.rounded(c).cast("double"), "double") == [1.01, 2.35, -2.35]
    assert col(spark, [1, 9, None], lambda c: s.greatest_or_null(c, F.lit(5)), "int") == [5, 9, None]
    assert col(spark, [0.24081], s.percent_text, "double") == ["24.08%"]


def test_dates(spark):
    d = dt.date
    assert col(spark, ["6/28/2022", "06/28/2022", "not-a-date", "28/6/2022"], s.us_date) == [d(2022, 6, 28)] * 2 + [None] * 2
    ages = col(spark, [d(2000, 2, 29), d(2000, 1, 1), None], lambda c: s.age_years(d(2023, 2, 28), c), "date")
    assert ages == [22, 23, None]
    assert col(spark, [d(2024, 5, 31)], lambda c: s.month_start(c, 3), "date") == [d(2024, 2, 1)]
    assert col(spark, [d(2024, 2, 3), None], s.month_end, "date") == [d(2024, 2, 29), None]
    t = dt.datetime
    stays = spark.createDataFrame([(t(2024, 1, 1), t(2024, 1, 10, 12), 2), (t(2024, 1, 1), None, 2), (t(2024, 1, 1), t(2024, 1, 2), 2)],
                                  "a timestamp, b timestamp, n int")
    assert [r[0] for r in rows(stays.select(s.days_over(F.col("a"), F.col("b"), F.col("n"))))] == [7, 0, 0]
    moments = spark.createDataFrame([(t(2024, 3, 31, 23, 59),), (t(2024, 4, 1),), (t(2024, 3, 1),)], "x timestamp")
    assert moments.filter(p.on_days(F.col("x"), d(2024, 3, 1), d(2024, 3, 31))).count() == 2


def test_missing_values_and_predicates(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "n int, s string")
    assert rows(s.fill_missing(df)) == [("1", "a"), ("-", "-")]
    assert rows(df.agg(p.share(F.col("s") == "a"))) == [(0.5,)]
    assert df.filter(p.is_not(F.col("s") == "a")).count() == 1
    assert df.filter(~p.in_list(F.col("s"), ["a"])).count() == 1
    assert rows(df.agg(p.holds_for_all(F.col("n") == 1))) == [(False,)]
    assert rows(df.limit(0).agg(p.holds_for_all(F.col("n") == 1))) == [(True,)]
    assert [r[0] for r in rows(df.orderBy(up("n")))] == [1, None]
    assert [r[0] for r in rows(df.orderBy(down("n")))] == [None, 1]


def test_patterns(spark):
    assert col(spark, ["abu", "Aa", "x-y"], lambda c: c.like("a%")) == [True, False, False]
    assert col(spark, ["NATION_1", "NATIONX1"], lambda c: c.like("NATION_1%")) == [True, True]
    assert col(spark, ["NATION_1", "NATIONX1"], lambda c: c.like("NATION\\_1%")) == [True, False]


def test_messages():
    assert s.silver_message(3) == "Processed 3 rows into Silver."
    assert s.gold_message(2) == "Gold Layer Updated. Rows merged: 2"


def test_top_rows(spark):
    from tidemark.operators import ranking as r

    df = spark.createDataFrame([(k, n) for k, n in zip("abcdef", (5, 4, 4, 4, 3, 2))], "k string, n int")
    assert sorted(rows(r.highest_levels(df, "n", 3), "k", "rank")) == [("a", 1), ("b", 2), ("c", 2), ("d", 2), ("e", 3)]
    assert sorted(rows(r.reaching_kth(df, "n", 3), "k")) == [("a",), ("b",), ("c",), ("d",)]
    assert r.reaching_kth(df, "n", 99).count() == 6
    assert rows(r.largest_group(spark.createDataFrame([("b", 2), ("a", 2)], "k string, n int"), "k", "n")) == [("a", 2)]
    twins = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (None, "z", 1)], "id int, v string, pos int")
    assert sorted(rows(r.first_per_key(twins, ["id"], "pos"), "v")) == [("y",), ("z",)]
    plan = r.first_per_key(twins, ["id"], "pos")._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning")
    assert "Partial" in after and "Final" in before
    texts = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b"), (5, "c")], "id long, t string")
    assert rows(r.most_frequent(texts, "t", "id", 2)) == [("b", 2), ("a", 2)]


def test_joins(spark):
    from tidemark.operators import joins as j

    one = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    many = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "k int, v string")
    assert sorted(rows(j.left_join_many(one, many, "k")), key=str) == [(1, "a"), (1, "b"), (2, None), (None, None)]
    assert rows(j.having(one, many, "k")) == [(1,)]
    assert sorted(rows(j.without(one, many, "k")), key=str) == [(2,), (None,)]


def test_unknown_texts_raise_no_error_in_ansi_mode(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert col(spark, ["oops"], lambda c: c.try_cast("double")) == [None]
    with pytest.raises(Exception):
        col(spark, ["oops"], lambda c: c.cast("double"))
