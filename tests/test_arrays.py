import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import arrays as a
from tidemark.operators import series as s
from tidemark.operators.distance import distance_matrix, nearest
from tidemark.operators.ordered import running_total
from tidemark.operators.stats import (
    approx_percentiles, from_sketches, groups_where_any, merge_sketches, percentiles, quantile_sketches,
)
from tidemark.operators.text import string_agg, word_index


def one(spark, values, expression, kind="array<int>"):
    return spark.createDataFrame([(values,)], f"v {kind}").select(expression(F.col("v")).alias("x")).first()["x"]


def test_array_functions(spark):
    assert one(spark, [2, 3, 8, 9], lambda v: a.negate_between(v, 3, 8)) == [2, -3, -8, 9]
    assert one(spark, [4, 9, 9, 1], a.blank_first_max) == [4, 0, 9, 1]
    assert one(spark, [4, 9, 9, 1], a.first_max_index) == 1
    assert one(spark, [2, 2, 3], a.not_all_equal) and not one(spark, [3, 3, 3], a.not_all_equal)
    assert one(spark, [6, 2, 0, 3, 0, 0, 5, 7, 0], a.after_zero_max) == 5
    assert one(spark, [1, 2], a.after_zero_max) is None
    assert one(spark, [1, 2], lambda v: a.euclidean(v.cast("array<double>"), F.array(F.lit(4.0), F.lit(6.0)))) == 5.0
    combos = one(spark, [[1, 2], [3, 4]], lambda v: a.row_products(v[0], v[1]), "array<array<int>>")
    assert combos == [[1, 3], [1, 4], [2, 3], [2, 4]]


def test_covers_rows(spark):
    wanted = F.array(F.array(F.lit(1), F.lit(2)), F.array(F.lit(5), F.lit(2)))
    df = spark.createDataFrame([([1, 2, 5],), ([1, 1, 2],), ([1, 3, 4],)], "v array<int>")
    assert rows(df.filter(a.covers_rows(F.col("v"), wanted))) == [([1, 2, 5],)]


def test_same_multiset(spark):
    df = spark.createDataFrame([([1, 2, 2, 4], [4, 2, 1, 2]), ([1, 2, 2, 4], [1, 2, 4, 4])], "a array<int>, b array<int>")
    assert rows(df.select(a.same_multiset(F.col("a"), F.col("b")))) == [(True,), (False,)]
    left, right = (spark.createDataFrame([(x,) for x in v], "v int") for v in ([1, 2, 2, None], [2, None, 1, 2]))
    assert s.same_rows(left, right).first()["same"] is True
    assert s.same_rows(left, right.distinct()).first()["same"] is False


def _series(spark, values, name="s"):
    return spark.createDataFrame([(name, i, v) for i, v in enumerate(values)], "s string, pos int, val int")


def _runs(values):
    out = []
    for i, v in enumerate(values):
        if out and out[-1][1] == v:
            out[-1][2] += 1
        else:
            out.append([i, v, 1])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("block", [1, 2, 3, 1000])
def test_run_lengths_over_blocks(spark, block):
    chance = random.Random(7)
    cases = [[2, 2, 2, 3, 3, 3, 5], [2, 2, 3, 2], [1] * 20, [chance.choice([0, 1, None]) for _ in range(60)]]
    for values in cases:
        got = s.run_lengths(_series(spark, values), "s", "pos", "val", block).orderBy("start_pos")
        assert rows(got, "start_pos", "val", "run_length") == _runs(values)
        decoded = [v for _, v, n in rows(got, "start_pos", "val", "run_length") for _ in range(n)]
        assert decoded == values


@pytest.mark.parametrize("block", [1, 2, 1000])
def test_max_after_over_blocks(spark, block):
    chance = random.Random(3)
    for values in ([6, 2, 0, 3, 0, 0, 5, 7, 0], [1, 2], [chance.randrange(3) for _ in range(50)]):
        want = max((b for p, b in zip(values, values[1:]) if p == 0), default=None)
        assert s.max_after(_series(spark, values), "s", "pos", "val", 0, block).first()["max_after"] == want


def test_first_max_and_diagonal(spark):
    assert rows(s.first_max(_series(spark, [4, 9, 9, 1]), "s", "pos", "val")) == [("s", 1, 9)]
    matrix = [[1, 0, 1], [2, 0, 2], [3, 0, 3], [4, 4, 4]]
    cells = spark.createDataFrame(
        [(i, j, v) for i, row in enumerate(matrix) for j, v in enumerate(row)], "r int, c int, v int")
    assert s.diagonal_product(cells, "r", "c", "v").first()["product"] == 3


def test_distinct_first_seen(spark):
    df = spark.createDataFrame([(0, [2, 1]), (1, [1, 2]), (2, [2, 1])], "pos int, v array<int>")
    assert rows(s.distinct_first_seen(df, ["v"], "pos").orderBy("first_pos"), "v") == [([2, 1],), ([1, 2],)]


def test_running_total_of_a_hot_key(spark):
    data = [("hot", i) for i in range(500)] + [(f"k{i}", 0) for i in range(20)]
    df = spark.createDataFrame(data, "k string, pos int").repartition(5)
    got = rows(running_total(df, ["k"], ["pos"], F.lit(1), "rn"))
    assert sorted(got) == sorted((k, p, p + 1) for k, p in data)


@pytest.mark.parametrize("buffered", [1_000, 0])
def test_percentiles_match_pandas(spark, buffered):
    import pandas as pd

    chance = random.Random(5)
    data = pd.DataFrame({"k": [chance.choice("ab") for _ in range(300)], "v": [float(chance.randrange(50)) for _ in range(300)]})
    df = spark.createDataFrame(data)
    got = {r["k"]: (r["p4"], r["p90"]) for r in percentiles(df, "v", {"p4": 0.04, "p90": 0.9}, ["k"], buffered).collect()}
    for k, part in data.groupby("k")["v"]:
        assert got[k] == pytest.approx((part.quantile(0.04), part.quantile(0.9)))
    whole = percentiles(df, "v", {"m": 0.5}, buffered_values=buffered).first()["m"]
    assert whole == data["v"].median()


def test_string_agg(spark):
    df = spark.createDataFrame([("a", f"{i:03d}", i) for i in range(10)] + [("b", None, 99), ("c", "x", 1), ("c", None, 2)], "k string, v string, id int")
    whole = {"a": ", ".join(f"{i:03d}" for i in range(10)), "b": None, "c": "x"}
    assert dict(rows(string_agg(df, ["k"], "v", "x"))) == whole
    twice = df.unionByName(df)
    assert dict(rows(string_agg(twice, ["k"], "v", "x", distinct=True))) == whole
    assert dict(rows(string_agg(twice, ["k"], "v", "x"))) == {"a": ", ".join(f"{i:03d}, {i:03d}" for i in range(10)), "b": None, "c": "x, x"}


def test_string_agg_keeps_one_row_for_a_large_group(spark):
    found = string_agg(spark.range(150_000).selectExpr("1 AS k", "lpad(id, 6, '0') AS v"), ["k"], "v", "x").collect()
    assert len(found) == 1 and found[0]["x"] == ", ".join(f"{i:06d}" for i in range(150_000))


def test_word_index(spark):
    docs = spark.createDataFrame([(1, "Ab, cd ab!"), (5000, "ab"), (2, "")], "id long, text string")
    assert sorted(rows(word_index(docs, "id", F.col("text")))) == [
        ("ab", 0, 1, [1]), ("ab", 1, 1, [5000]), ("cd", 0, 1, [1])]


@pytest.mark.parametrize("held", [1_000_000, 4])
def test_distances_match_brute_force(spark, held):
    chance = random.Random(1)
    xs = [(i, [chance.random() for _ in range(3)]) for i in range(12)]
    ys = [(i, [chance.random() for _ in range(3)]) for i in range(7)]
    left = spark.createDataFrame(xs, "i long, x array<double>")
    right = spark.createDataFrame(ys, "j long, y array<double>")
    want = {(i, j): sum((p - q) ** 2 for p, q in zip(x, y)) ** 0.5 for i, x in xs for j, y in ys}
    got = {(i, j): d for i, j, d in rows(distance_matrix(left, "i", "x", right, "j", "y", held))}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    with pytest.raises(ValueError):
        distance_matrix(left, "i", "x", right, "j", "y", held_cells=held, most_right=6)


def brute_nearest(xs, ys, n):
    return {i: sorted((sum((p - q) ** 2 for p, q in zip(x, y)) ** 0.5, j) for j, y in ys)[:n] for i, x in xs}


@pytest.mark.parametrize("n, held, pivots", [(1, 4, 2), (3, 5, 4), (2, 1000, 1), (50, 7, 3)])
def test_nearest_equals_brute_force(spark, n, held, pivots):
    chance = random.Random(n)
    xs = [(i, [chance.random() * 9 for _ in range(3)]) for i in range(60)]
    ys = [(i, [chance.random() * 9 for _ in range(3)]) for i in range(40)] + [(100 + i, xs[3][1]) for i in range(9)]
    odd = [(900, None), (901, [float("nan")] * 3), (902, [None, 1.0, 2.0])]
    left, right = spark.createDataFrame(xs + odd, "i long, x array<double>"), spark.createDataFrame(ys + odd, "j long, y array<double>")
    got = {}
    for r in nearest(left, "i", "x", right, "j", "y", n, held, pivots).collect():
        got.setdefault(r.left_id, []).append((r.distance, r.right_id))
    want = brute_nearest(xs, ys, n)
    assert {i: sorted(v) for i, v in got.items()} == {i: [(pytest.approx(d), j) for d, j in v] for i, v in want.items()}
    assert nearest(left, "i", "x", right.limit(0), "j", "y").count() == nearest(left.limit(0), "i", "x", right, "j", "y").count() == 0


def test_nearest_skips_most_pairs_of_low_dimension(spark):
    chance = random.Random(7)
    centres = [[chance.random() * 100 for _ in range(2)] for _ in range(30)]
    ys = [(i, [c + chance.random() for c in centres[i % 30]]) for i in range(3000)]
    xs = [(i, [c + chance.random() for c in centres[i % 30]]) for i in range(300)]
    left, right = spark.createDataFrame(xs, "i long, x array<double>"), spark.createDataFrame(ys, "j long, y array<double>")
    found = nearest(left, "i", "x", right, "j", "y", 2, held_rows=64, pivots=32, compared="compared").collect()
    want = brute_nearest(xs, ys, 2)
    assert sorted((r.left_id, r.right_id) for r in found) == sorted((i, j) for i, v in want.items() for _, j in v)
    share = sum(r.compared for r in found) / 2 / (300 * 3000)
    assert share < 0.15


def test_nearest_refuses_too_many_blocks(spark, monkeypatch):
    from tidemark.operators import distance

    monkeypatch.setattr(distance, "MOST_BLOCKS", 2)
    df = spark.createDataFrame([(i, [float(i)]) for i in range(9)], "i long, x array<double>")
    with pytest.raises(ValueError):
        nearest(df, "i", "x", df, "i", "x", held_rows=1)


def test_nearest_over_many_small_blocks_and_dealt_visits(spark, monkeypatch):
    """Blocks of 20 vectors, of which one, of equal vectors, is visited by most left rows and copied."""
    from tidemark.operators import distance

    monkeypatch.setattr(distance, "HELD_CELLS", 40)
    monkeypatch.setattr(distance, "VISITS", 50)
    chance = random.Random(11)
    ys = [(i, [chance.random() * 90, float(chance.randrange(9))]) for i in range(300)] + [(1000 + i, [5.0, 5.0]) for i in range(90)]
    xs = [(i, [chance.random() * 90, chance.random() * 9]) for i in range(200)] + [(500 + i, [5.0, 5.5]) for i in range(400)]
    ys.append((2000, [float("inf"), 1.0]))
    left, right = spark.createDataFrame(xs, "i long, x array<double>"), spark.createDataFrame(ys, "j long, y array<double>")
    got = {}
    for r in distance.nearest(left, "i", "x", right, "j", "y", 3, held_rows=16, pivots=8).collect():
        got.setdefault(r.left_id, []).append((r.distance, r.right_id))
    want = brute_nearest(xs, ys, 3)
    assert {i: [j for _, j in sorted(v)] for i, v in got.items()} == {i: [j for _, j in v] for i, v in want.items()}


def test_string_agg_in_pieces(spark):
    """A hot group is joined in several pieces, of which each holds a slice of its values."""
    from tidemark.operators.text import text_pieces

    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "lpad(id, 6, '0') AS v")
        pieces = text_pieces(df, ["k"], "v", ",", False).filter("k = 0").orderBy("piece").collect()
        assert len(pieces) >= 2 and max(p.text.count(",") for p in pieces) < 9_900
        assert ",".join(p.text for p in pieces) == ",".join(f"{i:06d}" for i in range(0, 30_000, 3))
        whole = string_agg(df, ["k"], "v", "x", ",")
        assert whole.count() == 20_001 and whole.filter("k = 0").first()["x"] == ",".join(p.text for p in pieces)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


def test_string_agg_of_null_keys_and_empty_texts(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), ("k", ""), ("k", "z"), ("n", None)], "k string, v string")
    assert dict(rows(string_agg(df, ["k"], "v", "x"))) == {None: "a, b", "k": ", z", "n": None}


def test_runs_in_blocks_of_blocks(spark):
    """With blocks of two positions and three blocks a level, no window holds more than a few edges."""
    import itertools

    chance = random.Random(8)
    values = [chance.choice("aab") for _ in range(20_000)] + ["c"] * 500 + [None] * 20
    positions = sorted(chance.sample(range(10**6), len(values)))
    df = spark.createDataFrame([("x", p, v) for p, v in zip(positions, values)] + [("y", 5, "q")], "s string, pos long, v string")
    want = {("y", 5, "q", 1)}
    at = 0
    for v, some in itertools.groupby(values):
        k = len(list(some))
        want.add(("x", positions[at], v, k))
        at += k
    got = rows(s.run_lengths(df, "s", "pos", "v", block=2, fan=3), "s", "start_pos", "val", "run_length")
    assert set(got) == want and len(got) == len(want)
    numbers = [chance.randrange(4) for _ in range(5_000)]
    places = sorted(chance.sample(range(10**5), len(numbers)))
    series = spark.createDataFrame([("x", p, v) for p, v in zip(places, numbers)], "s string, pos long, v int")
    best = max(b for a_, b in zip(numbers, numbers[1:]) if a_ == 0)
    assert rows(s.max_after(series, "s", "pos", "v", 0, block=2, fan=3)) == [("x", best)]


def test_edges_left_for_the_last_window_are_few(spark):
    """A series of 100,000 runs of one: each level leaves two edges per block of blocks."""
    df = spark.range(100_000).selectExpr("'x' AS s", "id AS pos", "id % 2 AS v")
    pieces, done = s._pieces(df, "s", "pos", "v", 2)
    edges, _ = s._merged_levels(pieces, done, 10, s._levels(df, "pos", 2, 10))
    assert edges.count() <= 2 * 10
    runs = s.run_lengths(df, "s", "pos", "v", block=2, fan=10)
    assert runs.count() == 100_000 and runs.filter("run_length <> 1").count() == 0


def test_approximate_percentiles(spark):
    chance = random.Random(9)
    data = [(chance.choice("ab"), chance.lognormvariate(0, 1)) for _ in range(20_000)] + [("a", None), ("c", None), ("b", float("nan"))]
    df = spark.createDataFrame(data, "k string, v double")
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup())
    found = approx_percentiles(df, "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}, ["k"])
    assert len(jobs.getJobIdsForGroup()) == before  # nothing runs while the frame is built
    merged = from_sketches(merge_sketches(quantile_sketches(df.withColumn("part", F.col("v") > 1), "v", ["k", "part"]), ["k"]), {"p50": 0.5})
    for k in "ab":
        known = sorted(v for key, v in data if key == k and v is not None and v == v)

        def off(value, p):
            return abs(sum(v <= value for v in known) / len(known) - p)

        r = found.filter(F.col("k") == k).first()
        assert off(r.p10, 0.1) < 0.015 and off(r.p50, 0.5) < 0.015 and off(r.p99, 0.99) < 0.015
        assert off(merged.filter(F.col("k") == k).first()["p50"], 0.5) < 0.02
        assert merged.filter(F.col("k") == k).first()["n"] == len(known)
    assert found.count() == 2


def test_any_predicate_of_a_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 9), (None, 1), ("b", None)], "k string, v int")
    got = groups_where_any(df, "k", ["v"], lambda g: g["v"].max() - g["v"].min() == 1)
    assert sorted(rows(got, "k", "group_size", "passes")) == [("a", 2, True), ("b", 2, False)]
    with pytest.raises(ValueError):
        groups_where_any(df, "k", ["v"], len, most_rows=1)
    assert groups_where_any(df.limit(0), "k", ["v"], len).count() == 0


def test_groups_travel_together_and_keep_their_types(spark):
    """Several groups come in one call; whole numbers stay so in groups without NULL, as in a frame of the group alone."""
    big = 2**60 + 1
    rows = [(0.0, big, True, "a"), (-0.0, big + 1, False, None), (1.0, 5, None, "b"), (1.0, None, True, "c"), (float("nan"), 7, True, "d"), (None, 1, True, "e")]
    df = spark.createDataFrame(rows + [(float(k), k, True, "x") for k in range(2, 400)], "k double, v long, b boolean, s string").repartition(3)

    def plain(group):
        if len(group) == 2 and group["v"].notna().all():
            return group["v"].dtype == "int64" and group["b"].dtype == bool and sorted(group["v"]) == [big, big + 1] and list(group.index) == [0, 1]
        if len(group) == 2:
            return group["v"].dtype == float and group["b"].dtype == object and group["v"].sum() == 5 and group["b"].isna().sum() == 1
        return group["v"].dtype == "int64" and group["b"].all() and list(group.columns) == ["v", "b", "s"]

    found = groups_where_any(df, "k", ["v", "b", "s"], plain)
    got = found.collect()
    assert len(got) == 401 and all(r.passes for r in got) and sorted(r.group_size for r in got)[-3:] == [1, 2, 2]
    assert found.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).filter(lambda n: n > 1).count() == 1
