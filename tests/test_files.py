import datetime as dt
import gzip
import json
import pathlib
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.sinks import files as sinks
from tidemark.sources import files as sources
from tidemark.sources import jdbc


def part_files(path, suffix=""):
    return sorted(p for p in pathlib.Path(path).rglob(f"part-*{suffix}") if not p.name.endswith(".crc"))


def test_json_round_trip(spark, tmp_path):
    path = str(tmp_path / "j")
    frame = spark.createDataFrame([("north", 3, None), ('a "b" [c], {', 4, 1.5)], "wing string, beds int, note double")
    sinks.write_json(frame, path, single_file=True)
    (file,) = part_files(path)
    assert json.loads(file.read_text(encoding="utf-8")) == [
        {"wing": "north", "beds": 3, "note": None}, {"wing": 'a "b" [c], {', "beds": 4, "note": 1.5}]
    assert sorted(rows(sources.read_json_arrays(spark, path, "wing string, beds int"))) == [('a "b" [c], {', 4), ("north", 3)]


def test_json_of_plain_values_and_text(spark, tmp_path):
    path = str(tmp_path / "j")
    sinks.write_json(spark.createDataFrame([("Ёж <&>",), ("b",), (None,)], "value string"), path, single_file=True)
    text = part_files(path)[0].read_text(encoding="utf-8")
    assert "Ёж" in text and json.loads(text) == ["Ёж <&>", "b", None]


def test_large_json_files_are_cut_and_read_by_line(spark, tmp_path, monkeypatch):
    """No reader has to hold a file of any size; items are read line by line where an array is one file."""
    monkeypatch.setattr(sinks, "FILE_LINES", 10)
    many, one, plain = (str(tmp_path / n) for n in ("many", "one", "plain"))
    frame = spark.range(100).select("id", F.concat(F.lit('a "],\n['), "id").alias("name")).coalesce(1)
    sinks.write_json(frame, many)
    arrays = [json.loads(f.read_text()) for f in part_files(many)]
    assert [len(a) for a in arrays] == [9] * 11 + [1] and [r["id"] for a in arrays for r in a] == list(range(100))
    sinks.write_json(frame.limit(27), many + "-27")
    assert [len(json.loads(f.read_text())) for f in part_files(many + "-27")] == [9] * 3
    sinks.write_json(frame.orderBy(F.desc("id")), one, single_file=True)
    assert [r["id"] for r in json.loads(part_files(one)[0].read_text())] == list(range(99, -1, -1))
    for path in (many, one):
        assert sorted(rows(sources.read_item_lines(spark, path, "id long, name string"))) == sorted(rows(frame))
    sinks.write_json(spark.createDataFrame([("Ё",), (None,), ("]",), ("[]",)], "value string"), plain, single_file=True)
    assert [r.value for r in sources.read_item_lines(spark, plain, "string").collect()] == ["Ё", None, "]", "[]"]
    sinks.write_json(frame.limit(0), plain, single_file=True)
    assert sources.read_item_lines(spark, plain, "id long").count() == 0


def test_json_keeps_all_rows_in_order_beyond_any_limit(spark, tmp_path):
    many, one, none = (str(tmp_path / n) for n in ("many", "one", "none"))
    frame = spark.range(120_000).repartition(4).orderBy("id")
    sinks.write_json(frame, many)
    assert sources.read_json_arrays(spark, many, "id long").distinct().count() == 120_000
    arrays = [json.loads(f.read_text()) for f in part_files(many)]
    assert [r["id"] for a in arrays for r in a] == list(range(120_000))
    sinks.write_json(frame, one, single_file=True)
    (file,) = part_files(one)
    assert [r["id"] for r in json.loads(file.read_text())] == list(range(120_000))
    sinks.write_json(frame.limit(0), none, single_file=True)
    assert json.loads(part_files(none)[0].read_text()) == []


def test_xml(spark, tmp_path):
    path = str(tmp_path / "x")
    frame = spark.createDataFrame([("north", None), ("<&>", "Ё")], "wing string, note string")
    sinks.write_xml(frame, path, "wings", "wing", single_file=True)
    (file,) = part_files(path)
    root = ET.fromstring(file.read_text(encoding="utf-8"))
    assert root.tag == "wings" and [{e.tag: e.text for e in entry} for entry in root] == [{"wing": "north", "note": "None"}, {"wing": "<&>", "note": "Ё"}]
    plain = str(tmp_path / "p")
    sinks.write_xml(spark.createDataFrame([("a",), ("b",)], "value string"), plain, single_file=True)
    root = ET.fromstring(part_files(plain)[0].read_text(encoding="utf-8"))
    assert root.tag == "items" and [(e.tag, e.text) for e in root] == [("item", "a"), ("item", "b")]


def test_xml_is_written_in_parts(spark, tmp_path):
    path = str(tmp_path / "x")
    sinks.write_xml(spark.range(0, 100, 1, 4), path)
    found = [e.find("id").text for f in part_files(path) for e in ET.fromstring(f.read_text())]
    assert sorted(map(int, found)) == list(range(100)) and len(part_files(path)) == 4


def test_a_large_csv_file_is_read_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_csv(spark.range(200_000).selectExpr("id", "repeat('x', 40) AS pad").coalesce(1), path)
    assert len(part_files(path)) == 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        back = sources.read_csv(spark, path, "id long, pad string")
        assert back.rdd.getNumPartitions() > 4 and back.count() == 200_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_missing_values_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,s\n1,"two\nlines, ""quoted"""\nNA,null\nbad,ok\n')
    got = rows(sources.read_csv(spark, str(tmp_path), "n int, s string", multi_line=True))
    assert got == [(1, 'two\nlines, "quoted"'), (None, None), (None, "ok")]


def test_staged_load(spark, tmp_path):
    def write(name, lines):
        with gzip.open(tmp_path / name, "wt") as file:
            file.write("\n".join(["a,b", *lines]) + "\n")

    write("1_flights.csv.gz", ["1,x", "2,y,z", "3"])
    write("2_flights.csv.gz", ['4,"p,q"'])
    write("other.csv.gz", ["9,no"])
    good, bad = sources.load_staged(spark, str(tmp_path), ["a", "b"], "*flights.csv.gz")
    assert sorted(rows(good)) == [("1", "x"), ("4", "p,q")]
    assert sorted(rows(good, "b")) == [("p,q",), ("x",)]
    assert sorted(rows(bad)) == [("2,y,z",), ("3",)]


def test_stored_view(spark, tmp_path):
    view = sinks.StoredView(spark, str(tmp_path / "v"), lambda: spark.range(3))
    with pytest.raises(LookupError):
        view.read()
    view.refresh()
    assert view.read().count() == 3


def test_month_folders(spark, tmp_path):
    t = dt.datetime
    df = spark.createDataFrame([(1, t(2022, 1, 1)), (2, t(2022, 7, 31, 23, 59)), (3, t(2022, 8, 1)), (4, None)], "id int, at timestamp")
    outside = sinks.write_by_month(df, "at", str(tmp_path / "m"), dt.date(2022, 1, 1), dt.date(2022, 8, 1))
    assert sorted(rows(outside, "id")) == [(3,), (4,)]
    back = spark.read.parquet(str(tmp_path / "m"))
    assert sorted(rows(back, "id", "pay_month")) == [(1, "2022-01"), (2, "2022-07")]
    plan = back.filter(F.col("pay_month") == "2022-07")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pay_month" in plan


class FakeReader:
    """Stands in for the JDBC reader; notes the options of every load."""

    def __init__(self, spark, loads, tables):
        self.spark, self.loads, self.tables, self.set = spark, loads, tables, {}

    def format(self, name):
        assert name == "jdbc"
        return FakeReader(self.spark, self.loads, self.tables)

    def option(self, key, value):
        self.set[key] = value
        return self

    def options(self, **values):
        self.set.update(values)
        return self

    def load(self):
        self.loads.append(dict(self.set))
        name = self.set.get("dbtable", self.set.get("query"))
        if name not in self.tables:
            raise RuntimeError(f"no table {name}")
        return self.tables[name]


class FakeSession:
    def __init__(self, spark, tables):
        self.loads = []
        self.read = FakeReader(spark, self.loads, tables)


def test_jdbc_slices_and_failures(spark):
    tables = {
        "select 1 as one": spark.range(1), "film": spark.range(5), "city": spark.range(2),
        "select min(film_id) as lo, max(film_id) as hi from film": spark.createDataFrame([(1, 1000)], "lo int, hi int"),
    }
    session = FakeSession(spark, tables)
    db = jdbc.Database("jdbc:test", {"user": "u"})
    opened, failed = jdbc.load_tables(session, db, {"film": jdbc.Slices("film_id", 8), "city": None, "gone": None})
    assert sorted(opened) == ["city", "film"] and list(failed) == ["gone"]
    film = next(x for x in session.loads if "numPartitions" in x)
    assert (film["partitionColumn"], film["lowerBound"], film["upperBound"], film["numPartitions"]) == ("film_id", "1", "1000", 8)
    with pytest.raises(RuntimeError):
        jdbc.load_tables(FakeSession(spark, {}), db, {"film": None})
