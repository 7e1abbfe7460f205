import datetime as dt
import json
import pathlib
import xml.etree.ElementTree as ET

import pytest

from tests.conftest import rows
from tidemark import jobs

ROOMS = [{"id": 1, "name": "Room #1"}, {"id": 2, "name": "Room #2"}, {"id": 1, "name": "late"}]
STUDENTS = [
    {"id": 1, "name": "A", "birthday": "2000-01-01T00:00:00.000000", "sex": "M", "room": 1},
    {"id": 2, "name": "B", "birthday": "2003-01-02T00:00:00.000000", "sex": "M", "room": 1},
    {"id": 3, "name": "C", "birthday": "2001-06-15T00:00:00.000000", "sex": "F", "room": 2},
]


def only_part(path):
    (file,) = [p for p in pathlib.Path(path).glob("part-*") if not p.name.endswith(".crc")]
    return file.read_text(encoding="utf-8")


def test_rooms_job(spark, tmp_path):
    (tmp_path / "rooms.json").write_text(json.dumps(ROOMS))
    (tmp_path / "students.json").write_text(json.dumps(STUDENTS))
    args = (str(tmp_path / "rooms.json"), str(tmp_path / "students.json"), str(tmp_path / "home"), str(tmp_path / "out"))
    for _ in range(2):  # a second load adds nothing
        jobs.rooms_job(spark, *args, "json", dt.date(2024, 1, 1))
    assert sorted(rows(spark.read.parquet(f"{args[2]}/rooms"))) == [(1, "Room #1"), (2, "Room #2")]
    assert spark.read.parquet(f"{args[2]}/students").count() == 3
    out = f"{args[3]}/json_output"
    assert json.loads(only_part(f"{out}/students_count_in_rooms")) == [
        {"room_number": "Room #2", "amount_of_students": 1}, {"room_number": "Room #1", "amount_of_students": 2}]
    assert json.loads(only_part(f"{out}/male_rooms")) == ["Room #1"]
    assert json.loads(only_part(f"{out}/rooms_with_min_age")) == [
        {"room_number": "Room #1", "students_avg_age": 22.0}, {"room_number": "Room #2", "students_avg_age": 22.0}]

    jobs.rooms_job(spark, *args, "xml", dt.date(2024, 1, 1))
    root = ET.fromstring(only_part(f"{args[3]}/xml_output/female_rooms"))
    assert root.tag == "rooms" and [(e.tag, e.text) for e in root] == [("room", "Room #2")]
    with pytest.raises(ValueError):
        jobs.rooms_job(spark, *args, "csv", dt.date(2024, 1, 1))


def test_rental_tables_cover_the_schema():
    assert len(jobs.RENTAL_TABLES) == 15


def test_intermediate_tables_of_a_job_are_removed(spark, tmp_path):
    from tidemark.session import job_folder, new_folder

    with job_folder(spark, "report") as path:
        inner = new_folder(spark, "table")
        assert inner.startswith(path)
        spark.range(5).write.parquet(inner)
        spark.read.parquet(inner).write.parquet(str(tmp_path / "kept"))
    assert not pathlib.Path(path.removeprefix("file:")).exists() and spark.read.parquet(str(tmp_path / "kept")).count() == 5
    assert not new_folder(spark, "other").startswith(path)
    with pytest.raises(ZeroDivisionError), job_folder(spark, "empty"):
        1 / 0
