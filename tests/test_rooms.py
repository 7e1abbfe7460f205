import datetime as dt
from decimal import Decimal

import pytest

from tests.conftest import rows
from tidemark.plans import rooms as r

AS_OF = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def house(spark):
    rooms = spark.createDataFrame(
        [(1, "101"), (2, "102"), (3, "103"), (4, "104"), (5, "101"), (6, "106")], "id int, name string"
    )
    d = dt.date
    students = spark.createDataFrame(
        [
            (1, "A", d(2000, 1, 1), "M", 1), (2, "B", d(2003, 1, 2), "M", 1), (3, "C", d(2001, 6, 15), "F", 2),
            (4, "D", None, "F", 2), (5, "E", None, "M", 3), (6, "F", d(1999, 12, 31), None, 3),
            (7, "G", d(2004, 2, 29), "F", 5), (8, "H", None, "M", None), (9, "I", None, "M", 6),
        ],
        "id int, name string, birthday date, sex string, room int",
    )
    return rooms, students


def test_students_per_room(house):
    assert rows(r.students_per_room(*house)) == [("106", 1), ("102", 2), ("103", 2), ("101", 3)]


def test_youngest_rooms(house):
    assert rows(r.youngest_rooms(*house, AS_OF)) == [
        ("101", Decimal("21.00")), ("102", Decimal("22.00")), ("103", Decimal("24.00")), ("106", None),
    ]


def test_widest_age_spread(house):
    assert rows(r.widest_age_spread(*house, AS_OF)) == [
        ("106", None), ("101", 4), ("101", 0), ("102", 0), ("103", 0),
    ]


def test_rooms_of_one_sex(house):
    assert sorted(rows(r.rooms_of_one_sex(*house, "M"))) == [("101",), ("103",), ("106",)]
    assert sorted(rows(r.rooms_of_one_sex(*house, "F"))) == [("101",), ("102",)]
