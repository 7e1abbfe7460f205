"""Rooms and the students who live in them.

``rooms(id, name)``, ``students(id, name, birthday, sex, room)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordering import down, up
from tidemark.functions.scalars import age_years, rounded



def students_per_room(rooms: DataFrame, students: DataFrame) -> DataFrame:
    """Students per room name, fewest first; rooms without students are absent.

    Counted per room id before the join, then added up over rooms of one name.
    """
    per_id = students.filter(F.col("room").isNotNull()).groupBy(F.col("room").alias("id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        rooms.select("id", F.col("name").alias("room_number"))
        .join(per_id, "id")
        .groupBy("room_number")
        .agg(F.sum("n").alias("amount_of_students"))
        .orderBy(up("amount_of_students"), up("room_number"))
    )


def youngest_rooms(rooms: DataFrame, students: DataFrame, as_of: dt.date, k: int = 5) -> DataFrame:
    """Rooms with the lowest mean age; a room without known birthdays comes last."""
    age = age_years(as_of, F.col("birthday"))
    per_id = students.groupBy(F.col("room").alias("id")).agg(
        F.sum(age).alias("years"), F.count(age).alias("known")
    )
    return (
        rooms.select("id", F.col("name").alias("room_number"))
        .join(per_id, "id")
        .groupBy("room_number")
        .agg(F.try_divide(F.sum("years"), F.sum("known")).alias("mean"))
        .select("room_number", rounded(F.col("mean"), 2).alias("students_avg_age"))
        .orderBy(up("students_avg_age"), up("room_number"))
        .limit(k)
    )


def widest_age_spread(rooms: DataFrame, students: DataFrame, as_of: dt.date, k: int = 5) -> DataFrame:
    """Rooms, told apart by id, with the largest age difference; an unknown one comes first."""
    age = age_years(as_of, F.col("birthday"))
    per_id = students.groupBy(F.col("room").alias("id")).agg(
        (F.max(age) - F.min(age)).alias("students_age_difference")
    )
    return (
        rooms.select("id", F.col("name").alias("room_number"))
        .join(per_id, "id")
        .orderBy(down("students_age_difference"), up("room_number"), up("id"))
        .limit(k)
        .select("room_number", "students_age_difference")
    )


def rooms_of_one_sex(rooms: DataFrame, students: DataFrame, sex: str) -> DataFrame:
    """Rooms whose known sexes are all ``sex``; an unknown one does not disqualify a room."""
    alike = (
        students.groupBy(F.col("room").alias("id"))
        .agg(F.count_if(F.col("sex") == sex).alias("same"), F.count_if(F.col("sex") != sex).alias("other"))
        .filter((F.col("same") > 0) & (F.col("other") == 0))
    )
    return rooms.select("id", F.col("name").alias("room_number")).join(alike.select("id"), "id").select("room_number")
