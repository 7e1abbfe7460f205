"""Whole jobs: load, report, export."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import insert_if_absent
from tidemark.plans import rental, rooms
from tidemark.sinks.files import write_json, write_xml
from tidemark.sources.files import read_json_arrays
from tidemark.sources.jdbc import Database, Slices, load_tables

# The columns of the two inputs of the rooms job.
ROOMS_SCHEMA = "id int, name string"
STUDENTS_SCHEMA = "id int, name string, birthday date, sex string, room int"

# The tables of the rental schema, with the number each scan is cut by.
RENTAL_TABLES = {
    "actor": None, "address": None, "category": None, "city": None, "country": None, "language": None,
    "staff": None, "store": None,
    "customer": "customer_id", "film": "film_id", "film_actor": "film_id", "film_category": "film_id",
    "inventory": "inventory_id", "payment": "payment_id", "rental": "rental_id",
}


def load_once(spark: SparkSession, files: str, schema: str, table: str) -> DataFrame:
    """Add the rows of JSON array files whose id the stored table lacks; returns the table.

    The first row of an id wins, also within one file; stored rows never change.
    """
    incoming = read_json_arrays(spark, files, schema).withColumns(
        {"_file": F.input_file_name(), "_at": F.monotonically_increasing_id()}
    )
    try:
        stored = spark.read.schema(schema).parquet(table)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], schema)
    fresh = insert_if_absent(incoming, stored, "id", "_file", "_at").drop("_file", "_at")
    fresh.write.mode("append").parquet(table)
    return spark.read.schema(schema).parquet(table)


def room_reports(room: DataFrame, student: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    """The five reports on rooms and students; the last two are lists of room names."""
    # The report names.
    one_sex = {name: rooms.rooms_of_one_sex(room, student, sex) for name, sex in (("male", "M"), ("female", "F"))}
    return {
        "students_count_in_rooms": rooms.students_per_room(room, student),
        "rooms_with_min_age": rooms.youngest_rooms(room, student, as_of),
        "rooms_with_max_age_diff": rooms.widest_age_spread(room, student, as_of),
        **{f"{name}_rooms": df.select(F.col("room_number").alias("value")) for name, df in one_sex.items()},
    }


def export(reports: Mapping[str, DataFrame], path: str, fmt: str) -> None:
    """Each report below ``json_output`` or ``xml_output``."""
    if fmt not in ("json", "xml"):
        raise ValueError(f"format {fmt!r} is neither json nor xml")
    for name, df in reports.items():
        if fmt == "json":
            write_json(df, f"{path}/json_output/{name}", single_file=True)
        else:
            write_xml(df, f"{path}/xml_output/{name}", "rooms", "room", single_file=True)


def rooms_job(
    spark: SparkSession, rooms_files: str, students_files: str, home: str, out: str, fmt: str, as_of: dt.date
) -> dict[str, DataFrame]:
    """Load rooms and students into stored tables, run the five reports, export them."""
    room = load_once(spark, rooms_files, ROOMS_SCHEMA, f"{home}/rooms")
    student = load_once(spark, students_files, STUDENTS_SCHEMA, f"{home}/students")
    reports = room_reports(room, student, as_of)
    export(reports, out, fmt)
    return reports


def rental_tables(spark: SparkSession, db: Database, slices: int = 16) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The fifteen rental tables over JDBC, large ones in parallel slices, and those that failed.

    Language names arrive padded with blanks; the search vector of a film has no Spark type.
    """
    cut = {name: Slices(column, slices) if column else None for name, column in RENTAL_TABLES.items()}
    opened, failed = load_tables(spark, db, cut)
    if "language" in opened:
        opened["language"] = opened["language"].withColumn("name", F.rtrim("name"))
    if "film" in opened:
        opened["film"] = opened["film"].drop("fulltext")
    return opened, failed


def rental_reports(t: rental.Catalog) -> dict[str, DataFrame]:
    """All ranked and grouped reports on the rental tables."""
    return {
        "films_per_category": rental.films_per_category(t),
        "actors_by_rentals": rental.actors_by_rentals(t),
        "actors_by_films": rental.actors_by_films(t),
        "revenue_by_category": rental.revenue_by_category(t, 3),
        "films_without_inventory": rental.films_without_inventory(t),
        "top_actors_threshold": rental.top_actors_threshold(t),
        "top_actors_dense_rank": rental.top_actors_dense_rank(t),
        "customers_per_city": rental.customers_per_city(t),
        "top_category_per_city_group": rental.top_category_per_city_group(t),
    }
