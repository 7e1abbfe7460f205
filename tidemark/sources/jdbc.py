"""Tables read over JDBC in parallel slices."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Database:
    """How to reach a database."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)

    def reader(self, spark: SparkSession):
        return spark.read.format("jdbc").option("url", self.url).options(**self.properties)


@dataclass(frozen=True)
class Slices:
    """A numeric or date column to cut a scan by; bounds are looked up if not given."""

    column: str
    count: int = 16
    lower: object = None
    upper: object = None


def check_connection(spark: SparkSession, db: Database, probe: str = "select 1 as one") -> None:
    """Run a one-row query; an unreachable database raises here, before any table is opened."""
    db.reader(spark).option("query", probe).load().limit(1).collect()


def read_table(
    spark: SparkSession, db: Database, table: str, slices: Slices | None = None, fetch_size: int = 10_000
) -> DataFrame:
    """A table scan; with ``slices`` every slice is a query and a task of its own.

    Filters and column choices made on the result are pushed into those queries.
    """
    reader = db.reader(spark).option("dbtable", table).option("fetchsize", fetch_size)
    if slices is None:
        return reader.load()
    lower, upper = slices.lower, slices.upper
    if lower is None or upper is None:
        ask = f"select min({slices.column}) as lo, max({slices.column}) as hi from {table}"
        row = db.reader(spark).option("query", ask).load().first()
        lower, upper = (row["lo"], row["hi"]) if row else (None, None)
    if lower is None or upper is None:
        return reader.load()
    return (
        reader.option("partitionColumn", slices.column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", slices.count)
        .load()
    )


def load_tables(
    spark: SparkSession, db: Database, tables: dict[str, Slices | None], probe: str = "select 1 as one"
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The named tables, and the error text of each one that failed; a failing table stops no other."""
    check_connection(spark, db, probe)
    opened: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    for name, slices in tables.items():
        try:
            opened[name] = read_table(spark, db, name, slices)
        except Exception as error:  # the other tables are still wanted
            log.warning("table %s could not be opened: %s", name, error)
            failed[name] = str(error)
    return opened, failed
