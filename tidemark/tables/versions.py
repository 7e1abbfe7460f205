"""Tables whose past can be read, kept as plain parquet folders.

A ``ChangeLog`` only ever appends: every commit writes one folder
``data/write=<name>`` of rows with an ``_action`` and then one row to
``commits`` that names the folder. A folder without a commit row does not
exist for readers. Writes of a batch are named by the batch, so a retried one
replaces its own folder; all others get a name of their own, so writers that
meet never share a folder, and rows of both are kept.

A ``Snapshots`` table keeps one whole small table per version. It replaces
what it read, so it wants one writer at a time.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Deleted keys, as counted by the commits, and commits themselves, up to which they are broadcast to a scan.
BROADCAST_KEYS = 500_000

COMMIT_SCHEMA = "version long, committed_at timestamp, kind string, rows long, batch string, write string"


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def append_row(spark: SparkSession, path: str, schema: str, *values) -> None:
    """Append one row to a small parquet table."""
    fields = T.StructType.fromDDL(schema).fields
    row = spark.range(1, numPartitions=1).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, values, strict=True)]
    )
    row.write.mode("append").parquet(path)


def _write_name(batch: str | None) -> str:
    """A folder name that is no number, so that it is never read as one."""
    return f"w-{uuid.uuid4().hex}" if batch is None else f"batch-{batch}"


class Commits:
    """The commit rows of one table: few and small, read by the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/commits"

    def frame(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMIT_SCHEMA)

    def add(
        self, version: int, kind: str, rows: int, batch: str | None, at: dt.datetime | None, write: str | None = None
    ) -> None:
        append_row(self.spark, self.path, COMMIT_SCHEMA, version, at or utc_now(), kind, rows, batch, write)

    def state(self, as_of: dt.datetime | None = None, batch: str | None = None, after: int = 0) -> "State":
        """What the commits up to a moment add up to, from one small aggregate; deletions count after a version."""
        rows = self.frame()
        if as_of is not None:
            rows = rows.filter(F.col("committed_at") <= F.lit(as_of))

        def newest(kind: str) -> Column:
            return F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("version"))), F.lit(0))

        order = F.struct("version", "committed_at", "write")
        late_delete = (F.col("kind") == "DELETE") & (F.col("version") > after)
        found = rows.agg(
            F.coalesce(F.max("version"), F.lit(0)).alias("last"),
            (newest("DROP") > newest("UNDROP")).alias("dropped"),
            F.max(F.when(F.col("kind") == "WRITE", order))["write"].alias("last_write"),
            F.max(F.when(F.col("batch") == F.lit(batch), F.col("rows"))).alias("batch_rows"),
            F.coalesce(F.sum(F.when(late_delete, F.col("rows"))), F.lit(0)).alias("deleted"),
        ).first()
        return State(**found.asDict())


@dataclass(frozen=True)
class State:
    """The newest version, the folder written whole last, the rows a batch committed (None: not seen), rows deleted."""

    last: int
    dropped: bool
    last_write: str | None
    batch_rows: int | None
    deleted: int


class _Versioned:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.commits = Commits(spark, self.path)

    def _folder(self, write: str) -> str:
        return f"{self.path}/data/write={write}"

    def _live(self, as_of: dt.datetime | None = None) -> State:
        """The state now, or at a past moment; a dropped table has none now."""
        state = self.commits.state(as_of)
        if state.dropped and as_of is None:
            raise LookupError(f"table {self.path} is dropped")
        return state

    def drop(self, at: dt.datetime | None = None) -> None:
        """Hide the table; its versions stay."""
        self.commits.add(self._live().last + 1, "DROP", 0, None, at)

    def undrop(self, at: dt.datetime | None = None) -> None:
        self.commits.add(self.commits.state().last + 1, "UNDROP", 0, None, at)


class ChangeLog(_Versioned):
    """An append-only table of rows with an ``_action``: INSERT, DELETE or RESTORE.

    INSERT and RESTORE rows are present until a later DELETE of their key,
    which is never NULL and names one row, or rows that go together.
    Readers that follow the table take INSERT rows only, so rows put back
    from the past are not counted again downstream.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, key: str, buckets: int | None = None):
        super().__init__(spark, path, schema)
        self.key, self.buckets = key, buckets

    def _table(self) -> str:
        """The catalog's table over the folders, bucketed and sorted by key; it adds no data of its own.

        The number of buckets is kept beside the data, as the first writer chose it.
        """
        name = f"tidemark_{hashlib.md5(self.path.encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            layout = f"{self.path}/layout"
            try:
                number = self.spark.read.schema("buckets int").parquet(layout).agg(F.min("buckets")).first()[0]
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                append_row(self.spark, layout, "buckets int", self.buckets)
                number = self.buckets
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.log_schema)
            self.spark.sql(f"""
                CREATE TABLE IF NOT EXISTS {name} ({columns}, `write` string) USING parquet PARTITIONED BY (`write`)
                CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {number} BUCKETS LOCATION '{self.path}/data'""")
            if not self.commits.frame().filter(F.col("write").isNotNull()).isEmpty():  # by another application
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            self.buckets = number
        return name

    def _store(self, rows: DataFrame, batch: str | None) -> str:
        """Write a folder and return its name; in buckets, where one can't be replaced, every attempt has its own."""
        if not self.buckets:
            write = _write_name(batch)
            rows.write.mode("overwrite").parquet(self._folder(write))
            return write
        table, write = self._table(), _write_name(None)
        rows.repartition(self.buckets, self.key).withColumn("write", F.lit(write)).write.insertInto(table)
        return write

    def _data(self) -> DataFrame:
        """All written rows, committed or not, with the name of their ``write``."""
        if self.buckets:
            return self.spark.table(self._table())
        return self.spark.read.schema(T.StructType([*self.log_schema.fields, T.StructField("write", T.StringType())])).parquet(f"{self.path}/data")

    @property
    def log_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("_action", T.StringType())])

    def append(
        self, df: DataFrame, action: str = "INSERT", batch: str | None = None, at: dt.datetime | None = None
    ) -> int:
        """Commit ``df`` as the next version and return its row count.

        A batch seen before adds nothing and returns what it added then.
        """
        state = self.commits.state(batch=batch)
        if state.batch_rows is not None:
            return state.batch_rows
        write = self._store(df.select(*self.schema.names).withColumn("_action", F.lit(action)), batch)
        n = self._data().filter(F.col("write") == write).count()
        self.commits.add(state.last + 1, action, n, batch, at, write)
        return n

    def log(self, upto: int | None = None, kind: str | None = None, after: int = 0) -> DataFrame:
        """All committed changes, with their ``version``; or those of one kind, or after a version.

        Commits name the folders, so the scan reads no folder but theirs.
        """
        commits = self.commits.frame().filter(F.col("write").isNotNull() & (F.col("version") > after))
        if upto is not None:
            commits = commits.filter(F.col("version") <= upto)
        if kind is not None:
            commits = commits.filter(F.col("kind") == kind)
        return self.rows_of(commits)

    def rows_of(self, commits: DataFrame) -> DataFrame:
        """The changes that some commit rows stand for, with their ``version``."""
        try:
            data = self._data()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            empty = self.spark.createDataFrame([], self.log_schema)
            return empty.withColumn("version", F.lit(0).cast("long"))
        named = commits.select(F.col("version").alias("_at"), F.col("write").alias("_write"))
        if self.buckets and self.commits.state().last <= BROADCAST_KEYS:  # a row per commit; rows stay in their buckets
            named = F.broadcast(named)
        met = data.join(named, F.col("write") == F.col("_write"))
        return met.select(*self.log_schema.names, F.col("_at").alias("version"))

    def _gone(self, upto: int, after: int, rows: int) -> DataFrame:
        """The keys of deletions, each with its last one; broadcast if the commits say they are few."""
        gone = (
            self.log(upto, "DELETE", after).groupBy(F.col(self.key).alias("_gone"))
            .agg(F.max("version").alias("_gone_at"))
        )
        return F.broadcast(gone) if rows <= BROADCAST_KEYS else gone

    def current(self, as_of: dt.datetime | None = None) -> DataFrame:
        """The rows present now, or at a past moment.

        As long as nothing was deleted this is a plain scan. Otherwise rows
        are matched with the last deletion of their key; deletions are read
        from their own folders.
        """
        return self._present(self._live(as_of))

    def _present(self, state: State) -> DataFrame:
        """A deletion has read all versions before its own, and leaves alone what came beside or after it."""
        present = self.log(state.last)
        if state.deleted:
            gone = self._gone(state.last, 0, state.deleted)
            present = (
                present.filter(F.col("_action") != "DELETE")
                .join(gone, F.col(self.key) == F.col("_gone"), "left")
                .filter(F.col("_gone_at").isNull() | (F.col("_gone_at") <= F.col("version")))
            )
        return present.select(*self.schema.names)

    def delete_where(self, predicate: Column, at: dt.datetime | None = None) -> int:
        return self.append(self.current().filter(predicate), "DELETE", at=at)

    def restore(self, as_of: dt.datetime, predicate: Column, at: dt.datetime | None = None) -> int:
        """Put matching rows of a past moment back if they are missing now.

        Only keys deleted since then can be missing, so both tables are cut
        down to those before they are compared.
        """
        then, now = self.commits.state(as_of), self._live()
        since = self.commits.state(after=then.last).deleted
        if not since:
            return 0
        gone = self._gone(now.last, then.last, since)
        touched = F.col(self.key) == F.col("_gone")
        old = self._present(then).filter(predicate).join(gone, touched, "left_semi")
        still = self._present(now).select(self.key).join(gone, touched, "left_semi")
        return self.append(old.join(still, self.key, "left_anti").select(*self.schema.names), "RESTORE", at=at)

    def clone(self, path: str, at: dt.datetime | None = None) -> "ChangeLog":
        """An independent copy of the present rows."""
        copy = ChangeLog(self.spark, path, self.schema, self.key)
        copy.append(self.current(), at=at)
        return copy


class Snapshots(_Versioned):
    """A small table rewritten whole with every version."""

    def current(self, as_of: dt.datetime | None = None) -> DataFrame:
        write = self._live(as_of).last_write
        if write is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(write))

    def write(
        self, df: DataFrame, changed: int | None = None, batch: str | None = None, at: dt.datetime | None = None
    ) -> None:
        """Commit ``df`` as the next version. The folder read by ``df`` is never the one written."""
        state = self.commits.state(batch=batch)
        if state.batch_rows is not None:
            return
        write = _write_name(batch)
        df.select(*self.schema.names).write.mode("overwrite").parquet(self._folder(write))
        self.commits.add(state.last + 1, "WRITE", changed or 0, batch, at, write)
