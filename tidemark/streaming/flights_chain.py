"""The raw → silver → gold chain as two streams over three stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import GOLD_MESSAGE, SILVER_MESSAGE, gold_message, silver_message
from tidemark.operators.merge import absent_from, add_batch
from tidemark.operators.policy import apply_row_policy
from tidemark.plans import flights
from tidemark.streaming.feeds import Ledger, bare_path, consume
from tidemark.tables.dated import DatedTable
from tidemark.tables.versions import COMMIT_SCHEMA, ChangeLog, append_row, utc_now

# The job names of the audit log.
SILVER_JOB = "PROCESS_FLIGHTS_SILVER"
GOLD_JOB = "PROCESS_DAILY_STATS_GOLD"


class FlightsChain:
    """The folders of one chain: landing files, silver log, gold by date, rejects, audit, checkpoints.

    A run takes everything that has arrived as one batch; ``files_per_batch``
    cuts a large backlog into several, each merged and committed on its own.
    Silver is bucketed by its hash, in as many buckets as there are shuffle
    partitions when it is made, or ``buckets``: a merge deals the batch to the
    buckets and leaves silver where it lies.
    """

    def __init__(
        self,
        spark: SparkSession,
        home: str,
        dedupe_source: bool = True,
        clock: Callable[[], dt.datetime] = utc_now,
        generation: str = "first",
        files_per_batch: int | None = None,
        buckets: int | None = None,
    ):
        self.spark, self.home, self.clock = spark, home.rstrip("/"), clock
        self.files_per_batch = files_per_batch
        self.dedupe_source, self.generation = dedupe_source, generation
        self.landing = f"{self.home}/raw"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.silver = ChangeLog(spark, f"{self.home}/silver", flights.SILVER_SCHEMA, "flight_hash", self.buckets)
        self.gold = DatedTable(spark, f"{self.home}/gold", flights.GOLD_SCHEMA, "stat_date", flights.GOLD_SKETCH)

    def restarted(self, generation: str) -> "FlightsChain":
        """The same tables behind new streams, which see every landing file again."""
        return FlightsChain(
            self.spark, self.home, self.dedupe_source, self.clock, generation, self.files_per_batch, self.buckets
        )

    def _checkpoint(self, job: str) -> str:
        return f"{self.home}/checkpoints/{self.generation}/{job}"

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.home}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def audit(self) -> DataFrame:
        return self._read("audit", flights.AUDIT_SCHEMA)

    def rejects(self) -> DataFrame:
        return self._read("rejects", f"{flights.RAW_SCHEMA}, batch string")

    def secure_report(self, mapping: DataFrame, role: str | None = None) -> DataFrame:
        """The columns open to readers, for the rows the role may see."""
        seen = apply_row_policy(self.silver.current(), mapping, "country_name", role)
        return seen.select(*flights.SECURE_COLUMNS)

    def land(self, raw: DataFrame) -> None:
        """Add raw rows to the landing folder."""
        raw.select(*flights.RAW_COLUMNS).write.mode("append").parquet(self.landing)

    def _feeds(self) -> dict[str, tuple[str, str]]:
        """What each stream reads, and its checkpoint."""
        return {
            "raw": (self.landing, self._checkpoint("silver")),
            "silver": (self.silver.commits.path, self._checkpoint("gold")),
        }

    def _ledger(self, checkpoint: str) -> Ledger:
        return Ledger(self.spark, f"{checkpoint}-taken")

    def pending(self) -> dict[str, bool]:
        """Whether each stream has data it has not consumed."""
        return {
            name: not self._ledger(checkpoint).pending(folder, "*.parquet").isEmpty()
            for name, (folder, checkpoint) in self._feeds().items()
        }

    def pending_report(self) -> DataFrame:
        """One row ``raw, silver, raw_rows``: whether each stream has files it has not consumed, and the rows that wait to be landed."""
        waits = {name: self._ledger(checkpoint).pending(folder, "*.parquet") for name, (folder, checkpoint) in self._feeds().items()}
        some = {name: files.agg((F.count(F.lit(1)) > 0).alias(name)) for name, files in waits.items()}
        landed = self._read("raw", flights.RAW_SCHEMA)
        if landed.inputFiles():
            landed = landed.select(bare_path("_metadata.file_path").alias("path")).join(waits["raw"], "path", "left_semi")
        rows = landed.agg(F.count(F.lit(1)))
        return some["raw"].withColumn("silver", some["silver"].scalar()).withColumn("raw_rows", rows.scalar())

    def messages(self) -> DataFrame:
        """What every logged run reported: ``log_id, message``."""
        said = F.when(
            F.col("procedure_name") == SILVER_JOB, F.format_string(SILVER_MESSAGE, "rows_affected")
        ).otherwise(F.format_string(GOLD_MESSAGE, "rows_affected"))
        return self.audit().select("log_id", said.alias("message"))

    def process_silver(self) -> str:
        """Merge new raw rows into silver; rows whose hash is present are left alone."""

        def merge(batch: DataFrame, name: str) -> int:
            rows = flights.silver_batch(batch, self.dedupe_source, self.clock())
            fresh = absent_from(rows, self.silver.current(), "flight_hash")
            added = self.silver.append(fresh, batch=name, at=self.clock())
            flights.rejected(batch).write.mode("overwrite").parquet(f"{self.home}/rejects/batch={name}")
            return added

        return silver_message(self._run(SILVER_JOB, "silver", self.landing, flights.RAW_SCHEMA, merge))

    def process_gold(self) -> str:
        """Add the statistics of newly inserted silver rows to gold; restored rows do not count.

        The stream follows silver's commits, so rows of a write that was lost
        before its commit are never seen. Only the dates of the batch are read
        and written anew; a batch that comes again adds nothing twice.
        """

        def merge(batch: DataFrame, name: str) -> int:
            inserted = self.silver.rows_of(batch.filter(F.col("kind") == "INSERT"))
            stats = flights.daily_stats(inserted, sketch=True).persist()
            try:
                touched = stats.count()
                if touched:
                    self.gold.write(add_batch(self.gold.at_dates_of(stats), stats, name, self.clock()))
            finally:
                stats.unpersist()
            return touched

        return gold_message(self._run(GOLD_JOB, "gold", self.silver.commits.path, COMMIT_SCHEMA, merge))

    def recount_gold(self, dates: list[dt.date]) -> int:
        """Count some dates of gold again from all rows that were ever inserted into silver; returns the rows written.

        For dates whose rewriting was cut off half-way. Distinct pilots are then
        exact instead of the largest number of a batch.
        """
        inserted = self.silver.log(kind="INSERT").filter(F.col("departure_date").isin(dates))
        stats = flights.daily_stats(inserted, sketch=True).withColumns(
            {"updated_at": F.lit(self.clock()), "last_batch": F.lit("recount")})
        self.gold.write(stats)
        return self.gold.frame().filter(F.col("stat_date").isin(dates)).count()

    def run(self) -> list[str]:
        """Both jobs in order over whatever has arrived."""
        return [self.process_silver(), self.process_gold()]

    def _feed(self, folder: str, schema) -> DataFrame | None:
        """The parquet files of a folder as a stream; None as long as there is no folder."""
        reader = self.spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        try:
            return reader.parquet(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _run(self, job: str, stream: str, folder: str, schema, merge: Callable[[DataFrame, str], int]) -> int:
        """One stream run and its audit row, which is also written for a run without data or a failed one."""
        rows = [0]

        def handle(batch: DataFrame, name: str) -> None:
            rows[0] += merge(batch, name)

        try:
            feed = self._feed(folder, schema)
            if feed is not None:
                ledger = self._ledger(self._checkpoint(stream))
                run = ledger.note(folder, "*.parquet")
                consume(feed, handle, self._checkpoint(stream))
                ledger.confirm(run)
        except Exception:
            self._log(job, 0, "FAILED")
            raise
        self._log(job, rows[0], "SUCCESS")
        return rows[0]

    def _log(self, job: str, rows: int, status: str) -> None:
        number = (self.audit().agg(F.max("log_id").alias("n")).first()["n"] or 0) + 1
        append_row(self.spark, f"{self.home}/audit", flights.AUDIT_SCHEMA, number, job, rows, status, self.clock())
