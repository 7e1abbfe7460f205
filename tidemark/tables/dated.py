"""Tables laid out by a date, of which a batch rewrites the dates it touches."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DatedTable:
    """One folder of parquet files per date; rows without a date have a folder too.

    ``write`` replaces the folders of the dates in the rows it is given and leaves
    all others, and their files, as they are. It wants one writer at a time.
    Rows carry ``last_batch``, the batch that touched them last, so a batch that
    comes again finds what it has done already.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, date: str, further: str = ""):
        self.spark, self.path, self.date = spark, path.rstrip("/"), date
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        more = T.StructType.fromDDL(f"{further}, last_batch string" if further else "last_batch string")
        self.stored = T.StructType([*self.schema.fields, *more.fields])

    def frame(self) -> DataFrame:
        """All stored columns, also those that readers don't see."""
        try:
            return self.spark.read.schema(self.stored).parquet(self.path).select(*self.stored.names)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.stored)

    def current(self) -> DataFrame:
        return self.frame().select(*self.schema.names)

    def at_dates_of(self, rows: DataFrame) -> DataFrame:
        """The stored rows of the dates in ``rows``; folders of other dates are not read."""
        known, dates = self.frame(), rows.select(self.date).distinct()
        dated = known.join(dates.filter(F.col(self.date).isNotNull()), self.date, "left_semi")
        undated = known.filter(F.col(self.date).isNull()).join(dates.filter(F.col(self.date).isNull()).select(), how="left_semi")
        return dated.unionByName(undated)

    def write(self, rows: DataFrame) -> None:
        """Replace the dates in ``rows``, which may read this table."""
        (rows.select(*self.stored.names).repartition(self.date).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(self.date).parquet(self.path))
