"""Sort keys with the NULL position written out.

Ascending puts NULL last and descending puts NULL first, which is the order
the ranking reports are defined with; Spark's own default is the reverse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def up(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.asc_nulls_last()


def down(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.desc_nulls_first()
