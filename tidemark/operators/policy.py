"""Row access rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_row_policy(df: DataFrame, mapping: DataFrame, column: str, role: str | None = None) -> DataFrame:
    """The rows a role may see.

    ``mapping`` holds ``role_name, allowed_country``. A role mapped to ``ALL``
    sees every row, another one the rows whose ``column`` is listed for it; an
    unmapped role and a NULL value see nothing. The role is looked up first,
    which is one small job: the answer is ``df`` as it is or a semi-join with the
    role's own list, which can prune the scan.
    """
    who = F.lit(role) if role is not None else F.current_user()
    mine = mapping.filter(F.col("role_name") == who)
    if mine.filter(F.col("allowed_country") == "ALL").limit(1).count():
        return df
    listed = mine.select(F.col("allowed_country").alias("_allowed")).distinct()
    return df.join(listed, F.col(column) == F.col("_allowed"), "left_semi")
