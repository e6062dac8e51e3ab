"""Arrays to rows, with the array computed once per row.

For a plain explode Spark adds a test that the array is not empty and pushes it, with the whole expression that builds the
array, down to the scan. An outer explode with the test after it gives the same rows and builds the array once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_rows(df: DataFrame, array: str, keep: list[str], value: str, position: str | None = None) -> DataFrame:
    """One row per element of ``array`` with the ``keep`` columns; empty and null arrays give none."""
    pos = position or "__pos"
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, value)).filter(F.col(pos).isNotNull())
    return rows if position else rows.drop(pos)
