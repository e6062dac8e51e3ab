"""Joins of a large table with a lookup that is expected to be small, but is measured first.

Topics, groups and products are few keys over very many rows. A shuffle join on such a key would send a third of all rows
to one task when one topic holds a third of them, so the lookup is broadcast after its size has been checked. A lookup
beyond the bound takes the ordinary shuffle join, where adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.session import ensure_checkpoint_dir

MAX_ROWS = 100_000
MAX_BYTES = 64 * 1024 * 1024
KNOWN_BYTES = 8 * 1024 * 1024


def _known_bytes(df: DataFrame) -> int | None:
    """Spark's own estimate of the size, where the classic API offers it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except (AttributeError, ValueError):
        return None


def small(lookup: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The lookup, marked for broadcast when it has at most ``max_rows`` rows and, written as text, ``MAX_BYTES`` bytes.

    Where Spark already knows it to be small (a literal table, a small file) nothing is run. Otherwise it is computed once,
    written to the checkpoint folder, and counted there.
    """
    known = _known_bytes(lookup)
    if known is not None and known <= KNOWN_BYTES:
        return F.broadcast(lookup)
    ensure_checkpoint_dir(lookup.sparkSession)
    written = lookup.checkpoint()
    width = F.sum(F.octet_length(F.to_json(F.struct(F.lit(0).alias("_"), *written.columns))))
    size = written.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(width, F.lit(0)).alias("bytes")).first()
    return F.broadcast(written) if size.rows <= max_rows and size.bytes <= MAX_BYTES else written


def join_small(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", max_rows: int = MAX_ROWS) -> DataFrame:
    return df.join(small(lookup, max_rows), on, how)
