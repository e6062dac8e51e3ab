"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlens.session import scratch_path

#: White space between words: space and the control characters 9 to 13. Everything else is part of a word.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, computed once and kept as Parquet in the shared folder: later readers do not run the plan again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def word_count(text: Column) -> Column:
    """Number of words in a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(doc_id: Column) -> Column:
    """An id as text for hashing; a null id is the empty text."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def hash_unit(text: Column) -> Column:
    """A number strictly between 0 and 1 from the first 48 bits of the MD5 digest: the same in every engine and run."""
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 48))


def salted_lookup(df: DataFrame, lookup: DataFrame, on: list[str], spread_by: Column, salts: int = 32, how: str = "left") -> DataFrame:
    """Join a wide table with one row per key, keys compared null-safe, when one key may hold a large part of all rows.

    The lookup is repeated ``salts`` times and the rows of a key are dealt over the repeats by ``spread_by``, so no task gets
    more than a fixed share of a key. Adaptive execution still turns this into a broadcast join where the lookup is small.
    """
    right = lookup.select(
        *[F.col(c).alias(f"__r_{c}") for c in on], *[c for c in lookup.columns if c not in on], F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__r_salt")
    )
    left = df.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    cond = F.col("__salt") == F.col("__r_salt")
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(right, cond, how).drop("__salt", "__r_salt", *[f"__r_{c}" for c in on])


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int, heavy_share: int = 1000) -> DataFrame:
    """Left join of rows with their group when a few groups may hold most rows.

    A group of more than ``total / heavy_share`` rows is heavy. There are fewer than ``heavy_share`` of those, whatever the
    data, so they are broadcast; the others are joined by a shuffle in which no key has more rows than that.
    """
    bound = total // heavy_share
    heavy = F.broadcast(groups.filter(F.col(size) > bound).limit(heavy_share))
    some = rows.join(heavy, on, "inner")
    others = rows.join(heavy.select(*on), on, "left_anti").join(groups.filter(F.col(size) <= bound), on, "left")
    return some.unionByName(others)


#: Rows and bytes of text that Spark puts into one Arrow batch, at most.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Let Spark cut its Arrow batches small: a batch is held several times over on its way to Python and back."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(name)
        size = int(now) if now.lstrip("-").isdigit() else most + 1
        if not 0 < size <= most:
            spark.conf.set(name, str(most))
    return spark


def hand_back() -> None:
    """Give the memory that a task has freed back to the system. Python workers live on from stage to stage, and what each
    stage has freed would otherwise stay with them, beside what the next one needs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType, max_bytes: int = 8 << 20) -> DataFrame:
    """Apply a function to Arrow batches, cut so that the texts of one call stay near ``max_bytes`` (one row at least)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                start = 0
                while start < batch.num_rows:
                    rows = batch.num_rows - start
                    while rows > 1 and batch.slice(start, rows).nbytes > max_bytes:
                        rows = (rows + 1) // 2
                    yield fn(batch.slice(start, rows))
                    start += rows
            batch = None
        finally:
            hand_back()

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def rows_of(text: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null becomes empty."""
    return [b"" if t is None else t for t in text.cast(pa.binary()).to_pylist()]
