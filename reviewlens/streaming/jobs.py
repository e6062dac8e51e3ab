"""Incremental ingest, rating trend and upsert. Each job takes what has landed since its last run and stops."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewlens.functions.numeric import round_half_up
from reviewlens.operators import conform
from reviewlens.operators.dedup import keep_top, latest_version
from reviewlens.streaming.changes import ChangeTable

LANDING_SCHEMA = "source_actor string, product_key string, scraped_at string, item_json string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Keyed state goes to RocksDB unless the session already names a provider, so it is not bound by executor memory."""
    try:
        named = spark.conf.get(_PROVIDER)
    except Exception:
        named = None
    if named is None or named.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKSDB)


_CHECK = "spark.sql.streaming.unsupportedOperationCheck"


@contextmanager
def _ranking_allowed(spark: SparkSession) -> Iterator[None]:
    """Streams started in here may rank the rows of a micro-batch. Spark refuses every window function in a stream, as a rank
    over its whole past would need all of it; ``first_copies`` leaves the past to the state."""
    before = spark.conf.get(_CHECK)
    spark.conf.set(_CHECK, "false")
    try:
        yield
    finally:
        spark.conf.set(_CHECK, before)


def first_copies(rows: DataFrame) -> DataFrame:
    """From a stream of unified reviews the first copy of every id, over everything that has ever come.

    Within a micro-batch the earliest copy wins: by time of scraping (unknown last), then product, then a hash of the row. An id
    that an earlier batch has brought is dropped: that it has been seen is keyed state in Spark's state store, so a micro-batch
    touches the ids it holds and no others. Each task thins its copies before the shuffle, so an id on many rows goes through
    it as a few; ranking and state share that one shuffle. To be started under ``_ranking_allowed``.
    """
    timed = rows.withColumn("scraped_ts", F.try_to_timestamp("scraped_at"))
    order = [F.col("scraped_ts").asc_nulls_last(), F.coalesce("product_id", F.lit("")), F.xxhash64(*timed.columns).cast("string")]
    return keep_top(timed, ["review_id"], order).dropDuplicates(["review_id"])


def run_ingest(spark: SparkSession, landing: str, dimension: DataFrame, out: str, checkpoint: str, rejects: str | None = None) -> StreamingQuery:
    """Landed JSON lines -> unified reviews; the first copy of an id wins over everything that has ever been ingested.

    Ids that have been seen are state (see ``first_copies``), so nothing is too late: a back-fill of old snapshots arrives like
    any other, and its cost follows its own size. Items that cannot be used go to ``rejects`` with their reason, by a query
    and a checkpoint of their own. Each batch owns a folder in both tables; a replayed batch replaces its own rows only.
    """
    rejects = rejects or f"{out}_rejects"
    keep_state_on_disk(spark)
    raw = spark.readStream.schema(LANDING_SCHEMA).option("recursiveFileLookup", "true").json(landing)
    checked = conform.with_reject_reason(raw)
    refused = checked.filter(F.col("reject_reason").isNotNull()).select(*raw.columns, "reject_reason")
    fresh = first_copies(conform.unify(conform.accepted(checked).drop("item_json"), dimension))
    query = None
    for rows, target, at in ((refused, rejects, f"{checkpoint}_rejects"), (fresh, out, checkpoint)):
        with _ranking_allowed(spark):
            query = rows.writeStream.foreachBatch(_append_batches(target)).option("checkpointLocation", at).trigger(availableNow=True).start()
        query.awaitTermination()
    return query


def compact(spark: SparkSession, out: str, keys: list[str], order: list[Column], target: str) -> int:
    """Write the latest row per key of a change table to ``target``, as its first batch; returns the number of rows.

    For moving a table elsewhere; the jobs fold their own tables. Point the stream's writer at ``target`` afterwards.
    """
    latest_version(spark.read.parquet(out), keys, order).drop("batch_id").write.mode("overwrite").parquet(f"{target}/batch_id=-1")
    return spark.read.parquet(f"{target}/batch_id=-1").count()


def _append_batches(out: str):
    """A foreachBatch writer: each batch owns one folder, so a replayed batch replaces its own rows only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch_id={batch_id}")

    return write


def _append_changes(out: str, keys: list[str], order: list[str], options: dict):
    """A foreachBatch writer into a table of changes, which folds itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        ChangeTable(batch.sparkSession, out, keys, order, **options).append(batch, batch_id)

    return write


def rating_trend(
    events: DataFrame, ts: str, key: str, value: Column, window: str = "7 days", slide: str = "1 day", digits: int = 2
) -> DataFrame:
    """Volume and value total per sliding window and key; works on a stream (after a watermark) and on a table alike."""
    scaled = F.floor(value * float(10**digits) + 0.5).cast("bigint")
    return events.groupBy(F.window(ts, window, slide), F.col(key)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(scaled).alias("scaled_total")
    )


def trend_rows(agg: DataFrame, key: str, digits: int = 2) -> DataFrame:
    mean = F.col("scaled_total").cast("double") / (F.col("n").cast("double") * float(10**digits))
    return agg.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "n",
        round_half_up(mean, 2).alias("avg_value"),
    )


def run_trend(
    events: DataFrame, ts: str, key: str, value: Column, out: str, checkpoint: str, lateness: str = "2 days", table: dict | None = None, **windows
) -> None:
    """Write the windows that changed in each batch; ``current_trend`` gives the last state of each. ``table``: options of the
    table of changes, which the job folds as it grows."""
    keep_state_on_disk(events.sparkSession)
    agg = rating_trend(events.withWatermark(ts, lateness), ts, key, value, **windows)
    (
        agg.writeStream.foreachBatch(_append_changes(out, ["window", key], [], table or {}))
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def current_trend(spark: SparkSession, out: str, key: str) -> DataFrame:
    return trend_rows(ChangeTable(spark, out, ["window", key]).current(), key)


def run_upserts(rows: DataFrame, key: str, version: str, out: str, checkpoint: str, table: dict | None = None) -> None:
    """Append the newest version of each key in a batch to a table of changes, which the job folds as it grows."""
    (
        rows.writeStream.foreachBatch(_append_changes(out, [key], [version], table or {}))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def current_rows(spark: SparkSession, out: str, key: str, version: str) -> DataFrame:
    """Latest version of every key over all batches; of equal versions the later batch's."""
    return ChangeTable(spark, out, [key], [version]).current().drop("batch_id")
