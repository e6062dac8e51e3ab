"""Landed raw snapshots: JSON-array files, one per source, product and run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from reviewlens.session import scratch_path
from reviewlens.sources import json_ranges

# <source>/<product>_<yyyymmdd_hhmmss>.json, or the same three as partition folders.
FILE_NAME = r"([^/=]+)/([^/=]+)_(\d{8}_\d{6})\.json$"
FOLDERS = r"/source_actor=([^/]+)/product_key=([^/]+)/run_ts=([^/]+)/[^/]+$"


def _path_part(path, i: int):
    return F.nullif(
        F.coalesce(F.nullif(F.regexp_extract(path, FOLDERS, i), F.lit("")), F.regexp_extract(path, FILE_NAME, i)), F.lit("")
    )


def with_snapshot(df: DataFrame, path: str = "file_path") -> DataFrame:
    """Source, product and run time of a row, from its file's path."""
    names = {1: "source_actor", 2: "product_key", 3: "run_ts"}
    return df.withColumns({name: _path_part(F.col(path), i) for i, name in names.items()})


def inventory(spark: SparkSession, base: str, actor: str | None = None, product: str | None = None) -> DataFrame:
    """Snapshots on disk, newest first. Only file status is read, not the content."""
    files = with_snapshot(
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select(F.col("path").alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at"))
    ).filter(F.col("run_ts").isNotNull())
    if actor:
        files = files.filter(F.col("source_actor") == actor)
    if product:
        files = files.filter(F.col("product_key") == product)
    return files.orderBy(F.col("modified_at").desc(), F.col("file_path").desc())


def latest_files(files: DataFrame) -> DataFrame:
    """Files of the newest snapshot per source and product."""
    w = Window.partitionBy("source_actor", "product_key").orderBy(F.col("run_ts").desc())
    return files.withColumn("__rank", F.rank().over(w)).filter(F.col("__rank") == 1).drop("__rank")


#: Files beyond this many bytes are read by ranges, each by many tasks.
SPLIT_ABOVE = 64 << 20


def _whole_files(spark: SparkSession, paths: str | list[str], upto: int) -> DataFrame:
    files = (
        spark.read.option("recursiveFileLookup", "true").text(paths, wholetext=True)
        .filter(F.col("_metadata.file_size") <= upto)
        .select(F.col("_metadata.file_path").alias("file_path"), F.ltrim("value", F.lit(" \t\r\n\ufeff")).alias("__text"))
    )
    parsed = files.select(
        "file_path",
        F.substring("__text", 1, 1).alias("__first"),
        F.from_json("__text", "array<variant>").alias("items"),
    )
    reason = F.when(F.col("__first") != "[", "not_array").when(F.col("items").isNull(), "bad_json")
    return parsed.select("file_path", F.when(reason.isNull(), F.col("items")).alias("items"), reason.alias("reject_reason"))


def _files_by_range(spark: SparkSession, paths: str | list[str], above: int) -> DataFrame:
    cut = json_ranges.pieces(spark, paths, above)
    if cut.isEmpty():
        return spark.createDataFrame([], "file_path string, items array<variant>, reject_reason string")
    path = scratch_path(spark, "json-chunks")
    # One plan: pieces are located and numbered where the first shuffle has put them, and only what a range sums up to is computed apart.
    json_ranges.chunks(json_ranges.located(cut)).write.option("compression", "zstd").parquet(path)
    parts = spark.read.parquet(path)
    bad = parts.filter("reason IS NOT NULL").groupBy("file_path").agg(F.max("reason").alias("reject_reason"))
    good = parts.join(bad, "file_path", "left_anti").select("file_path", "items", F.lit(None).cast("string").alias("reject_reason"))
    return good.unionByName(bad.select("file_path", F.lit(None).cast("array<variant>").alias("items"), "reject_reason"))


def read_files(spark: SparkSession, paths: str | list[str], split_above: int = SPLIT_ABOVE) -> DataFrame:
    """(file_path, items, reject_reason): files as arrays of VARIANT.

    A file of up to ``split_above`` bytes is one row; a larger one has a row for every few items and is read by many tasks. A
    file that holds no array, or no valid JSON, has one row without items and with a reason instead.
    """
    return _whole_files(spark, paths, split_above).unionByName(_files_by_range(spark, paths, split_above))


def read_raw(spark: SparkSession, paths: str | list[str], split_above: int = SPLIT_ABOVE) -> tuple[DataFrame, DataFrame]:
    """(items, rejected files). Rejected: unparseable files, files without an array, and files that hold an item that is no
    object (``bad_item``; their other items are kept)."""
    files = read_files(spark, paths, split_above)
    items = files.select("file_path", F.explode_outer("items").alias("item"), "reject_reason")
    is_object = F.startswith(F.schema_of_variant("item"), F.lit("OBJECT"))
    good = items.filter(F.col("item").isNotNull() & is_object).select("file_path", "item")
    odd = items.filter(F.col("reject_reason").isNull() & F.col("item").isNotNull() & ~is_object)
    rejected = files.filter("reject_reason IS NOT NULL").select("file_path", "reject_reason").unionByName(
        odd.select("file_path", F.lit("bad_item").alias("reject_reason")).distinct()
    )
    return with_snapshot(good), rejected


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    """Items of the newest snapshot per source and product; only their files are opened.

    Spark lists all files under ``base`` on the driver for any read of it; the paths collected here are a part of that list.
    """
    paths = [r[0] for r in latest_files(inventory(spark, base)).select("file_path").collect()]
    if not paths:
        raise FileNotFoundError(f"no raw snapshots under {base}")
    return read_raw(spark, paths)[0]


def write_arrays(items: DataFrame, base: str, chunk: str) -> None:
    """Write items (source_actor, product_key, run_ts, item_json) as array files, one file per ``chunk`` value.

    ``chunk`` must keep each array small: it is built in one task.
    """
    arrays = items.groupBy("source_actor", "product_key", "run_ts", chunk).agg(
        F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("item_json")), ",\n"), F.lit("]")).alias("value")
    )
    (
        arrays.drop(chunk)
        .write.partitionBy("source_actor", "product_key", "run_ts")
        .option("maxRecordsPerFile", 1)
        .text(base)
    )
