"""CSV, run log and table outputs."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.operators.lookup import join_small
from reviewlens.session import ensure_checkpoint_dir

CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}

RUN_LOG_SCHEMA = """
run_start string, actor_key string, product_key string, actor_id string, apify_run_id string, dataset_id string,
item_count bigint, duration_secs double, raw_path string,
input_used struct<query: string, limit: bigint, maxReviews: bigint>
"""


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Header CSV with quoted multi-line cells; only an empty cell is null."""
    return spark.read.options(**CSV).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header="true", quote='"', escape='"', escapeQuotes="true").csv(path)


# -- union of CSV files with different headers ------------------------------------

UNION = {**CSV, "recursiveFileLookup": "true", "pathGlobFilter": "*.csv", "ignoreCorruptFiles": "true"}


def _own_out(rows: DataFrame, skip: str | None) -> DataFrame:
    return rows.filter(~F.contains("file_path", F.lit(skip))) if skip else rows


def csv_headers(spark: SparkSession, base: str, skip: str | None = None) -> DataFrame:
    """(file_path, header) of every CSV file under ``base`` except the job's own output: its first record as CSV text.

    The CSV reader finds the record, so line breaks inside quotes belong to it. Blank lines before it are passed over; files
    without a record, or with a first record of spaces only, are not in the table.
    """
    # A record of one cell is that cell; of any other the reader keeps the text, as it does not fit the schema of one cell.
    one = spark.read.options(**{**UNION, "header": "false", "columnNameOfCorruptRecord": "record"}).schema("cell string, record string").csv(base)
    alone = F.concat(F.lit('"'), F.replace(F.coalesce("cell", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    # A file is read by one task, in order.
    records = one.select(
        F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("at"),
        F.regexp_replace(F.coalesce("record", alone), "^﻿", "").alias("header"),
    )
    first = _own_out(records, skip).groupBy("file_path").agg(F.min_by("header", "at").alias("header"))
    return first.filter(F.trim(F.translate("header", '"', "")) != "")


def header_names(header: str) -> list[str] | None:
    """Column names of a header record, quotes and commas inside quotes respected; a repeated name gets a number.

    None where the record is no CSV, such as one whose quote never ends and that runs beyond the reader's limit for a cell.
    """
    try:
        cells = next(csv.reader([header]))
    except csv.Error:
        return None
    names: list[str] = []
    taken: set[str] = set()
    for raw in cells:
        name, n = raw.strip(), 2
        while name in taken:
            name, n = f"{raw.strip()}_{n}", n + 1
        names.append(name)
        taken.add(name)
    return names


def csv_layouts(headers: DataFrame) -> DataFrame:
    """(layout, header, names, first_path): the different headers, each with a number and its first file."""
    named = F.udf(lambda header: header_names(header), "array<string>")
    ensure_checkpoint_dir(headers.sparkSession)
    found = headers.groupBy("header").agg(F.min("file_path").alias("first_path")).withColumn("names", named("header"))
    return found.filter(F.col("names").isNotNull()).withColumn("layout", F.monotonically_increasing_id()).checkpoint()


def union_csv(spark: SparkSession, base: str, skip: str | None = None) -> DataFrame:
    """All CSV files stacked by column name, columns in first-seen order over sorted paths, missing cells ``""``.

    One scan reads all files by position, whatever their headers. Each row finds its file's layout, and the layout says at
    which position each column stands; both are lookups, broadcast while they are small. The driver sees the names of the
    result's columns and nothing for each file or layout. Cells beyond a file's header are left out, as are files without a
    header (``csv_without_header`` lists them) and what follows the damage in a damaged one. Names that differ in case only
    are different columns. A file's lines end as its first one does.
    """
    ensure_checkpoint_dir(spark)
    headers = csv_headers(spark, base, skip).checkpoint()
    layouts = csv_layouts(headers)
    seen = layouts.select("first_path", F.posexplode("names").alias("at", "name")).groupBy("name").agg(F.min(F.struct("first_path", "at")).alias("seen"))
    columns = [r.name for r in seen.orderBy("seen").collect()]
    if not columns:
        raise FileNotFoundError(f"no CSV files under {base}")
    width = layouts.agg(F.max(F.size("names"))).first()[0]
    place = F.transform(F.array(*[F.lit(c) for c in columns]), lambda c: F.nullif(F.array_position("names", c), F.lit(0)) - 1)
    places = layouts.select("layout", place.cast("array<int>").alias("places"))
    of_file = headers.join(layouts.select("header", "layout"), "header").select("file_path", "layout")
    cells = spark.read.options(**UNION, maxColumns=str(max(width, 20480))).schema(", ".join(f"c{k} string" for k in range(width))).csv(base)
    rows = _own_out(cells.select(F.col("_metadata.file_path").alias("file_path"), F.array(*[f"c{k}" for k in range(width)]).alias("cells")), skip)
    placed = join_small(join_small(rows, of_file, ["file_path"], "inner"), places, ["layout"], "inner")
    cell = lambda k: F.coalesce(F.get("cells", F.get("places", F.lit(k))), F.lit(""))
    return placed.select(*[cell(k).alias(c) for k, c in enumerate(columns)])


def csv_without_header(spark: SparkSession, base: str, skip: str | None = None) -> DataFrame:
    """CSV files under ``base`` that the union leaves out because they hold no header. Spark itself passes over files of no bytes."""
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/").alias("file_path")
    listed = (
        spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.csv").load(base).select(F.col("path").alias("file_path"))
    )
    headers = csv_headers(spark, base, skip)
    good = headers.join(csv_layouts(headers).select("header"), "header", "left_semi").select(plain("file_path"))
    return _own_out(listed, skip).select(plain("file_path")).join(good, "file_path", "left_anti")


# -- run log ------------------------------------------------------------------------


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).json(path)


def append_run_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").json(path)


# -- outputs ------------------------------------------------------------------------


def write_normalized(unified: DataFrame, base: str) -> dict[str, str]:
    """Full rows as Parquet by source and product, and a flat CSV with the bonus data as one JSON cell."""
    paths = {"parquet": f"{base}/parquet", "csv": f"{base}/csv"}
    rows = unified.withColumn("source", F.col("source_actor")).withColumn("product", F.col("product_id"))
    rows.write.mode("overwrite").partitionBy("source", "product").parquet(paths["parquet"])
    # From the written rows, so the conforming work runs once.
    write_csv(unified.sparkSession.read.parquet(paths["parquet"]).select(*unified.columns), paths["csv"])
    return paths


def write_enriched(meta: DataFrame, classified: DataFrame, base: str, parquet: bool = True) -> dict[str, str]:
    """Both final tables as CSV, and as Parquet on request."""
    paths = {}
    for name, df in {"reviews_meta": meta, "reviews_text_classified": classified}.items():
        paths[f"{name}.csv"] = f"{base}/{name}.csv"
        if parquet:
            paths[name] = f"{base}/{name}.parquet"
            df.write.mode("overwrite").parquet(paths[name])
            df = df.sparkSession.read.parquet(paths[name])
        write_csv(df, paths[f"{name}.csv"])
    return paths


def write_versioned(df: DataFrame, path: str, version: str) -> None:
    """One version of a per-field table; writing a version again replaces only that version's partitions."""
    (
        df.withColumn("run_version", F.lit(version))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_version", "text_field")
        .parquet(path)
    )


def write_audit(grouping: DataFrame, path: str, version: str) -> None:
    """Nested audit records: each topic's enrichment, its group before and after review, and the reasons.

    Expects text_field, topic_id, plain_description, group_before, group_after, reasoning. One record per topic, so no
    field is gathered in one place.
    """
    record = F.struct(
        "topic_id",
        F.struct("plain_description").alias("enrichment"),
        F.struct(F.col("group_before").alias("before"), F.col("group_after").alias("after"), "reasoning").alias("grouping"),
    )
    (
        grouping.select("text_field", record.alias("topic"), F.lit(version).alias("run_version"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_version")
        .json(path)
    )
