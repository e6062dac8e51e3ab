"""Large JSON arrays, read by many tasks.

A file is cut at every ``}``: Spark's text source splits a file into byte ranges by such a separator, too. A piece says how it
changes the state of a reader (inside a string or not, depth of nesting) for either state that it may start in. These changes
are added up within a range, then over the ranges of a file, of which there are few, so each piece learns the state that it
starts in. An item of the array ends where a ``}`` closes at depth 1; the pieces up to there make one text, which holds that
item and whatever scalars or arrays stand before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

BLANKS = " \t\r\n"
FILE, RANGE = "file_path", "range_start"


def pieces(spark: SparkSession, paths: str | list[str], above: int) -> DataFrame:
    """(file_path, range_start, at, piece) of the files of more than ``above`` bytes; ``at`` rises along a range."""
    read = spark.read.option("recursiveFileLookup", "true").option("lineSep", "}").text(paths)
    meta = F.col("_metadata")
    return read.filter(meta["file_size"] > above).select(
        meta["file_path"].alias(FILE), meta["file_block_start"].alias(RANGE), F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece")
    )


def _depth(parts: Column, outside: int) -> Column:
    """Change of depth by the parts of a text cut at its quotes that are outside of strings: those with an even index, or the odd ones."""
    text = F.array_join(F.filter(parts, lambda _, i: i % 2 == outside), "")
    return F.length(F.translate(text, "]}", "")) - F.length(F.translate(text, "[{", ""))


def located(cut: DataFrame) -> DataFrame:
    """Pieces with what is known of their borders: ``last`` (of the file), ``quoted`` and ``depth`` after the piece's own ``}``,
    ``item`` (number of item ends before it) and ``is_end``."""
    bare = F.split(F.regexp_replace("piece", r"(?s)\\.", ""), '"', -1)
    changes = (
        cut.withColumn("parts", bare)
        .withColumns({"quotes": F.size("parts") - 1, "d0": _depth(F.col("parts"), 0), "d1": _depth(F.col("parts"), 1)})
        .drop("parts")
    )
    in_range = Window.partitionBy(FILE, RANGE).orderBy("at")
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turned = changes.withColumn("after", F.sum("quotes").over(so_far) % 2).withColumn("before", (F.col("after") + F.col("quotes")) % 2)
    # Depth along the range if it starts outside of a string (s0), or inside of one (s1). The piece's own brace counts where it is outside.
    own = lambda s: F.when(F.col("before") == s, F.col("d0")).otherwise(F.col("d1")) - F.when(F.col("after") == s, 1).otherwise(0)
    summed = turned.withColumns({"s0": F.sum(own(0)).over(so_far), "s1": F.sum(own(1)).over(so_far), "__ends": F.lead("at").over(in_range).isNull()}).drop("d0", "d1", "quotes", "before")

    ranges = turned.groupBy(FILE, RANGE).agg(
        (F.sum("quotes") % 2).alias("turns"), F.sum(own(0)).alias("t0"), F.sum(own(1)).alias("t1")
    )
    along = Window.partitionBy(FILE).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("start_quoted", F.coalesce(F.sum("turns").over(along), F.lit(0)) % 2)
    starts = starts.withColumn("start_depth", F.coalesce(F.sum(F.when(F.col("start_quoted") == 0, F.col("t0")).otherwise(F.col("t1"))).over(along), F.lit(0)))
    final = F.max(RANGE).over(Window.partitionBy(FILE)) == F.col(RANGE)
    starts = starts.select(FILE, RANGE, "start_quoted", "start_depth", final.alias("__final"))

    placed = summed.join(starts, [FILE, RANGE]).select(
        FILE, RANGE, "at", "piece",
        (F.col("__ends") & F.col("__final")).alias("last"),
        ((F.col("after") + F.col("start_quoted")) % 2 == 1).alias("quoted"),
        (F.col("start_depth") + F.when(F.col("start_quoted") == 0, F.col("s0")).otherwise(F.col("s1"))).alias("depth"),
    )
    return placed.withColumn("is_end", ~F.col("quoted") & (F.col("depth") == 1) & ~F.col("last"))


def _numbered(placed: DataFrame) -> DataFrame:
    """Add ``item``: how many items of the file have ended before the piece; again within ranges, then over them."""
    ends = F.col("is_end").cast("long")
    before = Window.partitionBy(FILE, RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    per = placed.groupBy(FILE, RANGE).agg(F.sum(ends).alias("n"))
    along = Window.partitionBy(FILE).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    start = per.select(FILE, RANGE, F.coalesce(F.sum("n").over(along), F.lit(0)).alias("__start"))
    inside = placed.withColumn("__inside", F.coalesce(F.sum(ends).over(before), F.lit(0)))
    return inside.join(start, [FILE, RANGE]).withColumn("item", F.col("__start") + F.col("__inside")).drop("__start", "__inside")


def chunks(placed: DataFrame) -> DataFrame:
    """(file_path, item, items, reason): the pieces up to an item's end as one array of VARIANT, or the reason why not."""
    # The file's last piece has no brace after it; its own was counted when the depth was, and is taken back here.
    text = F.concat("piece", F.when(F.col("last"), F.lit("")).otherwise(F.lit("}")))
    final_depth = F.when(F.col("last"), F.col("depth") + F.when(F.col("quoted"), 0).otherwise(1))
    whole = _numbered(placed).groupBy(FILE, "item").agg(
        F.sort_array(F.collect_list(F.struct(RANGE, "at", text.alias("t")))).alias("p"),
        F.max("last").alias("last"), F.max(F.when(F.col("last"), F.col("quoted"))).alias("open"), F.max(final_depth).alias("end_depth"),
        F.min(F.when(F.col("quoted") | F.col("last"), F.lit(1)).otherwise(F.col("depth"))).alias("least"),
    )
    joined = whole.withColumn("t", F.array_join(F.transform("p", lambda e: e["t"]), "")).drop("p")
    joined = joined.withColumn("t", F.when(F.col("item") == 0, F.ltrim("t", F.lit(BLANKS + "﻿"))).otherwise(F.ltrim("t", F.lit(BLANKS))))
    joined = joined.withColumn("t", F.when(F.col("last"), F.rtrim("t", F.lit(BLANKS))).otherwise(F.col("t")))
    first = F.substring("t", 1, 1)
    # What opens the chunk ("[" or a comma) goes, and the array's own end, so that the items between remain.
    body = F.expr("substring(t, 2)")
    body = F.when(F.col("last"), F.expr("substring(t, 2, greatest(length(t) - 2, 0))")).otherwise(body)
    only_end = F.col("last") & (F.col("item") > 0) & (F.col("t") == "]")
    blank = F.trim("__body", F.lit(BLANKS)) == ""
    parsed = joined.withColumn("__body", F.when(only_end, F.lit("")).otherwise(body)).withColumn("items", F.from_json(F.concat(F.lit("["), F.col("__body"), F.lit("]")), "array<variant>"))
    reason = (
        F.when((F.col("item") == 0) & (first != "["), "not_array")
        .when((F.col("item") > 0) & ~only_end & ((first != ",") | blank), "bad_json")
        .when(F.col("last") & (F.col("open") | (F.col("end_depth") != 0) | (F.substring("t", -1, 1) != "]")), "bad_json")
        .when((F.col("least") < 1) | F.col("items").isNull(), "bad_json")
    )
    return parsed.select(FILE, "item", "items", reason.alias("reason"))
