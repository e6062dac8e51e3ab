"""Mixing sources to target weights.

Words are added up per source, targets follow from the weights, and each source gets a repetition rate: target over size.
A document is emitted ``floor(rate)`` times, plus once more with a probability equal to the fraction; the draw is a hash of
the seed and the document's id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from reviewlens.llm.common import hash_unit, id_text, salted_lookup, word_count, written

WEIGHTS = (5, 2, 1)


def target_sizes(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add weight, target and rate to a table with one row per source (source, source_size).

    Sources in code point order, null last, get the weights in turn. They share ``share`` times all words; a target stops at
    ``most`` times its source's size and what is above is shared again by weight, until no target is above. That settles at
    one level: target = least(most * size, weight * level), found by ordering the sources by the level at which they stop.
    The windows are over one row per source.
    """
    first = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(first) - 1, F.lit(len(weights)))
    numbered = sources.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")))
    stop = F.lit(most) * F.col("source_size") / F.col("weight")
    order = Window.orderBy("__stop", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        numbered.withColumn("__stop", stop)
        .withColumn("__budget", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("__full", F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("__open", F.sum("weight").over(after))
        .withColumn("__level", (F.col("__budget") - F.col("__full")) / F.col("__open"))
    )
    # The first source in this order that does not stop below its level sets the level of all that are open.
    level = F.min(F.when(F.col("__level") <= F.col("__stop"), F.struct("__stop", "source", "__level"))).over(everything)["__level"]
    cap = F.lit(most) * F.col("source_size")
    target = F.least(cap, F.coalesce(F.col("weight") * F.col("__set"), cap))
    return (
        levels.withColumn("__set", level)
        .withColumn("target", target)
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
        .select("source", "source_size", "weight", "target", "rate")
    )


def copies(rate: Column, doc_id: Column, seed: str) -> Column:
    """Whole repeats plus the hash draw for the fraction."""
    whole = F.floor(rate)
    extra = hash_unit(F.concat(F.lit(f"{seed}/"), id_text(doc_id))) < rate - whole
    return (whole + F.when(extra, 1).otherwise(0)).cast("long")


def _rated(rows: DataFrame, seed: str, **options) -> DataFrame:
    """rows (doc_id, source, size) with source_size, target, rate and copies."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rates = written(target_sizes(sources, **options), "mix-rates")
    joined = salted_lookup(rows, rates, ["source"], F.col("doc_id"))
    return joined.withColumn("copies", copies(F.col("rate"), F.col("doc_id"), seed))


def mix_sizes(docs: DataFrame, seed: str = "mix-1", **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for every row.

    Null and empty texts have no words and take nothing. A source without words has target 0. Rows that share an id share
    their draw. Null sources form a source of their own, which comes last. Other columns are ignored; an empty table gives an
    empty result.
    """
    rows = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    return _rated(rows, seed, **options).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mix(docs: DataFrame, seed: str = "mix-1", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``, whatever these are called.

    Null and empty texts add nothing to their source's size; their rows are repeated at its rate like any other. A source
    without words is left out. Null sources are a source of their own. Rows that share an id share their draw. An empty table
    gives an empty result.
    """
    sizes = written(docs.select("source", word_count(F.col("text")).alias("size")), "mix-sizes")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Written first, so that Spark plans the join by the table's real size: documents are not shuffled for a short list.
    rates = written(target_sizes(sources, **options), "mix-rates").select("source", "rate")
    # The row travels as one column, so no name of it can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source", "doc_id")
    rated = salted_lookup(rows, rates, ["source"], F.col("doc_id"))
    times = F.array_repeat(F.lit(1), copies(F.col("rate"), F.col("doc_id"), seed).cast("int"))
    return rated.select("row", F.explode(times).alias("one")).select(*[F.col("row")[c].alias(c) for c in docs.columns])
