"""One row per key. ``row_number() <= 1`` lets Spark keep one row per key in every task before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def keep_top(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows per key in the given order."""
    rn = rank_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def keep_first(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """First copy of each key in ingest order."""
    return keep_top(df, keys, [F.col(seq).asc()])


def keep_best_topic(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Most probable topic per document; equal probabilities go to the lower topic id."""
    return keep_top(df, keys or ["review_id"], [F.col("probability").desc_nulls_last(), F.col("topic_id").asc()])


def latest_version(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Newest version of each re-scraped row."""
    return keep_top(df, keys, order)
