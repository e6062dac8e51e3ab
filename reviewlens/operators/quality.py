"""Profiles: nulls, coverage, manifest and field breakdowns. Each is one pass over its table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions.numeric import share_pct


def _profile(df: DataFrame, columns: list[str], per_column) -> DataFrame:
    """One aggregate row with a struct per column, turned into one row per column."""
    wide = df.agg(*[F.struct(*per_column(c)).alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("s"))
                        for i, c in enumerate(columns, 1)])
    return wide.select(F.explode(entries).alias("e")).select("e.position", "e.column_name", "e.s.*")


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Percent of nulls per column."""
    n = F.count(F.lit(1))
    cols = columns or df.columns
    return _profile(df, cols, lambda c: [share_pct(n - F.count(F.col(c)), n).alias("null_pct")])


def field_coverage(df: DataFrame, columns: list[str] | None = None, example_chars: int = 40) -> DataFrame:
    """Percent filled and the smallest value as an example per field."""
    n = F.count(F.lit(1))
    cols = columns or df.columns
    return _profile(
        df,
        cols,
        lambda c: [
            F.count(F.col(c)).alias("n_filled"),
            share_pct(F.count(F.col(c)), n).alias("coverage_pct"),
            F.substring(F.min(F.col(c)).cast("string"), 1, example_chars).alias("example"),
        ],
    )


def manifest(df: DataFrame, example_chars: int = 50) -> DataFrame:
    """Position, name, type, null percent and example of every column."""
    types = dict(df.dtypes)
    n = F.count(F.lit(1))
    return _profile(
        df,
        df.columns,
        lambda c: [
            F.lit(types[c]).alias("data_type"),
            share_pct(n - F.count(F.col(c)), n).alias("null_pct"),
            F.substring(F.min(F.col(c)).cast("string"), 1, example_chars).alias("example"),
        ],
    )


def field_breakdown(classified: DataFrame) -> DataFrame:
    """Rows, grouped, with keywords and noise per text field."""
    return classified.groupBy("text_field").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("macro_group").alias("n_grouped"),
        F.count("top_keywords").alias("n_keywords"),
        F.count_if(F.coalesce(F.col("is_noise"), F.lit(False))).alias("n_noise"),
    )


def coverage(classified: DataFrame) -> DataFrame:
    """Topic and group assignment, date range and products per text field."""
    n = F.count(F.lit(1))
    return classified.groupBy("text_field").agg(
        n.alias("n_rows"),
        F.count("topic_id").alias("n_topic"),
        share_pct(F.count("topic_id"), n).alias("pct_topic"),
        F.count("macro_group").alias("n_group"),
        share_pct(F.count("macro_group"), n).alias("pct_group"),
        F.min("review_date").alias("first_date"),
        F.max("review_date").alias("last_date"),
        F.countDistinct("product_name").alias("n_products"),
    )


def top_groups(classified: DataFrame, n: int = 8) -> DataFrame:
    """Largest groups per text field."""
    from reviewlens.operators.dedup import keep_top

    counts = classified.filter(F.col("group_label").isNotNull()).groupBy("text_field", "group_label").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return keep_top(counts, ["text_field"], [F.col("n_rows").desc(), F.col("group_label").asc()], n, "group_rank")


def coverage_report(classified: DataFrame, n: int = 8) -> DataFrame:
    """``coverage`` with the largest groups of each field, as one line of text."""
    part = F.concat(F.col("group_label"), F.lit(": "), F.col("n_rows").cast("string"))
    lines = top_groups(classified, n).groupBy("text_field").agg(F.sort_array(F.collect_list(F.struct("group_rank", part.alias("part")))).alias("__parts"))
    report = lines.select("text_field", F.array_join(F.transform("__parts", lambda p: p["part"]), " | ").alias("top_groups"))
    return coverage(classified).join(report, "text_field", "left")


def scorer_acceptance(scored: DataFrame, warn_at: float = 75.0) -> DataFrame:
    """Confusion counts per expected label, the overall pass rate and its band (columns expected, sentiment_label)."""
    labels = ["negative", "neutral", "positive"]
    counts = scored.groupBy("expected").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        *[F.count_if(F.col("sentiment_label") == k).alias(f"got_{k}") for k in labels],
        F.count_if(F.col("sentiment_label") == F.col("expected")).alias("__passed"),
    )
    rate = counts.agg(share_pct(F.sum("__passed"), F.sum("n_pairs")).alias("pass_pct")).scalar()
    band = F.when(F.col("pass_pct") >= 100.0, "pass").when(F.col("pass_pct") >= warn_at, "warning").otherwise("fail")
    return counts.withColumn("pass_pct", rate).withColumn("band", band).drop("__passed")
