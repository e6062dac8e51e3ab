"""Raw items -> unified reviews -> the review meta table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions import coerce as co
from reviewlens.operators.dedup import keep_first
from reviewlens.operators.lookup import join_small


def products(spark: SparkSession) -> DataFrame:
    """The product dimension."""
    return spark.createDataFrame(cfg.PRODUCT_ROWS, cfg.PRODUCT_SCHEMA)


def with_reject_reason(raw: DataFrame, text: str = "item_json") -> DataFrame:
    """Parse the raw text and say why a row cannot be normalised; null means it can.

    The item comes out of an array of one, as a filter on it would else be moved below the parser and parse again.
    """
    parsed = raw.withColumn("item", F.array(F.try_parse_json(F.col(text))))
    known = F.col("source_actor").isin(*cfg.LAYOUTS)
    return parsed.withColumn("item", F.explode_outer("item")).withColumn(
        "reject_reason",
        F.when(F.col("item").isNull(), "bad_json")
        .when(~F.startswith(F.schema_of_variant(F.col("item")), F.lit("OBJECT")), "not_object")
        .when(~F.coalesce(known, F.lit(False)), "unknown_source"),
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNotNull()).drop("item")


def map_fields(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Unified fields of every row, in one pass over all sources."""
    actor, item = F.col("source_actor"), F.col("item")
    keep = raw.columns if keep is None else keep
    return raw.select(*keep, *[co.mapped_field(item, actor, f).alias(f) for f in cfg.MAPPED_FIELDS])


def inject(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Add product id and name; unknown products stay with nulls."""
    return join_small(df, dimension.select("product_key", "product_id", "product_name"), ["product_key"])


def unify(raw: DataFrame, dimension: DataFrame) -> DataFrame:
    """Parsed raw items (source_actor, product_key, scraped_at, item) -> the unified schema."""
    actor, item = F.col("source_actor"), F.col("item")
    carried = [c for c in raw.columns if c not in cfg.UNIFIED_FIELDS or c in ("source_actor", "scraped_at")]
    mapped = (
        map_fields(raw, carried)
        .withColumn("bonus_data", co.bonus_json(item, actor))
        .withColumn("source_platform", co.platform(item, actor))
        .drop("item")
    )
    record = (
        inject(mapped, dimension)
        .withColumn(
            "review_id",
            co.stable_id(
                *[F.col(c) for c in ("review_id", "product_id", "reviewer_name", "review_date", "likes", "dislikes")]
            ),
        )
        .withColumn("extraction_confidence", co.confidence())
    )
    extra = [c for c in record.columns if c not in cfg.UNIFIED_FIELDS and c != "bonus_data"]
    return record.select(*cfg.UNIFIED_FIELDS, "bonus_data", *extra)


# -- second stage: flatten and trim ---------------------------------------------


def flatten_bonus(df: DataFrame, bonus: str = "bonus_data") -> DataFrame:
    """Named columns from the bonus JSON; anything that is not an object gives the defaults."""
    return (
        df.withColumn("__bonus", F.try_parse_json(F.col(bonus).cast("string")))
        .withColumns(
            {
                "review_title": co.bonus_text(F.col("__bonus"), "title"),
                "review_type": co.bonus_text(F.col("__bonus"), "type"),
                "reviewer_region": co.bonus_text(F.col("__bonus"), "region"),
                "review_url": co.bonus_text(F.col("__bonus"), "url"),
                "review_submitted_at": co.bonus_text(F.col("__bonus"), "submitted"),
                "is_incentivized": co.incentivized(co.bonus_text(F.col("__bonus"), "type")),
                "switched_from_product": co.switched_products(F.col("__bonus")),
                "switched_from_reason": co.switched_reason(F.col("__bonus")),
            }
        )
        .drop("__bonus", bonus)
    )


def drop_static(df: DataFrame) -> DataFrame:
    """Drop columns known to be empty and columns internal to the pipeline."""
    return df.drop(*cfg.NULL_COLUMNS, *cfg.PIPELINE_COLUMNS)


def base_reviews(unified: DataFrame) -> DataFrame:
    """Unified reviews with a real date, flat bonus columns and without dead columns."""
    return drop_static(flatten_bonus(unified.withColumn("review_date", co.to_utc_date(F.col("review_date")))))


def select_present(df: DataFrame, ordered: list[str]) -> DataFrame:
    return df.select(*[c for c in ordered if c in df.columns])


def reorder(df: DataFrame, ordered: list[str]) -> DataFrame:
    """Preferred columns first, any others after."""
    first = [c for c in ordered if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in ordered])


def build_meta(reviews: DataFrame, seq: str) -> DataFrame:
    """One row per review: the first copy, ordered columns."""
    wanted = [c for c in cfg.META_COLUMNS if c in reviews.columns]
    slim = reviews.select(*wanted, *([] if seq in wanted else [seq]))
    return keep_first(slim, ["review_id"], seq).select(*wanted)


def lookback(df: DataFrame, as_of: Column, days: int = cfg.LOOKBACK_DAYS, column: str = "review_date") -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``."""
    return df.filter(F.col(column) >= F.date_sub(as_of, days))
