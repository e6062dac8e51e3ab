"""Saving a topic model as tables, and assigning new documents with it."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from reviewlens.functions.numeric import round_half_up
from reviewlens.operators import vectors as ve


@dataclass
class TopicModel:
    encoder: PipelineModel
    centroids: DataFrame
    weights: DataFrame
    settings: dict


def save(path: str, encoder: PipelineModel, centroids: DataFrame, weights: DataFrame, settings: dict) -> None:
    """Encoder, centroids, term weights and settings under one path."""
    spark = centroids.sparkSession
    encoder.write().overwrite().save(f"{path}/encoder")
    centroids.write.mode("overwrite").parquet(f"{path}/centroids")
    weights.write.mode("overwrite").parquet(f"{path}/term_weights")
    spark.createDataFrame([(json.dumps(settings, sort_keys=True),)], "value string").write.mode("overwrite").text(f"{path}/settings")


def load(spark: SparkSession, path: str) -> TopicModel:
    return TopicModel(
        PipelineModel.load(f"{path}/encoder"),
        spark.read.parquet(f"{path}/centroids"),
        spark.read.parquet(f"{path}/term_weights"),
        json.loads(spark.read.text(f"{path}/settings").first()[0]),
    )


def assign(docs: DataFrame, model: TopicModel, stop: list[str]) -> DataFrame:
    """Topic and probability of documents the model has not seen; nothing is fitted."""
    scored = ve.soft_probability(ve.embed(docs, model.encoder, stop), model.centroids)
    return scored.drop("embedding").withColumnRenamed("best_topic", "topic_id").withColumn(
        "probability", round_half_up(scored.probability, 4)
    )
