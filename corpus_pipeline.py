"""From raw documents to training tokens: five stages, each a job of its own that reads what the one before it has written."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewlens.llm import bpe, compression, extendible, mixing, near_dup  # noqa: E402
from reviewlens.llm.common import table, written  # noqa: E402
from reviewlens.llm.queries import tokenizer_path  # noqa: E402
from reviewlens.session import clear_scratch, configure, scratch_paths  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts.

    Null and empty texts are judged like a text without any difference; every row, repeated ones too, is judged on its own.
    Here as in all stages texts are read whole, columns of any name pass through, and an empty table gives an empty result.
    """
    return compression.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id (null ids rank lowest). Null and empty texts are equal."""
    return extendible.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id. Copies share 0.8 of their shingles of five words.
    Null and empty texts and rows without an id stay; rows that share an id stay or go together."""
    return near_dup.drop_near_copies(docs, size=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources reach their target weights. Null sources are one source; null and
    empty texts have no size and are repeated at their source's rate; rows that share an id share their draw."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids. Null and empty texts have none; columns named like the added ones are replaced."""
    return bpe.tokenize(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

#: A trained model and a tokenizer cannot be stated in SQL; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each result is written to the shared folder before the next stage reads it; then what the
    stage itself has written there, and what it has read, is deleted."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before = scratch_paths(spark)
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
            mine = [p for p in scratch_paths(spark) if p not in before]
            clear_scratch(spark, [*mine[:-1], *([last] if k else [])])
            last = mine[-1]
    return docs
