"""Document vectors from the company that words keep.

Words that stand among the same neighbours get near vectors, also when they never meet. Every word falls into one of ``terms``
hash buckets as a term and one of ``contexts`` as a neighbour, so the counts of all documents form a table of bounded size. Its
positive pointwise mutual information is factorised through the square matrix of contexts, and a document is the mean of the
vectors of its words, frequent words counting less, at unit length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions import text as tx
from reviewlens.session import scratch_path

TERMS, CONTEXTS, WINDOW = 1 << 14, 128, 4
#: Words of a text go to Python in pieces of this many, and whole pieces are counted in slices of so many words. A slice takes
#: about 100 bytes a word at a time, in each of an executor's workers.
PIECE, SLICE = 4096, 100_000


@dataclass
class TermVectors:
    """``matrix``: one row for each term bucket, its vector times its weight."""

    matrix: np.ndarray
    stop: list[str]

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(n, [float(v) for v in row]) for n, row in enumerate(self.matrix) if row.any()]
        meta = spark.createDataFrame([(*self.matrix.shape, self.stop)], "terms int, dim int, stop array<string>")
        meta.write.mode("overwrite").parquet(f"{path}/settings")
        spark.createDataFrame(rows, "term int, vec array<float>").write.mode("overwrite").parquet(f"{path}/vectors")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TermVectors:
        meta = spark.read.parquet(f"{path}/settings").first()
        matrix = np.zeros((meta.terms, meta.dim), "float32")
        for row in spark.read.parquet(f"{path}/vectors").collect():  # at most one row a bucket
            matrix[row.term] = row.vec
        return TermVectors(matrix, list(meta.stop))


def word_hashes(text: Column, stop: list[str]) -> Column:
    """Hashes of a text's content words, in order. Null and empty texts have none."""
    return F.coalesce(F.transform(tx.content_words(text, stop), lambda w: F.xxhash64(w)), F.array().cast("array<bigint>"))


def _buckets(hashes: np.ndarray, terms: int, contexts: int) -> tuple[np.ndarray, np.ndarray]:
    u = hashes.astype("int64").view("uint64")
    return (u % np.uint64(terms)).astype("int64"), ((u >> np.uint64(32)) % np.uint64(contexts)).astype("int64")


def _slices(column: pd.Series) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch that hold a bounded number of words, one text at least."""
    ends = np.cumsum([len(x) for x in column])
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + SLICE, side="right")))
        yield start, stop
        start = stop


def cooccurrence(docs: DataFrame, stop: list[str], terms: int = TERMS, contexts: int = CONTEXTS, window: int = WINDOW, text: str = "text") -> DataFrame:
    """(term, context, n): how often a word of bucket ``term`` has one of bucket ``context`` at most ``window`` words away in the
    same text. Long texts are cut into pieces that overlap by the window; each pair is counted in one piece only."""
    hashes = word_hashes(F.col(text), stop)
    starts = lambda h: F.sequence(F.lit(1), F.greatest(F.size(h), F.lit(1)), F.lit(PIECE))
    whole = docs.select(hashes.alias("h")).select("h", F.explode_outer(starts(F.col("h"))).alias("at"))
    cut = whole.select(F.slice("h", F.col("at"), F.lit(PIECE + window)).alias("h"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A task adds up all its texts before anything is shuffled: one number a cell, 17 MB with the usual sizes.
        total = np.zeros(terms * contexts, "int64")
        for pdf in frames:
            column = pdf["h"]
            for a, b in _slices(column):
                part = column.iloc[a:b]
                sizes = [len(x) for x in part]
                if not sum(sizes):
                    continue
                flat = np.concatenate([np.asarray(x, "int64") for x in part])
                t, c = _buckets(flat, terms, contexts)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                # The words beyond a piece are there as second words only: the next piece starts with them.
                first = np.concatenate([np.arange(n) < PIECE for n in sizes])
                for d in range(1, window + 1):
                    ok = (owner[:-d] == owner[d:]) & first[:-d]
                    np.add.at(total, t[:-d][ok] * contexts + c[d:][ok], 1)
                    np.add.at(total, t[d:][ok] * contexts + c[:-d][ok], 1)
        there = np.flatnonzero(total)
        for start in range(0, len(there), 100_000):
            cell = there[start : start + 100_000]
            yield pd.DataFrame({"cell": cell, "n": total[cell]})

    cells = cut.mapInPandas(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    return cells.select(F.floor(F.col("cell") / contexts).alias("term"), (F.col("cell") % contexts).alias("context"), "n")


def _information(pdf: pd.DataFrame, contexts: int, column_totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term buckets of a block of counts, their rows of positive information, and their totals. A bucket's counts are all in the block."""
    ids, row = np.unique(pdf["term"].to_numpy(), return_inverse=True)
    counts = np.zeros((len(ids), contexts))
    np.add.at(counts, (row, pdf["context"].to_numpy()), pdf["n"].to_numpy())
    totals = counts.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        m = np.log(counts * column_totals.sum() / (totals[:, None] * column_totals[None, :]))
    return ids, np.where(counts > 0, np.maximum(m, 0.0), 0.0), totals


def _ordered(table: pa.Table, keys: list[str], vec: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The first key and the vectors of a table, in the order of its keys."""
    table = table.sort_by([(k, "ascending") for k in keys]).combine_chunks()
    flat = table.column(vec).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return table.column(keys[0]).to_numpy(), flat.reshape(-1, width)


def fit(docs: DataFrame, stop: list[str], dim: int = 64, terms: int = TERMS, contexts: int = CONTEXTS, window: int = WINDOW, text: str = "text", smooth: float = 1e-3) -> TermVectors:
    """Vectors of all term buckets, from all documents. The driver holds a matrix of the contexts and one of the terms."""
    if dim > contexts:
        raise ValueError("a vector has at most one dimension for each context")
    spark = docs.sparkSession
    path = scratch_path(spark, "cooccurrence")
    cooccurrence(docs, stop, terms, contexts, window, text).write.parquet(path)
    cells = spark.read.parquet(path)
    by_context = np.zeros(contexts)
    for r in cells.groupBy("context").agg(F.sum("n").alias("n")).collect():  # one row a context
        by_context[r.context] = r.n
    matrix = np.zeros((terms, dim), "float32")
    if not by_context.any():
        return TermVectors(matrix, list(stop))
    # Blocks of 1,024 buckets: a block's matrix is a few MB, whatever the number of documents.
    blocks = cells.groupBy(F.floor(F.col("term") / 1024).alias("block"))

    def squares(pdf: pd.DataFrame) -> pd.DataFrame:
        _, m, _ = _information(pdf, contexts, by_context)
        return pd.DataFrame({"block": pdf["term"].iloc[0] // 1024, "i": np.arange(contexts), "row": list(m.T @ m)})

    # One square for each block, 2 MB in all with the usual sizes; added up in a fixed order.
    parts = blocks.applyInPandas(squares, "block long, i long, row array<double>").toArrow()
    at, rows = _ordered(parts, ["i", "block"], "row", contexts)
    gram = np.zeros((contexts, contexts))
    np.add.at(gram, at, rows)
    values, axes = np.linalg.eigh(gram)
    axes = axes[:, np.argsort(-values, kind="stable")[:dim]]
    axes *= np.where(axes[np.abs(axes).argmax(axis=0), np.arange(dim)] < 0, -1.0, 1.0)
    everything = by_context.sum()

    def project(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, m, totals = _information(pdf, contexts, by_context)
        v = m @ axes
        # A row that the kept axes do not hold at all would be rounding noise brought to unit length.
        length, whole = np.linalg.norm(v, axis=1, keepdims=True), np.linalg.norm(m, axis=1, keepdims=True)
        v = np.where(length > 1e-9 * whole, v / np.maximum(length, 1e-300), 0.0)
        v *= (smooth / (smooth + totals / everything))[:, None]
        return pd.DataFrame({"term": ids, "vec": list(v.astype("float32"))})

    at, rows = _ordered(blocks.applyInPandas(project, "term long, vec array<float>").toArrow(), ["term"], "vec", dim)  # at most one row a bucket
    matrix[at] = rows
    return TermVectors(matrix, list(stop))


def embed(docs: DataFrame, model: TermVectors, text: str = "text") -> DataFrame:
    """Add ``embedding``, of unit length; the zero vector where no word is known (null and empty texts too). No shuffle."""
    matrix = model.matrix
    terms, dim = matrix.shape

    def encode(hashes: pd.Series) -> pd.Series:
        out = []
        for x in hashes:
            v = np.zeros(dim)
            if len(x):
                bucket, n = np.unique(_buckets(np.asarray(x), terms, 1)[0], return_counts=True)
                v = n @ matrix[bucket].astype("float64")
            out.append((v / max(np.linalg.norm(v), 1e-300)).astype("float32"))
        return pd.Series(out)

    return docs.withColumn("embedding", F.pandas_udf(encode, "array<float>")(word_hashes(F.col(text), model.stop)))
