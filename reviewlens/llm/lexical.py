"""Ranked lexical search by dense blocked matrix products.

Items are taken in blocks. The terms of a block are its compact vocabulary: documents are read once and kept as lists of
(term number, occurrences) over it. These become dense impact tiles, documents by terms, and each is multiplied with the
items' weight tiles in float64. All numbers are integers and every partial sum stays below 2^53, so the products are exact
whatever the order of additions; tiles are added up as 64-bit integers. Each task keeps the ``k`` best documents per item
over its tiles and these are ranked per item, first within salted parts and then over them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.llm.common import map_batches, rows_of, written
from reviewlens.operators.dedup import keep_top

#: Terms consist of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased.
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
TO_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _KEPT else 32 for c in range(256))

IMPACT_TOP = 1_000_000  # an impact is below this
EXACT = 1 << 53
MISSING = np.iinfo(np.int64).max  # orders documents without an id after all others


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TO_TERMS).split()


class Vocabulary:
    """Terms of one block of items, numbered, and how often each item has them."""

    def __init__(self, texts: list[bytes]):
        counts = [Counter(terms_of(t)) for t in texts]
        self.terms = sorted(set().union(*counts)) if counts else []
        self.number = {t: k for k, t in enumerate(self.terms)}
        self.cells = [(i, self.number[t], n) for i, c in enumerate(counts) for t, n in sorted(c.items())]


def count_terms(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n (terms with repeats), terms and times: the numbers of the vocabulary's terms in the document, and their occurrences."""
    schema = "doc_id long, n long, terms array<int>, times array<int>"
    number = vocabulary.number

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, ends, terms, times = [], [0], [], []
        for text in rows_of(batch.column(1)):
            found = terms_of(text)
            sizes.append(len(found))
            here = Counter(map(number.get, found))
            here.pop(None, None)
            terms.extend(here.keys())
            times.extend(here.values())
            ends.append(len(terms))
        at = pa.array(ends, pa.int32())
        lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (terms, times)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "times"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), count, schema)


def weights(counted: DataFrame, n_docs: int, n_terms: int) -> np.ndarray:
    """Weight of every term of the vocabulary, from the number of documents that hold it."""
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    out = np.zeros(n_terms, np.int64)  # a term that no document holds adds nothing to any score
    for r in df.select("term", weight.alias("w")).toLocalIterator():
        out[r.term] = r.w
    return out


def weight_tiles(cells: list[tuple[int, int, int]], weight: np.ndarray, n_items: int, width: int = 1024, top: int = IMPACT_TOP) -> list[tuple]:
    """(shift, first term, end term, rows, columns, values): cells of one tile and layer.

    A tile has at most ``width`` terms and as few as keep every item's sum of weights times ``top`` below 2^53. A single cell
    beyond that is spread over layers of 20 bits each, which are shifted back after the product.
    """
    by_term: dict[int, list[tuple[int, int]]] = {}
    for item, term, times in cells:
        if weight[term] > 0:
            by_term.setdefault(term, []).append((item, int(times) * int(weight[term])))
    limit, tiles = (EXACT - 1) // top, []
    sums, begin, inside = [0] * n_items, 0, []

    def close(end: int) -> None:
        nonlocal inside, begin
        if inside:
            tiles.append((0, begin, end, *map(np.array, zip(*inside))))
        sums[:] = [0] * n_items
        inside, begin = [], end

    for term in sorted(by_term):
        column = by_term[term]
        if any(q > limit for _, q in column):
            close(term)
            shift = 0
            while any(q >> shift for _, q in column):
                tiles.append((shift, term, term + 1, *map(np.array, zip(*[(i, term, (q >> shift) & 0xFFFFF) for i, q in column]))))
                shift += 20
            begin = term + 1
            continue
        if term - begin >= width or any(sums[i] + q > limit for i, q in column):
            close(term)
        for i, q in column:
            sums[i] += q
            inside.append((i, term, q))
    close(len(weight))
    return tiles


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores above 0; equal scores by ascending id, however many there are."""
    there = np.flatnonzero(scores > 0)
    if len(there) > k:
        cut = np.partition(scores[there], len(there) - k)[len(there) - k]
        there = there[scores[there] >= cut]
    return there[np.lexsort((ids[there], -scores[there]))][:k]


def _search_block(docs: DataFrame, items: list[Row], k: int, tile: int, width: int) -> DataFrame:
    vocabulary = Vocabulary([(r.text or "").encode() for r in items])
    counted = written(count_terms(docs, vocabulary), "lexical-terms")
    whole = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_all, n_terms, n_items = whole.docs, whole.terms, len(vocabulary.terms), len(items)
    tiles = weight_tiles(vocabulary.cells, weights(counted, n_docs, n_terms), n_items, width)
    shared = docs.sparkSession.sparkContext.broadcast(tiles)  # the block's items bound it
    schema = "item int, doc_id long, score long"

    def score(ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        m = np.array([25 + (75 * int(n) * n_docs) // n_all for n in sizes], np.int64)
        row = np.repeat(np.arange(len(ids)), np.diff(ends))
        impact = (1_000_000_000 * times) // (1000 * times + 8 * m[row])
        order = np.argsort(terms, kind="stable")
        row, terms, impact = row[order], terms[order], impact[order]
        total = np.zeros((n_items, len(ids)), np.int64)
        for shift, begin, end, r, c, v in shared.value:
            lo, hi = np.searchsorted(terms, (begin, end))
            if lo == hi:
                continue
            left, right = np.zeros((n_items, end - begin)), np.zeros((end - begin, len(ids)))
            left[r, c - begin] = v
            right[terms[lo:hi] - begin, row[lo:hi]] = impact[lo:hi]
            total += (left @ right).astype(np.int64) << shift
        return total

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(n_items)]
        for batch in batches:
            for start in range(0, batch.num_rows, tile):
                part = batch.slice(start, tile)
                ids = np.array([MISSING if x is None else x for x in part.column(0).to_pylist()], np.int64)
                lists, lengths = part.column(2), pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                total = score(ids, part.column(1).to_numpy(), ends, lists.flatten().to_numpy().astype(np.int64), part.column(3).flatten().to_numpy().astype(np.int64))
                for i in range(n_items):
                    near = best_of(total[i], ids, k)
                    if len(near):
                        scores, where = np.concatenate([best[i][0], total[i][near]]), np.concatenate([best[i][1], ids[near]])
                        keep = best_of(scores, where, k)
                        best[i] = (scores[keep], where[keep])
        sizes = [len(s) for s, _ in best]
        ids = np.concatenate([w for _, w in best]) if best else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(n_items), sizes), pa.int32()),
                pa.array(ids, pa.int64(), mask=ids == MISSING),
                pa.array(np.concatenate([s for s, _ in best]) if best else [], pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    found = counted.filter(F.size("terms") > 0).mapInArrow(search, schema)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    parts = keep_top(found.withColumn("part", F.spark_partition_id() % 64), ["item", "part"], order, k)
    ranked = keep_top(parts.drop("part"), ["item"], order, k, "rank")
    names = docs.sparkSession.createDataFrame([(n, r.item_id) for n, r in enumerate(items)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", T.LongType())]))
    # One row for each item of the block.
    return ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block: int = 256, block_bytes: int = 16 << 20, tile: int = 1024, width: int = 1024) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents with the highest score above 0 for every row of ``items``.

    ``docs`` (doc_id, text) and ``items`` (item_id, text) may have any other columns. Null and empty texts hold no term: such
    documents are found by nothing and such items find nothing. Items are dealt by hash into blocks of about ``block`` items
    and ``block_bytes`` of text, each of which reads the documents once; a longer item is bounded by being one row. Rows of
    equal item id, repeated ones too, are items of their own, each ranked from 1. Repeated documents are ranked one by one;
    a document without an id comes after others of its score. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.n // block), -(-size.bytes // block_bytes))
    out = None
    for b in range(blocks if size.n else 0):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        if mine:
            found = _search_block(docs, sorted(mine, key=lambda r: (r.item_id is None, r.item_id or 0, r.text or "")), k, tile, width)
            found = found if blocks == 1 else written(found, "lexical-block")
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
