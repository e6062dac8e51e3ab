"""Exact de-duplication with an extendible-hash index on shared files.

Texts are normalised (A-Z lower-cased, null is empty) and hashed to 64 bits. The leading bits of the hash lead through a
directory to a bucket; a bucket with too many keys is split by one more bit, and the directory doubles when that bucket
already used all of its bits. Each bucket belongs to one task, which reads its key range in hash order, chains entries with
equal hashes and compares their bytes. What it keeps, one row for each distinct text with the number of copies, is the
index: Parquet files in the shared folder, to which further documents can be added later.

Copies inside one Arrow batch are combined before the shuffle, so a text that makes up a third of all rows reaches its
owner as one entry a batch and never as all of its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from reviewlens.llm.common import join_groups, map_batches, written
from reviewlens.session import scratch_path

HASH, SHA, COPIES, BUCKET = "__xi_hash", "__xi_sha", "__xi_copies", "__xi_bucket"
Hasher = Callable[[bytes], int]


def text_hash(norm: bytes) -> int:
    return xxhash.xxh3_64_intdigest(norm)


@dataclass
class Directory:
    """``slots[prefix of depth bits]`` is the bucket; a bucket with a local depth below ``depth`` fills several slots.

    A bucket is known by its own prefix of ``local`` bits, so a split touches one bucket and doubling none; the slots are laid
    out once, when they are asked for.
    """

    depth: int = 0
    local: list[int] = field(default_factory=lambda: [0])
    prefix: list[int] = field(default_factory=lambda: [0])
    laid: np.ndarray | None = None

    def split(self, bucket: int) -> None:
        """The upper half of a bucket becomes a new one; where the bucket filled one slot, the directory doubles."""
        self.local[bucket] += 1
        self.prefix[bucket] <<= 1
        self.local.append(self.local[bucket])
        self.prefix.append(self.prefix[bucket] + 1)
        self.depth, self.laid = max(self.depth, self.local[bucket]), None

    @property
    def slots(self) -> list[int]:
        return self._layout().tolist()

    def _layout(self) -> np.ndarray:
        if self.laid is None:
            # In prefix order the buckets fill the slots from the first to the last.
            free = np.array([self.depth - n for n in self.local])
            order = np.argsort(np.array(self.prefix) << free)
            self.laid = np.repeat(order, 1 << free[order]).astype(np.int32)
        return self.laid

    def bucket_of(self, hashes: np.ndarray) -> np.ndarray:
        """Buckets of unsigned 64-bit hashes."""
        prefix = hashes >> np.uint64(64 - self.depth) if self.depth else np.zeros(len(hashes), np.uint64)
        return self._layout()[prefix.astype(np.int64)]


def grow_directory(counts: np.ndarray, bits: int, capacity: int, start: Directory | None = None) -> Directory:
    """Split until no bucket has more than ``capacity`` keys. ``counts``: keys by prefix of ``bits`` bits.

    A bucket that is still too full at ``bits`` stays so: its owner reads in hash order and needs no more memory for it.
    """
    d = start or Directory()
    upto = np.concatenate([[0], np.cumsum(counts)])
    queue = list(range(len(d.local)))
    while queue:
        b = queue.pop()
        span = bits - d.local[b]
        keys = upto[(d.prefix[b] + 1) << span] - upto[d.prefix[b] << span]
        if keys > capacity and span > 0:
            d.split(b)
            queue += [b, len(d.local) - 1]
    return d


def _hashed(texts: pa.Array, hasher: Hasher) -> tuple[list[bytes], np.ndarray]:
    norm = [b"" if t is None else t.lower() for t in texts.cast(pa.binary()).to_pylist()]
    return norm, np.fromiter((hasher(n) for n in norm), np.uint64, len(norm))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hasher: Hasher = text_hash) -> DataFrame:
    """doc_id, hash, sha of every row: a small row for each text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        norm, h = _hashed(batch.column(1), hasher)
        sha = [hashlib.sha256(n).hexdigest() for n in norm]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(h.view(np.int64)), pa.array(sha, pa.string())], ["doc_id", HASH, SHA])

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField(HASH, T.LongType()), T.StructField(SHA, T.StringType())])
    return map_batches(docs.select(id_col, text_col), run, schema)


def _rank(ids: list, texts: list, i: int) -> tuple:
    return (ids[i] is not None, ids[i] if ids[i] is not None else 0, texts[i])


def _chain(rows: pa.Table, id_col: str, text_col: str) -> pa.Table:
    """One row for each distinct text among rows sorted by hash: the largest id stays, copies are added up."""
    h = rows[HASH].to_numpy()
    if len(h) < 2 or not (same := h[1:] == h[:-1]).any():
        return rows
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    ends = np.append(starts[1:], len(h))
    copies = rows[COPIES].to_numpy().copy()
    keep = np.ones(len(h), bool)
    for s, e in zip(starts, ends):
        if e - s == 1:
            continue
        part = rows.slice(s, e - s)
        ids, texts = part[id_col].to_pylist(), [t or b"" for t in part[text_col].cast(pa.binary()).to_pylist()]
        chain: dict[bytes, int] = {}
        for i, t in enumerate(texts):
            norm = t.lower()
            best = chain.setdefault(norm, i)
            if best != i:
                win, lose = (i, best) if _rank(ids, texts, i) > _rank(ids, texts, best) else (best, i)
                copies[s + win] += copies[s + lose]
                keep[s + lose] = False
                chain[norm] = win
        shas = part[SHA].to_pylist()
        if len({shas[i] for i in chain.values()}) < len(chain):
            raise RuntimeError("two different texts have one SHA-256 digest")
    rows = rows.set_column(rows.schema.get_field_index(COPIES), COPIES, pa.array(copies))
    return rows.filter(pa.array(keep))


class ExtendibleIndex:
    """An index in the shared folder. Each ``add`` writes a new generation of the buckets, so a failed or repeated task
    never touches files that are in use."""

    def __init__(
        self, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2_048, max_buckets: int = 65_536, hasher: Hasher = text_hash
    ) -> None:
        self.spark, self.id_col, self.text_col, self.hasher = spark, id_col, text_col, hasher
        self.capacity, self.max_buckets = capacity, max_buckets
        self.path, self.generation, self.rows = scratch_path(spark, "exact-index"), 0, 0
        self.directory = Directory()

    def entries(self) -> DataFrame:
        """One row for each distinct text: the document that stays, hash, digest, number of copies."""
        return self.spark.read.parquet(f"{self.path}/{self.generation}")

    def add(self, docs: DataFrame, prints: DataFrame) -> DataFrame:
        """Add documents; ``prints`` are their ``fingerprints``. Returns the entries of the whole index."""
        old = self.entries() if self.generation else None
        keys = prints.select(HASH) if old is None else prints.select(HASH).unionByName(old.select(HASH))
        self.rows += prints.count()
        # The directory is bounded: beyond max_buckets buckets, buckets grow instead of the directory.
        capacity = max(self.capacity, -(-self.rows // self.max_buckets))
        bits = max(1, (self.rows // capacity).bit_length() + 3)
        by_prefix = keys.distinct().groupBy(F.shiftrightunsigned(HASH, 64 - bits).alias("p")).agg(F.count(F.lit(1)).alias("n"))
        counts = np.zeros(1 << bits, np.int64)
        for row in by_prefix.collect():  # one row for each prefix, eight times as many as buckets at most
            counts[row.p] = row.n
        self.directory = grow_directory(counts, bits, capacity, self.directory if self.directory.depth <= bits else None)
        fresh = self._prepared(docs)
        rows = fresh if old is None else fresh.unionByName(old.drop(BUCKET).transform(self._placed))
        owners = max(1, len(self.directory.local))
        owned = rows.repartition(owners, BUCKET).sortWithinPartitions(BUCKET, HASH)
        kept = self._owned(owned)
        self.generation += 1
        kept.write.parquet(f"{self.path}/{self.generation}")
        return self.entries()

    def _placed(self, rows: DataFrame) -> DataFrame:
        directory = self.directory

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            h = batch.column(batch.schema.get_field_index(HASH)).to_numpy().view(np.uint64)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(directory.bucket_of(h))], [*batch.schema.names, BUCKET])

        return map_batches(rows, run, T.StructType([*rows.schema.fields, T.StructField(BUCKET, T.IntegerType())]))

    def _prepared(self, docs: DataFrame) -> DataFrame:
        """Whole rows with hash, digest, copies and bucket; copies inside a batch are combined."""
        directory, hasher, id_col, text_col = self.directory, self.hasher, self.id_col, self.text_col

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            norm, h = _hashed(batch.column(batch.schema.get_field_index(text_col)), hasher)
            sha = [hashlib.sha256(n).hexdigest() for n in norm]
            cols = [*batch.columns, pa.array(h.view(np.int64)), pa.array(sha, pa.string()), pa.array(np.ones(len(h), np.int64))]
            full = pa.Table.from_arrays(cols, [*batch.schema.names, HASH, SHA, COPIES])
            full = _chain(full.sort_by(HASH), id_col, text_col) if len(np.unique(h)) < len(h) else full
            hashes = full[HASH].to_numpy().view(np.uint64)
            full = full.append_column(BUCKET, pa.array(directory.bucket_of(hashes)))
            return full.combine_chunks().to_batches()[0]

        more = [T.StructField(HASH, T.LongType()), T.StructField(SHA, T.StringType()), T.StructField(COPIES, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
        return map_batches(docs, run, T.StructType([*docs.schema.fields, *more]))

    def _owned(self, rows: DataFrame) -> DataFrame:
        id_col, text_col = self.id_col, self.text_col

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: pa.Table | None = None  # entries of the last hash seen; it may go on in the next batch
            for batch in batches:
                if not batch.num_rows:
                    continue
                now = pa.Table.from_batches([batch])
                now = _chain(pa.concat_tables([held, now]) if held is not None else now, id_col, text_col)
                last = now[HASH][-1].as_py()
                held_rows = pc.sum(pc.equal(now[HASH], last)).as_py()
                held = now.slice(now.num_rows - held_rows).combine_chunks()
                yield from now.slice(0, now.num_rows - held_rows).to_batches()
            if held is not None:
                yield from held.to_batches()

        return rows.mapInArrow(run, rows.schema)


def flag_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Of equal texts the row with the largest id stays (null ids rank lowest). Rows that repeat both id and text are counted,
    and only one of them is kept. Null and empty texts are equal. Other columns do not matter; an empty table gives an empty
    result.
    """
    prints = written(fingerprints(docs, id_col, text_col, options.get("hasher", text_hash)), "exact-prints")
    index = ExtendibleIndex(docs.sparkSession, id_col, text_col, **options)
    found = index.add(docs.select(id_col, text_col), prints)
    groups = found.filter(F.col(COPIES) > 1).select(HASH, SHA, F.col(id_col).alias("keep_id"), F.col(COPIES).alias("group_size"))
    rows = join_groups(prints, groups, [HASH, SHA], "group_size", index.rows)
    alone = F.col("group_size").isNull()
    again = F.row_number().over(Window.partitionBy("doc_id", SHA).orderBy(HASH))
    return (
        rows.withColumn("keep_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")))
        .withColumn("__again", again)
        .select(
            "doc_id",
            "keep_id",
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__again") == 1)).alias("kept"),
            F.col(SHA).alias("text_sha256"),
        )
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay, with all their columns, read from the index.

    Null and empty texts are equal, so one of them stays; of equal texts it is the row with the largest id (null ids rank
    lowest), and of rows that repeat id and text one stays. Texts of any length are compared whole. Columns of any name pass
    through; an empty table gives an empty result.
    """
    prints = written(fingerprints(docs, id_col, text_col, options.get("hasher", text_hash)), "exact-prints")
    index = ExtendibleIndex(docs.sparkSession, id_col, text_col, **options)
    return index.add(docs, prints).select(*docs.columns)
