"""Near-duplicates with HyperMinHash.

A document's shingle hashes are dealt into 256 buckets by their leading bits. Of the smallest hash in a bucket, the register
keeps the number of leading zeros (6 bits) and the bits after the first one (10 bits). Registers in fixed groups of six make
42 band keys; empty buckets borrow from others for that, in an order fixed for all documents. Documents that share a key are
candidates; the share of equal registers, less what equal registers would turn up by chance, estimates their Jaccard
similarity, and clearly dissimilar candidates go no further. The others are confirmed on their full shingle sets.

At a similarity of exactly 0.8 a link is missed with a probability of about 3 in a million, above it less.

Groups of copies are never expanded into pairs. Documents with the same set are one class with one representative. Inside a
key's group, everyone is compared with the group's first and last member; what this links is joined into components. After
that, only members that are not in the largest component of their group are held against the others of the group, and a pair
becomes a row only if a parity sketch allows the link. The sketch has a bit for each of 1,024 cells, set where an odd number
of shingles falls into the cell. Two sketches differ in at most as many bits as the sets differ in shingles, so this test
never rules out a link. A group of thousands of near copies thus costs a few rows for each member, and no link that connects
two components is left out. Both sides of these comparisons are cut into blocks, and every two blocks of a group are a join
key of their own, so the comparisons of one large group spread over tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.llm.common import join_groups, map_batches, rows_of, written
from reviewlens.llm.shingles import mix, shingle_sets

BUCKET_BITS, ZERO_BITS, MANTISSA = 8, 6, 10
BUCKETS = 1 << BUCKET_BITS
ROWS, BANDS = 6, 42
EMPTY = 0xFFFF
#: Candidates are dropped on the estimate only if it lies this many standard deviations below the threshold.
DEVIATIONS = 5.0
#: Longs of a parity sketch.
PARITY = 16
#: Members of a group on either side of the comparisons that one key of the join holds.
BLOCK = 1024
_rng = np.random.Generator(np.random.PCG64(20250115))
#: For each bucket the order in which it borrows from the others when it is empty.
_BORROW = np.stack([np.concatenate([[k], _rng.permutation(np.delete(np.arange(BUCKETS), k))]) for k in range(BUCKETS)])
_BAND_MIX = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """256 registers from sorted distinct 64-bit hashes."""
    out = np.full(BUCKETS, EMPTY, np.uint16)
    if len(hashes):
        bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        first = np.flatnonzero(np.diff(bucket, prepend=-1))  # hashes are sorted: the first of a bucket is its smallest
        rest = hashes[first] << np.uint64(BUCKET_BITS)
        high = np.frexp(np.maximum(rest >> np.uint64(11), 1).astype(np.float64))[1] + 10  # position of the leading one
        zeros = np.minimum(63 - high, 64 - BUCKET_BITS)
        tail = (rest << zeros.astype(np.uint64)) << np.uint64(1)
        mantissa = (tail >> np.uint64(64 - MANTISSA)).astype(np.uint16)
        out[bucket[first]] = np.minimum(zeros, (1 << ZERO_BITS) - 2).astype(np.uint16) << MANTISSA | mantissa
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    filled = regs != EMPTY
    if not filled.all():
        gaps = np.flatnonzero(~filled)
        order = _BORROW[gaps]
        regs = regs.copy()
        regs[gaps] = regs[order[np.arange(len(gaps)), filled[order].argmax(1)]]
    groups = regs[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix((groups * _BAND_MIX).sum(1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    cells = np.bincount((hashes & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of pairs of register rows, and the number of buckets it rests on.

    For two sets without a common element the expected number of equal registers is about 0.1699 * 2^(bucket bits - mantissa
    bits) * 4r / (1 + r)^2 with r the ratio of their sizes; that many are taken off.
    """
    some = np.maximum(((a != EMPTY) | (b != EMPTY)).sum(1), 1)
    equal = ((a == b) & (a != EMPTY)).sum(1)
    r = np.maximum(na, nb) / np.maximum(np.minimum(na, nb), 1)
    chance = 0.169919487159739 * 2.0 ** (BUCKET_BITS - MANTISSA) * 4 * r / (1 + r) ** 2
    return np.clip((equal - chance) / some, 0, 1), some


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n, set_a, set_b (128-bit digest of the set; null for empty sets), bands.

    Most documents share no band with any other; only the others' registers are stored, with their sets (``_candidates``).
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ns, sa, sb, bands = [], [], [], []
        for s in shingle_sets(rows_of(batch.column(1)), size):
            ns.append(len(s))
            d = xxhash.xxh3_128_intdigest(s.tobytes())
            sa.append(int.from_bytes((d >> 64).to_bytes(8, "big"), "big", signed=True) if len(s) else None)
            sb.append(int.from_bytes((d & (2**64 - 1)).to_bytes(8, "big"), "big", signed=True) if len(s) else None)
            bands.append(band_keys(registers(s)) if len(s) else np.zeros(0, np.int64))
        ends = np.concatenate([[0], np.cumsum([len(k) for k in bands])]).astype(np.int32)
        keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*bands, np.zeros(0, np.int64)])))
        cols = [batch.column(0), pa.array(ns, pa.int64()), pa.array(sa, pa.int64()), pa.array(sb, pa.int64()), keys]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "set_a", "set_b", "bands"])

    kinds = [docs.schema["doc_id"]] + [T.StructField(c, T.LongType()) for c in ("n", "set_a", "set_b")]
    kinds += [T.StructField("bands", T.ArrayType(T.LongType()))]
    return map_batches(docs.select("doc_id", "text"), run, T.StructType(kinds), max_bytes=2 << 20)


def _likely(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose estimate does not rule the threshold out."""
    regs = nodes.select("doc_id", "n", "registers")
    a = regs.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    b = regs.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    # Sizes alone rule many pairs out: the smaller set is at most the intersection, the larger at least the union.
    wide = pairs.join(a, "a").join(b, "b").filter(F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = {c: batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "na", "nb", "ra", "rb")}
        ra, rb = (np.frombuffer(b"".join(t[c].to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("ra", "rb"))
        j, some = estimate(ra, rb, t["na"].to_numpy(), t["nb"].to_numpy())
        keep = j >= threshold - DEVIATIONS * np.sqrt(threshold * (1 - threshold) / some)
        return pa.RecordBatch.from_arrays([t["a"].filter(pa.array(keep)), t["b"].filter(pa.array(keep))], ["a", "b"])

    return map_batches(wide, run, pairs.select("a", "b").schema).distinct()


def _candidates(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """doc_id, n, set, registers, parity of the documents that share a band key with another: one pass over the texts."""
    used = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi")

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(rows_of(batch.column(1)), size)
        steps = pa.array(np.arange(0, PARITY * len(sets) + 1, PARITY, dtype=np.int32))
        parity = pa.ListArray.from_arrays(steps, pa.array(np.concatenate([*[parity_sketch(s) for s in sets], np.zeros(0, np.int64)])))
        cols = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
        cols += [pa.array([registers(s).tobytes() for s in sets], pa.binary()), parity]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "set", "registers", "parity"])

    kinds = [docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("set", T.BinaryType())]
    kinds += [T.StructField("registers", T.BinaryType()), T.StructField("parity", T.ArrayType(T.LongType()))]
    return map_batches(used, build, T.StructType(kinds), max_bytes=2 << 20)


def _confirmed(pairs: DataFrame, nodes: DataFrame, threshold: float, name: str) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    a = nodes.select(F.col("doc_id").alias("a"), F.col("set").alias("sa"))
    b = nodes.select(F.col("doc_id").alias("b"), F.col("set").alias("sb"))
    wide = pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb")
    percent = round(threshold * 100)

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(u, v, assume_unique=True))
            keep.append(both > 0 and 100 * both >= percent * (len(u) + len(v) - both))
        return pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_())), batch.column(1).filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    return written(map_batches(wide, check, pairs.select("a", "b").schema).distinct(), f"{name}-links")


def connected(links: DataFrame, name: str) -> DataFrame:
    """(node, component) of all nodes in links (a, b); the component is its smallest node.

    Each round every node moves to the neighbour that comes first in a hashed order, and links between moved nodes remain.
    The hashed order keeps chains from being walked step by step, so the rounds grow with the logarithm of the nodes.
    """
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    where = written(nodes.withColumn("at", F.col("node")), f"{name}-at")
    open_links = links
    while not open_links.isEmpty():
        both = open_links.select("a", "b").unionByName(open_links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        near = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        moves = written(near.select(F.col("a").alias("from"), F.least(rank("a"), F.col("m"))["v"].alias("to")), f"{name}-moves")
        left = moves.select(F.col("from").alias("a"), F.col("to").alias("x"))
        right = moves.select(F.col("from").alias("b"), F.col("to").alias("y"))
        moved = open_links.join(left, "a").join(right, "b").filter("x <> y")
        open_links = written(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{name}-open")
        step = moves.select(F.col("from").alias("at"), F.col("to"))
        where = written(where.join(step, "at", "left").select("node", F.coalesce("to", "at").alias("at")), f"{name}-at")
    lowest = where.groupBy("at").agg(F.min("node").alias("component"))
    return where.join(lowest, "at").select("node", "component")


def _across(placed: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs of one group in different components that could be linked, from (key, node, c)."""
    counts = placed.groupBy("key", "c").agg(F.count(F.lit(1)).alias("k"))
    per_key = counts.groupBy("key").agg(
        F.max(F.struct("k", "c"))["c"].alias("main"), F.max("k").alias("inside"), F.sum("k").alias("all"), F.count(F.lit(1)).alias("parts")
    )
    cut = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed = per_key.filter("parts > 1").select("key", "main", cut(F.col("all") - F.col("inside")).alias("x_parts"), cut(F.col("all")).alias("y_parts"))
    bits = nodes.select(F.col("doc_id").alias("node"), "n", *[F.col("parity")[k].alias(f"p{k}") for k in range(PARITY)])
    open_places = written(placed.join(mixed, "key").join(bits, "node"), "near-open")
    # A member lies in one block of its side and is copied to the blocks of the other: two members meet once.
    deal = lambda parts: F.pmod(F.xxhash64("node"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    blocks = lambda df, own, other, mine, theirs: df.withColumn(mine, deal(own)).withColumn(theirs, every(other))
    kept = ["node", "c", "n", *[f"p{k}" for k in range(PARITY)]]
    x = blocks(open_places.filter("c <> main"), "x_parts", "y_parts", "x_block", "y_block").select(
        "key", "x_block", "y_block", *[F.col(c).alias(f"x_{c}") for c in kept]
    )
    differing = F.lit(0)
    for k in range(PARITY):
        differing = differing + F.bit_count(F.col(f"x_p{k}").bitwiseXOR(F.col(f"p{k}")))
    # Similarity t or more means that the sets differ in at most (1 - t) / (1 + t) of both sizes together.
    allowed = (F.col("x_n") + F.col("n")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    y = blocks(open_places, "y_parts", "x_parts", "of_y", "of_x").select(F.col("key").alias("y_key"), "of_x", "of_y", *kept)
    met = (F.col("key") == F.col("y_key")) & (F.col("x_block") == F.col("of_x")) & (F.col("y_block") == F.col("of_y"))
    cond = met & (F.col("x_c") != F.col("c")) & (differing <= allowed)
    return x.join(y, cond).select(F.col("x_node").alias("a"), F.col("node").alias("b"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_components(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n, component for every row of docs (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    sigs = written(signatures(docs, size), "near-signatures")
    usable = sigs.filter("n > 0 AND doc_id IS NOT NULL")
    classes = written(usable.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members")), "near-classes")
    reps = usable.join(classes.select(F.col("rep").alias("doc_id"), "set_a", "set_b"), ["doc_id", "set_a", "set_b"], "left_semi")
    places = reps.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    groups = places.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    shared = written(places.join(groups, "key"), "near-groups")
    ids = shared.select(F.col("node").alias("doc_id")).distinct()
    nodes = written(_candidates(docs, ids, size), "near-candidates")
    star = shared.select(F.col("node").alias("a"), F.col("low").alias("b")).unionByName(shared.select(F.col("node").alias("a"), F.col("high").alias("b")))
    first = written(_likely(_ordered(star), nodes, threshold), "near-first")
    links = _confirmed(first, nodes, threshold, "near-first")
    found = written(connected(links, "near-first"), "near-found")
    # Members of one group that are still in different components.
    placed = shared.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c"))
    across = _ordered(_across(placed, nodes, threshold)).join(first, ["a", "b"], "left_anti")
    more = written(_likely(across, nodes, threshold), "near-second")
    of_class = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    if not more.isEmpty():
        # Links between components join these; the nodes inside follow.
        ca = found.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        cb = found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        again = _confirmed(more, nodes, threshold, "near-second").join(ca, "a", "left").join(cb, "b", "left")
        between = _ordered(again.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
        merged = connected(written(between, "near-between"), "near-second").select(F.col("node").alias("component"), F.col("component").alias("__to"))
        of_class = of_class.join(merged, "component", "left").withColumn("component", F.coalesce("__to", "component")).drop("__to")
    needed = of_class.filter("members > 1 OR component <> rep").select("set_a", "set_b", "members", "component")
    rows = sigs.select("doc_id", "n", "set_a", "set_b")
    joined = join_groups(rows, needed, ["set_a", "set_b"], "members", rows.count())
    alone = F.col("component").isNull() | F.col("doc_id").isNull()
    return joined.select("doc_id", "n", F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component"))


def components_of(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Null and empty texts have no shingles and are linked with nothing. Rows that share an id are one document: each of their
    texts links it, and all of its rows carry the same verdict. Rows without an id are linked with nothing and kept. Other
    columns are ignored; an empty table gives an empty result.
    """
    return link_components(docs, size, threshold).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept")
    )


def drop_near_copies(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents that stay, one of each group, with their own columns, whatever these are called.

    Null and empty texts and rows without an id stay. Rows that share an id stay or go together. An empty table gives an
    empty result.
    """
    gone = components_of(docs, size, threshold).filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
