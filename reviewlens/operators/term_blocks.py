"""Counts of terms per topic, cut into blocks by the hash of the term.

Nearly half of all two-word terms occur once, so a row for each of them costs more to move and to look up than the counting
itself. A task counts the terms of some documents at a time and hands on one row per block that holds its counts; a block
then adds up all counts of its terms at once. Blocks grow in number with the text, not in size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text per block, and bytes that a task counts at a time.
BLOCK_BYTES, CHUNK_BYTES = 4 * 1024 * 1024, 8 * 1024 * 1024
#: What stands between the words of ``text.WORD``, of which those of one character are dropped.
SEPARATOR = r"[^\p{L}\p{N}_]+"


def _codes(keys: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The different rows of ``keys`` (null is a value), and which of them each row is."""
    names = keys.column_names
    found = keys.append_column("__at", pa.array(np.arange(len(keys)))).group_by(names, use_threads=False).aggregate([("__at", "list")])
    code = np.empty(len(keys), np.int64)
    code[pc.list_flatten(found["__at_list"]).to_numpy()] = np.repeat(np.arange(len(found)), pc.list_value_length(found["__at_list"]).to_numpy())
    return found.select(names), code


def _lists(values: pa.Array, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def _words(lowered: pa.ChunkedArray, stop: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different content words of the texts, and text and word of each occurrence."""
    lists = pc.split_pattern_regex(lowered, SEPARATOR).combine_chunks()
    text = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    coded = pc.list_flatten(lists).dictionary_encode()
    words, word = coded.dictionary, coded.indices.to_numpy()
    good = pc.and_(pc.greater_equal(pc.utf8_length(words), 2), pc.invert(pc.is_in(words, value_set=stop))).to_numpy(zero_copy_only=False)
    kept, place = good[word], np.cumsum(good) - 1
    return words.filter(pa.array(good)), text[kept], place[word[kept]]


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values in order, and where each starts; ``values`` is sorted."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[starts], starts


def _count(docs: pa.Table, keys: list[str], stop: pa.Array, apart: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """One row for each block: the topics met in it, and for each of its terms topic, term and count."""
    topics, code = _codes(docs.select(keys))
    words, doc, word = _words(docs["lowered"], stop)
    if not len(doc):
        return
    # A term is a word and the next one, or none (0).
    wide, follows = len(words) + 1, np.flatnonzero(doc[1:] == doc[:-1])
    coded = (code[doc] * wide + word) * wide
    one = np.concatenate([coded, coded[follows] + word[follows + 1] + 1])
    one.sort()
    one, starts = _distinct(one)
    n = np.diff(np.append(starts, len(doc) + len(follows)))
    left, second = np.divmod(one, wide)
    code, first = np.divmod(left, wide)
    # Fields before the topic are apart, so all counts of a field's term are in one block.
    salt = np.array([zlib.crc32(repr(tuple(r.values())).encode()) for r in topics.select(keys[:apart]).to_pylist()] if apart else [0] * len(topics), np.uint64)
    hashes = np.array([zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()], np.uint64)
    mixed = (hashes[first] + salt[code]) * np.uint64(0x9E3779B97F4A7C15) + np.append(np.uint64(0), hashes)[second] * np.uint64(0xC2B2AE3D27D4EB4F)
    block = ((mixed >> np.uint64(32)) % np.uint64(blocks)).astype(np.int16 if blocks < 2**15 else np.int32)
    order = np.argsort(block, kind="stable")
    block, starts = _distinct(block[order])
    code, first, second, n = code[order], first[order], second[order], n[order]
    heads, pairs = words.take(pa.array(first)), pa.array(second > 0)
    terms = pc.if_else(pairs, pc.binary_join_element_wise(heads, words.take(pa.array(np.maximum(second - 1, 0))), " "), heads)
    # The topics of a block, each once, and the place of each term's topic among them.
    slot = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order)))) * len(topics) + code
    met = np.zeros(len(starts) * len(topics), bool)
    met[slot] = True
    before = np.cumsum(met) - met
    first_met = before[:: len(topics)]
    columns = {"block": pa.array(block, pa.int32())}
    for k in keys:
        columns[k] = _lists(topics[k].combine_chunks().take(pa.array(np.flatnonzero(met) % len(topics))), first_met)
    columns["at"] = _lists(pa.array((before[slot] - before[slot // len(topics) * len(topics)]).astype(np.int32)), starts)
    columns["term"] = _lists(terms, starts)
    columns["n"] = _lists(pa.array(n.astype(np.int64)), starts)
    yield pa.RecordBatch.from_pydict(columns)


def _added(parts: pa.Table, keys: list[str]) -> tuple[pa.Table, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(topics, topic of each count, terms, term of each count, n) of one block."""
    listed = pa.table({k: pc.list_flatten(parts[k]) for k in keys})
    topics, code = _codes(listed)
    sizes = pc.list_value_length(parts[keys[0]]).to_numpy()
    base = np.repeat(np.cumsum(sizes) - sizes, pc.list_value_length(parts["at"]).to_numpy())
    coded = pc.list_flatten(parts["term"]).combine_chunks().dictionary_encode()
    terms, n = coded.dictionary, pc.list_flatten(parts["n"]).to_numpy()
    one = code[pc.list_flatten(parts["at"]).to_numpy() + base] * len(terms) + coded.indices.to_numpy()
    order = np.argsort(one)
    one, starts = _distinct(one[order])
    return topics, one // len(terms), terms, one % len(terms), np.add.reduceat(n[order], starts)


def blocks_of(docs: DataFrame, keys: list[str], stop: list[str], apart: int = 0) -> DataFrame:
    """Counts of all terms of ``text`` as rows (block, topics, counts). The first ``apart`` keys and the term fix the block."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()[0]  # one row
    blocks = int(size) // BLOCK_BYTES + 1
    item = lambda name, kind: T.StructField(name, T.ArrayType(kind))
    lists = [*[item(k, docs.schema[k].dataType) for k in keys], item("at", T.IntegerType()), item("term", T.StringType()), item("n", T.LongType())]
    schema = T.StructType([T.StructField("block", T.IntegerType()), *lists])
    unwanted = sorted(set(stop))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_bytes, words = [], 0, pa.array(unwanted, pa.string())
        for batch in batches:
            # A batch of long texts is cut, so what is held at a time has a bound (or is one text).
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("lowered")), 0).to_numpy())
            start = 0
            while start < len(batch):
                passed = ends[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(ends, passed + CHUNK_BYTES - held_bytes, side="right")))
                held.append(batch.slice(start, end - start))
                held_bytes += int(ends[end - 1] - passed)
                start = end
                if held_bytes >= CHUNK_BYTES or start < len(batch):
                    yield from _count(pa.Table.from_batches(held), keys, words, apart, blocks)
                    held, held_bytes = [], 0
        if held:
            yield from _count(pa.Table.from_batches(held), keys, words, apart, blocks)

    return docs.select(*keys, F.lower("text").alias("lowered")).mapInArrow(count, schema)


def counts(docs: DataFrame, keys: list[str], stop: list[str]) -> DataFrame:
    """(keys, term, n): occurrences of each term in each topic."""
    schema = T.StructType([*[docs.schema[k] for k in keys], T.StructField("term", T.StringType()), T.StructField("n", T.LongType())])

    def add(parts: pa.Table) -> pa.Table:
        topics, code, terms, term, n = _added(parts, keys)
        mine = topics.take(pa.array(code))
        return pa.table({**{k: mine[k] for k in keys}, "term": terms.take(pa.array(term)), "n": n})

    return blocks_of(docs, keys, stop).groupBy("block").applyInArrow(add, schema)


def frequent(docs: DataFrame, keys: list[str], stop: list[str], min_df: int) -> DataFrame:
    """(keys, term, n, doc_freq, term_total) of the terms that occur in ``min_df`` topics of a field or more, and rows without
    a term that name the topics which have any. ``keys`` ends with the topic, fields before it stay apart.

    A block holds all counts of its terms, so rare terms, which are most, never leave it.
    """
    apart = len(keys) - 1
    longs = [T.StructField(c, T.LongType()) for c in ("n", "doc_freq", "term_total")]
    schema = T.StructType([*[docs.schema[k] for k in keys], T.StructField("term", T.StringType()), *longs])

    def add(parts: pa.Table) -> pa.Table:
        topics, code, terms, term, n = _added(parts, keys)
        field = _codes(topics.select(keys[:apart]))[1] if apart else np.zeros(len(topics), np.int64)
        _, group = np.unique(field[code] * len(terms) + term, return_inverse=True)
        doc_freq = np.bincount(group)[group]
        total = np.zeros(len(group), np.int64)
        np.add.at(total, group, n)
        total, good = total[group], doc_freq >= min_df
        at = pa.array(np.concatenate([code[good], np.arange(len(topics))]))
        none = pa.nulls(len(topics), pa.int64())
        whole = lambda values: pa.chunked_array([pa.array(values[good], pa.int64()), none])
        names = pa.chunked_array([terms.take(pa.array(term[good])), none.cast(pa.string())])
        mine = topics.take(at)
        return pa.table({**{k: mine[k] for k in keys}, "term": names, "n": whole(n), "doc_freq": whole(doc_freq), "term_total": whole(total)})

    return blocks_of(docs, keys, stop, apart).groupBy("block").applyInArrow(add, schema)
