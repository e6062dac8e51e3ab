"""Document fingerprints by spot signatures.

A signature is a common word and the chain of the three content words that follow it; common words inside the chain are
stepped over. The start of a text and of each of its lines counts as a common word too, so texts of any language have some.
A fingerprint is the whole set of a text's signatures as 32-bit hashes, ascending. Two sets are compared by their Jaccard
similarity, pruned: sizes that cannot reach the wanted similarity are not compared, and comparing ends as soon as what is
left of the shorter set cannot reach it.

Near-duplicates put the sets into partitions by length, wide enough that a set's partners are in its own or the next one.
Inside, a set is listed under its rarest signatures, of which partners must share one.
"""

from __future__ import annotations

import bisect
import hashlib
from array import array
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import join_groups, map_batches, rows_of, written
from reviewlens.llm.near_dup import connected

#: Common words of several languages, besides all words of one or two letters.
COMMON = """
the and that with from was for are this have has had not you your which they were been but its his her she who will would there
their what all can one out about when into than then them these some could other also only more
der die das und ist ein eine einer eines einem einen den dem des nicht mit von auf für als auch sich wir sie ich bei aus nach wie
über war hat haben werden wird sind oder aber noch nur zum zur
les des une est que qui dans pour pas sur avec sont aux par plus ces ses mais nous vous ils elle elles être ont cette comme tout
los las una que por con para del como más pero sus este esta son fue han hay muy entre sin sobre también cuando
gli che non per una del della dei con sono come più anche alla nel
não uma com para dos das por mais como mas foi
het een van niet dat zijn met voor ook aan door naar maar
""".split()

CHAIN = 3
_LINE = b"\x01"
_SEPARATOR = set(range(128)) - set(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ'")
_TO_WORDS = bytes(1 if c in (10, 13) else 32 if c in _SEPARATOR else c + 32 if 65 <= c <= 90 else c for c in range(256))
_COMMON = frozenset(w.encode() for w in COMMON)


def is_common(word: bytes) -> bool:
    return len(word) <= 2 or word in _COMMON or len(word) <= 8 and not word.isascii() and len(word.decode("utf-8", "replace")) <= 2


def signatures(text: bytes, chain: int = CHAIN) -> array:
    """The signatures of a text, ascending and each once.

    A chain at the end of a text may be shorter. A text of common words alone has one signature, made of all of them; one
    without any word has one made of its bytes; the empty text has none.
    """
    if not text:
        return array("I")
    content, anchors = [], [(b"", 0)]  # anchors with the number of content words before them
    for word in text.translate(_TO_WORDS).replace(_LINE, b" \x01 ").split():
        if word == _LINE:
            anchors.append((b"", len(content)))
        elif is_common(word):
            anchors.append((word, len(content)))
        else:
            content.append(word)
    if not content:
        words = [w for w, _ in anchors if w]
        return array("I", [xxhash.xxh32_intdigest(b" ".join(words) if words else text)])
    digest = xxhash.xxh32_intdigest
    chains = [b" ".join(content[at : at + chain]) for at in range(len(content))]
    return array("I", sorted({digest(b"%b:%b" % (word, chains[at])) for word, at in anchors if at < len(content)}))


def fingerprint(signs: array) -> str:
    """The set in hexadecimal, eight digits a signature."""
    return np.frombuffer(signs, np.uint32).astype(">u4").tobytes().hex() if signs else ""


def jaccard(a: array, b: array, least: float = 0.0) -> float:
    """Similarity of two ascending sets, or 0 as soon as it is certain to be below ``least``. Two empty sets are alike."""
    if len(a) > len(b):
        a, b = b, a
    if not b:
        return 1.0
    if len(a) < least * len(b):
        return 0.0
    # With ``both`` in common the similarity is both / (sizes - both).
    most_missing = len(a) - ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9)
    inside, found, missing, at = set(b) if len(b) < 8 * len(a) else None, 0, 0, 0
    for x in a:
        if inside is not None:
            hit = x in inside
        else:
            at = bisect.bisect_left(b, x, at)
            hit = at < len(b) and b[at] == x
        if hit:
            found += 1
        else:
            missing += 1
            if missing > most_missing:
                return 0.0
    score = found / (len(a) + len(b) - found)
    return score if score >= least else 0.0


# -- each document, its edited text and the next document ----------------------------------


def edited(text: str, follower: str) -> str:
    """The last half of the text, rounded down, gives way to the first as many code points of the follower."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


class Ranges:
    """Ranges of the order by (id, hash): nulls first, an id on many rows cut into several ranges by the hash."""

    def __init__(self, splits: list[int], null_ranges: int):
        self.splits, self.nulls = np.array(splits, np.int64), null_ranges

    def of(self, ids: pa.Array, hashes: np.ndarray) -> np.ndarray:
        none = np.array(ids.is_null())
        values = ids.fill_null(0).to_numpy().astype(np.int64)
        low, high = np.searchsorted(self.splits, values, "left"), np.searchsorted(self.splits, values, "right")
        place = (hashes.astype(np.float64) + 2.0**63) / 2.0**64
        many = high - low
        within = np.minimum((place * many).astype(np.int64), np.maximum(many - 1, 0))
        out = np.where(many > 0, low + 1 + within, high) + self.nulls
        return np.where(none, np.minimum((place * self.nulls).astype(np.int64), max(self.nulls - 1, 0)), out)


def _ranges(rows: DataFrame, parts: int) -> Ranges:
    """About ``parts`` ranges with as many rows each, from quantiles of the ids."""
    steps = [k / parts for k in range(1, parts)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("ids"), F.percentile_approx("doc_id", steps or [0.5], 50 * parts).alias("at")).first()
    return Ranges(sorted(found.at or []) if steps else [], -(-(found.n - found.ids) * parts // max(found.n, 1)))


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of docs (doc_id, text).

    The next document is the one with the next id; documents that share an id follow a hash of their text, those without an id
    come first, and after the last comes the first (a lone document follows itself). Null counts as empty; an empty text has an
    empty fingerprint, and two empty ones are alike (1). Texts are read whole. Other columns are ignored; an empty table gives
    an empty result.

    Rows move once, compressed, to ranges of the order. Each range also gets a copy of the first row of the range after it, so
    tasks read their rows in order, two at a time, and no range needs another.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    ranges = _ranges(rows, parts)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        part = ranges.of(batch.column(0), batch.column(1).to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), batch.column(0), batch.column(1)], ["part", "doc_id", "hash"])

    placed = map_batches(hashed.select("doc_id", "hash"), place, "part int, doc_id long, hash long")
    first = placed.groupBy("part").agg(F.min_by(F.struct("doc_id", "hash"), F.struct("doc_id", "hash")).alias("head"))
    heads = sorted((r.part, r["head"].doc_id, r["head"].hash) for r in first.collect())  # one row for each range
    before = {(doc_id, at): heads[k - 1][0] for k, (_, doc_id, at) in enumerate(heads)}
    schema = "part int, tail boolean, doc_id long, hash long, packed binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        sent: set[int] = set()
        for batch in batches:
            part = ranges.of(batch.column(0), batch.column(2).to_numpy())
            packed = [packer.compress(t) for t in rows_of(batch.column(1))]
            ids, hashes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            more = []
            for k, key in enumerate(zip(ids, hashes)):
                if key in before and before[key] not in sent:
                    sent.add(before[key])
                    more.append(k)
            at = [*range(batch.num_rows), *more]
            tail = [False] * batch.num_rows + [True] * len(more)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*part.tolist(), *[before[ids[k], hashes[k]] for k in more]], pa.int32()),
                    pa.array(tail, pa.bool_()),
                    batch.column(0).take(pa.array(at)),
                    batch.column(2).take(pa.array(at)),
                    pa.array([packed[k] for k in at], pa.binary()),
                ],
                ["part", "tail", "doc_id", "hash", "packed"],
            )

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                yield batch.slice(start, 512)

    moved = hashed.select("doc_id", "text", "hash").mapInArrow(lambda it: pack(sliced(it)), schema)
    ordered = moved.repartition(parts, "part").sortWithinPartitions("part", "tail", F.col("doc_id").asc_nulls_first(), "hash")
    out_schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        last, done = None, []
        for batch in batches:
            for part, tail, doc_id, packed in zip(*[batch.column(c).to_pylist() for c in (0, 1, 2, 4)]):
                if tail and (last is None or last[0] != part or last[1]):
                    continue  # another copy of the same row
                raw = unpack.decompress(packed)
                now = (part, tail, doc_id, raw.decode(), signatures(raw))
                if last is not None and last[0] == part and not last[1]:
                    _, _, own_id, text, signs = last
                    new = edited(text, now[3]).encode()
                    changed = signatures(new)
                    done.append((own_id, len(text), hashlib.sha256(new).hexdigest(), fingerprint(signs), fingerprint(changed), jaccard(signs, changed), jaccard(signs, now[4])))
                    if len(done) >= 256:
                        yield _batch(done)
                        done = []
                last = now
        if done:
            yield _batch(done)

    return ordered.mapInArrow(lambda it: compare(sliced(it)), out_schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


# -- near-duplicates -----------------------------------------------------------------------


def signature_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, signs (the set, four bytes a signature) and key (a digest of the set) for every row of docs (doc_id, text)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [signatures(t) for t in rows_of(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "n", "signs"]
        )

    rows = map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n long, signs binary")
    return rows.withColumn("key", F.sha2("signs", 256))


def length_part(n: int, percent: int) -> int:
    """Partition of a set by its size. Sizes that can reach ``percent`` similarity are in one partition or in neighbouring ones."""
    part, end = 0, 1
    while n > end:
        end = end * 100 // percent + 1
        part += 1
    return part


def least_common(n: int, percent: int) -> int:
    """How many signatures a set must share with any set that reaches ``percent``."""
    return -(-n * percent // 100)


def forest(pdf: pd.DataFrame, percent: int) -> list[tuple[str, str]]:
    """Links that join all members whose sets reach ``percent``, one fewer than members at most. Of two blocks, members meet those
    of the other; sizes ascend, so a member stops at the first set too long for it."""
    rows = sorted(zip(pdf["n"], pdf["key"], pdf["side"], pdf["own"], (array("I", s) for s in pdf["signs"])), key=lambda r: r[:2])
    root = list(range(len(rows)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    crossed, links = pdf["low"].iloc[0] != pdf["high"].iloc[0], []
    for i, (n, key, side, own, signs) in enumerate(rows):
        for j in range(i + 1, len(rows)):
            m, other, there, theirs, more = rows[j]
            if 100 * n < percent * m:
                break
            if (crossed and side == there) or not (own or theirs) or find(i) == find(j):
                continue
            if jaccard(signs, more, percent / 100 - 1e-9):
                root[find(i)] = find(j)
                links.append((key, other))
    return links


def near_duplicates(docs: DataFrame, percent: int = 80, block: int = 512) -> DataFrame:
    """doc_id, n_signatures, component_id (smallest doc_id reachable over links of ``percent`` similarity or more), kept.

    One row for each row of docs (doc_id, text). Equal sets are one class; only classes are compared, so a text on a third of
    all rows costs as much as one. A signature that many classes list is compared in blocks of ``block`` members, two blocks a
    task; nothing is left out, and a task returns links that join its members, not all pairs. Null and empty texts and rows
    without an id are linked with nothing and kept. Other columns are ignored; an empty table gives an empty result.
    """
    sets = written(signature_sets(docs), "spot-sets")
    usable = sets.filter("n > 0 AND doc_id IS NOT NULL")
    classes = written(
        usable.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members"), F.first("n").alias("n"), F.first("signs").alias("signs")), "spot-classes"
    )
    each = map_batches(classes.select("key", "signs"), _listed, "key string, signs array<long>").select("key", F.explode("signs").alias("sign"))
    often = each.groupBy("sign").agg(F.count(F.lit(1)).alias("times"))
    rare = each.join(often, "sign").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("times", "sign"))).alias("signs"))
    part = F.udf(lambda n: length_part(n, percent), "int")
    size = F.size("signs")
    wanted = size - F.ceil(size * F.lit(percent) / 100) + 1
    lists = rare.select("key", part(size).alias("part"), F.explode(F.slice("signs", F.lit(1), wanted.cast("int"))["sign"]).alias("sign"))
    places = lists.select("key", "sign", F.explode(F.array(F.struct("part", F.lit(True).alias("own")), F.struct((F.col("part") + 1).alias("part"), F.lit(False).alias("own")))).alias("p"))
    places = written(places.select("key", "sign", "p.part", "p.own"), "spot-places")
    sizes = places.groupBy("sign", "part").agg(F.count(F.lit(1)).alias("g"), F.max("own").alias("any_own")).filter("g > 1 AND any_own")
    blocks = F.ceil(F.col("g") / block).cast("int")
    dealt = places.join(sizes, ["sign", "part"]).select("key", "sign", "part", "own", F.pmod(F.xxhash64("key"), blocks).cast("int").alias("side"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    met = dealt.join(classes.select("key", "n", "signs"), "key").select("key", "n", "signs", "own", "side", "sign", "part", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"))
    task = ["sign", "part", "low", "high"]
    found = met.groupBy(*task).applyInPandas(lambda pdf: pd.DataFrame(forest(pdf, percent), columns=["a", "b"]), "a string, b string")
    links = written(found.distinct(), "spot-links")
    together = connected(links, "spot")
    at = classes.select("key", "rep", "members").join(together, F.col("key") == F.col("node"), "left").select("key", "rep", "members", F.coalesce("component", "key").alias("c"))
    lowest = at.groupBy("c").agg(F.min("rep").alias("component_id"), F.sum("members").alias("all_members"))
    needed = written(at.join(lowest, "c").filter("all_members > 1").select("key", "members", "component_id"), "spot-components")
    rows = sets.select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
    joined = join_groups(rows, needed, ["key"], "members", rows.count())
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", F.col("n").alias("n_signatures"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _listed(batch: pa.RecordBatch) -> pa.RecordBatch:
    lists = [np.frombuffer(s, np.uint32).astype(np.int64) for s in batch.column(1).to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int64()))], ["key", "signs"])
