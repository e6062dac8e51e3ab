"""Sharding by a hierarchical weighted hash tree.

Every row descends region, rack and shard. At each level each child draws ``-ln(u) / weight`` with ``u`` from a hash of the
row's key and the child's name, and the smallest draw wins, so a child gets rows in proportion to its weight. A draw depends
on nothing but the key, the child and the child's weight: when a weight changes, only rows that enter or leave the subtree
below it move. Added shards open a region of their own, so they take rows only into themselves.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from reviewlens.llm.common import hash_unit, id_text


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int, per_rack: int = 4, racks_per_region: int = 2, base: int = 24) -> list[Shard]:
    """The tree for a number of shards: a full layout up to ``base``, then one region for each further shard."""
    out = []
    for n in range(min(shards, base)):
        rack = n // per_rack
        out.append(Shard(f"region{rack // racks_per_region}", f"rack{rack}", n))
    return grow(out, max(0, shards - base))


def grow(tree: list[Shard], by: int = 1) -> list[Shard]:
    """Add shards, each in a new region and rack of its own; no weight that was there before changes."""
    out = list(tree)
    for _ in range(by):
        n = max((s.shard for s in out), default=-1) + 1
        out.append(Shard(f"region+{n}", f"rack+{n}", n))
    return out


def reweight(tree: list[Shard], shard: int, weight: float) -> list[Shard]:
    return [replace(s, weight=weight) if s.shard == shard else s for s in tree]


def _children(pairs: dict[str, dict[str, float]]) -> Column:
    """parent -> array of (child, weight) as a literal map. Its size is the number of nodes, which the cluster fixes."""
    cells = []
    for parent, kids in pairs.items():
        arr = F.array(*[F.struct(F.lit(k).alias("node"), F.lit(float(w)).alias("weight")) for k, w in kids.items()])
        cells += [F.lit(parent), arr]
    return F.create_map(*cells)


def _draw(key: Column, children: Column) -> Column:
    def race(c: Column) -> Column:
        return F.struct((-F.ln(hash_unit(F.concat_ws("/", key, c["node"]))) / c["weight"]).alias("t"), c["node"].alias("node"))

    return F.array_min(F.transform(children, race))["node"]


def place(df: DataFrame, key: Column, tree: list[Shard], prefix: str = "") -> DataFrame:
    """Add the columns region, rack and shard (each with ``prefix``). Shards of weight 0 get nothing."""
    levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for s in tree:
        if s.weight > 0:
            for kids, parent, child in zip(levels, ("", s.region, s.rack), (s.region, s.rack, str(s.shard))):
                kids.setdefault(parent, {})
                kids[parent][child] = kids[parent].get(child, 0.0) + s.weight
    if not levels[0]:
        raise ValueError("no shard has a weight")
    region, rack, shard = f"{prefix}region", f"{prefix}rack", f"{prefix}shard"
    df = df.withColumn(region, _draw(key, _children(levels[0])[""]))
    df = df.withColumn(rack, _draw(key, F.element_at(_children(levels[1]), F.col(region))))
    return df.withColumn(shard, _draw(key, F.element_at(_children(levels[2]), F.col(rack))).cast("int"))


def number_slots(df: DataFrame, shard: str, order: list[Column], spread_by: Column, shards: int, rows_per_block: int = 5_000) -> DataFrame:
    """Add ``slot``: 0, 1, 2 ... within each shard.

    A shard is cut into hash blocks whose number follows the row count; rows are numbered inside a block and shifted by the
    rows of the blocks before it, so no task ever sees a whole shard.
    """
    blocks = max(1, -(-df.count() // (rows_per_block * max(1, shards))))
    cut = df.withColumn("__block", F.pmod(F.xxhash64(spread_by), F.lit(blocks)))
    before = Window.partitionBy(shard).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(shard, "__block").agg(F.count(F.lit(1)).alias("__n"))
    shifts = counts.select(shard, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    rank = F.row_number().over(Window.partitionBy(shard, "__block").orderBy(*order))
    ranked = cut.withColumn("__rank", rank)
    return ranked.join(shifts, [shard, "__block"]).withColumn("slot", F.col("__shift") + F.col("__rank") - 1).drop("__block", "__shift", "__rank")


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, region, rack, shard, slot, grown_shard for every row.

    Law ``key``: id and number of shards alone decide. A null id is placed as the empty text; rows that share an id share a
    shard and get different slots; a null text has no bytes (size 8, CRC 0). Other columns are not read; an empty table gives
    an empty result.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        id_text(F.col(id_col)).alias("__key"),
    )
    tree = topology(shards)
    placed = place(place(rows, F.col("__key"), tree), F.col("__key"), grow(tree), "grown_")
    order = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    return number_slots(placed, "shard", order, F.col("__key"), shards).select(
        "doc_id", "size", "text_crc32", "law", "region", "rack", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )
