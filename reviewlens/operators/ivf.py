"""Nearest neighbours through an inverted file: cells around centres, probed nearest first, and an exact way for the rest.

Equal vectors are one class, so a vector on a third of all rows costs as much as any other; a class carries its ``k + 1``
lowest keys, all that any result can need of it. Classes go to the cell of their nearest centre; the number of cells follows
the square root of the classes, so finding a cell and scanning some cells are each far from all pairs. A query visits its
``probes`` nearest cells first, which gives it a distance to beat. What may lie closer in another cell is bounded from below
by the cell's radius and by the plane between the two centres; cells that this bound does not rule out are visited too, and
only rows that beat the distance come out of them. Cells and the queries that visit them are cut into blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.operators.dedup import keep_top
from reviewlens.session import ensure_checkpoint_dir

#: Centres are fitted on at most this many classes for each, and there are at most so many of them.
SAMPLE_PER_CELL, MAX_CELLS = 16, 4096
#: Room for the rounding of distances that are compared with a bound.
SLACK = 1e-6


def closest(q: np.ndarray, y: np.ndarray, k: int, same: bool, chunk: int = 256, pairs: int = 100_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``q`` the ``k`` closest rows of ``y``: positions in both and distances. ``same``: q is y, and no row finds itself.

    A matrix product rules rows out, with room for its rounding; what is left is measured exactly. Ties go to the first row of ``y``.
    """
    k = min(k, len(y) - same)
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    squares = (y**2).sum(axis=1)
    for start in range(0, len(q) if k > 0 else 0, chunk):
        part = q[start : start + chunk]
        own = (part**2).sum(axis=1)
        rough = np.maximum(own[:, None] - 2 * (part @ y.T) + squares[None, :], 0.0)
        if same:
            rough[np.arange(len(part)), np.arange(start, start + len(part))] = np.inf
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
        r, c = np.nonzero(rough <= ((np.sqrt(kth) + 2e-9) ** 2 + 1e-12 * (own + squares.max()))[:, None])
        d = [np.sqrt(((part[r[at : at + pairs]] - y[c[at : at + pairs]]) ** 2).sum(axis=1)) for at in range(0, len(r), pairs)]
        d = np.floor(np.concatenate(d) * 1e9 + 0.5) / 1e9
        order = np.lexsort((c, d, r))
        r, c, d = r[order], c[order], d[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < k
        out.append((r[keep] + start, c[keep], d[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres**2).sum(axis=1)[None, :], 0.0))


def fit_centres(classes: DataFrame, n: int, cells: int, rounds: int = 5) -> np.ndarray:
    """Centres by a few rounds of k-means over at most ``SAMPLE_PER_CELL * cells`` classes, drawn in hash order of their key."""
    drawn = classes.select("code", "vec").orderBy("code").limit(SAMPLE_PER_CELL * cells).collect()
    x = np.array([r.vec for r in drawn], np.float64)
    centres = x[:cells].copy()
    for _ in range(rounds):
        at = np.concatenate([_distances(x[s : s + 2048], centres).argmin(axis=1) for s in range(0, len(x), 2048)])
        sums, counts = np.zeros_like(centres), np.bincount(at, minlength=len(centres))
        np.add.at(sums, at, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _classes(rows: DataFrame, key: str, vec: str, k: int, asked: Column) -> DataFrame:
    """One row for each different vector: cls (its lowest key), code, vec, members (its lowest keys), asked (it holds a query)."""
    low = keep_top(rows.select(F.col(vec).alias("vec"), F.col(key).alias("key")), ["vec"], [F.col("key")], k + 1)
    members = low.groupBy("vec").agg(F.sort_array(F.collect_list("key")).alias("members"))
    flags = rows.groupBy(F.col(vec).alias("vec")).agg(F.max(asked).alias("asked"))
    both = members.join(flags, "vec")
    cls = F.col("members")[0]
    return both.select(cls.alias("cls"), F.md5(cls.cast("string").cast("binary")).alias("code"), F.col("vec").cast("array<double>").alias("vec"), F.col("vec").alias("raw"), "members", "asked")


def _visit(pairs: DataFrame, index: DataFrame, sizes: DataFrame, k: int, block: int, key: T.DataType) -> DataFrame:
    """(q, neighbour, distance): for each query and cell the ``k`` nearest rows of other classes that are within the query's bound.

    ``pairs``: q, cell, vec, bound. Both sides are cut into blocks; every two blocks of a cell meet in one task.
    """
    asked = pairs.groupBy("cell").agg(F.count(F.lit(1)).alias("n_queries"))
    # One row for each cell, of which there are at most MAX_CELLS.
    cut = F.broadcast(sizes.join(asked, "cell").select("cell", F.ceil(F.col("n") / block).cast("int").alias("rows_in"), F.ceil(F.col("n_queries") / block).cast("int").alias("queries_in")))
    deal = lambda c, parts: F.pmod(F.xxhash64(c), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = pairs.join(cut, "cell").withColumn("y", deal("q", "queries_in")).withColumn("x", every("rows_in")).select("cell", "x", "y", "q", "vec", "bound")
    right = index.join(cut, "cell").withColumn("x", deal("cls", "rows_in")).withColumn("y", every("queries_in")).select("cell", "x", "y", "cls", "vec", "members")
    schema = T.StructType([T.StructField("q", key), T.StructField("neighbour", key), T.StructField("distance", T.DoubleType())])

    def meet(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"q": [], "neighbour": [], "distance": []})
        rows = rows.sort_values("cls")
        q, y = (np.stack(side["vec"].to_numpy()).astype(np.float64) for side in (queries, rows))
        # One more than asked for, as a query may meet its own class.
        r, c, d = closest(q, y, k + 1, False)
        own, cls, bound = queries["q"].to_numpy(), rows["cls"].to_numpy(), queries["bound"].to_numpy()
        keep = (own[r] != cls[c]) & (d <= bound[r])
        found = pd.DataFrame({"q": own[r[keep]], "neighbour": rows["members"].to_numpy()[c[keep]], "distance": d[keep]})
        found["neighbour"] = [m[:k] for m in found["neighbour"]]
        found = found.explode("neighbour").sort_values(["q", "distance", "neighbour"])
        return found[found.groupby("q").cumcount() < k]

    return left.groupBy("cell", "x", "y").cogroup(right.groupBy("cell", "x", "y")).applyInPandas(meet, schema)


def neighbours(
    df: DataFrame,
    key: str,
    k: int = 5,
    vec: str = "embedding",
    queries: Column | None = None,
    pivots: int | None = None,
    probes: int = 8,
    block: int = 4096,
    exact: bool = True,
) -> DataFrame:
    """(key, neighbour, rank, distance): the ``k`` nearest of all other rows for every row, or for those where ``queries`` holds.

    Keys are unique. Rows without a vector neither ask nor are found. Distances are Euclidean, rounded to nine decimals before
    they are ranked; ties go to the lower key. The result is exact; with ``exact=False`` the cells beyond the ``probes`` nearest
    are not visited, the work is near linear, and some neighbours may be missed. ``pivots`` sets the number of cells, by
    default the square root of the number of different vectors (``MAX_CELLS`` at most; then cells grow and are cut into blocks).
    """
    ensure_checkpoint_dir(df.sparkSession)
    asked = F.lit(True) if queries is None else F.coalesce(queries, F.lit(False))
    rows = df.filter(F.col(vec).isNotNull()).withColumn("__asked", asked).select(key, vec, "__asked")
    classes = _classes(rows, key, vec, k, F.col("__asked")).checkpoint()
    n, kind = classes.count(), df.schema[key].dataType
    out = T.StructType([df.schema[key], T.StructField("neighbour", kind), T.StructField("rank", T.IntegerType()), T.StructField("distance", T.DoubleType())])
    if n == 0:
        return df.sparkSession.createDataFrame([], out)
    cells = max(1, min(pivots or round(n**0.5), MAX_CELLS, n))
    centres = fit_centres(classes, n, cells)  # at most MAX_CELLS rows
    probes = min(probes, len(centres))
    near_type = "array<struct<cell:int,distance:double>>"

    def place(vectors: pd.Series) -> pd.Series:
        found = []
        for start in range(0, len(vectors), 1024):
            d = _distances(np.stack(vectors.iloc[start : start + 1024].to_numpy()), centres)
            best = np.argsort(d, axis=1, kind="stable")[:, :probes]
            found += [[{"cell": int(c), "distance": float(x)} for c, x in zip(b, v)] for b, v in zip(best, np.take_along_axis(d, best, axis=1))]
        return pd.Series(found)

    placed = classes.withColumn("near", F.pandas_udf(place, near_type)("vec")).withColumn("cell", F.col("near")[0]["cell"]).checkpoint()
    # Named anew: rows and queries come from one table and meet in one cogroup.
    index = placed.select(*[F.col(c).alias(f"{c}_") for c in ("cell", "cls", "vec", "members")]).toDF("cell", "cls", "vec", "members")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("near")[0]["distance"]).alias("radius")).checkpoint()
    asking = placed.filter("asked")
    no_bound = F.lit(float("inf"))
    first = asking.select(F.col("cls").alias("q"), "vec", no_bound.alias("bound"), F.explode("near.cell").alias("cell"))
    found = _visit(first, index, sizes, k, block, kind)
    if exact and probes < len(centres):
        found = found.checkpoint()
        # Copies of the query itself are at distance 0; the k-th distance so far is the one to beat.
        so_far = keep_top(found, ["q"], [F.col("distance"), F.col("neighbour")], k).groupBy("q").agg(F.sort_array(F.collect_list("distance")).alias("found"))
        zeros = F.array_repeat(F.lit(0.0), F.size("members") - 1)
        kth = F.get(F.concat(zeros, F.coalesce("found", F.array().cast("array<double>"))), F.lit(k - 1))
        open_queries = asking.join(so_far, asking.cls == so_far.q, "left").select(F.col("cls").alias("q"), "vec", "near", F.coalesce(kth, no_bound).alias("bound"))
        radius = np.full(len(centres), -np.inf)
        for r in sizes.collect():  # one row for each cell
            radius[r.cell] = r.radius
        between = _distances(centres, centres)
        schema = T.StructType([T.StructField("q", kind), T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("bound", T.DoubleType()), T.StructField("cells", T.ArrayType(T.IntegerType()))])

        def more(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for big in frames:
                for start in range(0, len(big), 1024):
                    pdf = big.iloc[start : start + 1024]
                    d = _distances(np.stack(pdf["vec"].to_numpy()), centres)
                    own = np.array([near[0]["cell"] for near in pdf["near"]])
                    # Rows of another cell are nearer to its centre than to the query's own.
                    plane = (d**2 - d[np.arange(len(pdf)), own][:, None] ** 2) / (2 * np.maximum(between[own], 1e-12))
                    least = np.where(radius > -np.inf, np.maximum(d - radius, plane), np.inf)
                    wanted = least <= pdf["bound"].to_numpy()[:, None] + SLACK
                    wanted &= radius > -np.inf
                    for line, near in zip(wanted, pdf["near"]):
                        line[[x["cell"] for x in near]] = False
                    yield pdf[["q", "vec", "bound"]].assign(cells=[np.flatnonzero(line).astype(np.int32) for line in wanted])

        rest = open_queries.mapInPandas(more, schema).withColumn("cell", F.explode("cells")).drop("cells")
        found = found.unionByName(_visit(rest, index, sizes, k, block, kind))
    others = keep_top(found, ["q"], [F.col("distance"), F.col("neighbour")], k).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("distance", "neighbour"))).alias("found")
    )
    known = asking.join(others, asking.cls == others.q, "left").select(F.col("raw").alias("__vec"), "members", "found")
    mine = rows.filter("__asked").select(key, F.col(vec).alias("__vec")).join(known, "__vec")
    item = "array<struct<distance:double,neighbour:{}>>".format(kind.simpleString())
    copies = F.transform(F.filter("members", lambda m: m != F.col(key)), lambda m: F.struct(F.lit(0.0).alias("distance"), m.alias("neighbour")))
    best = F.slice(F.sort_array(F.concat(copies.cast(item), F.coalesce("found", F.array().cast(item)))), 1, k)
    ranked = mine.select(key, best.alias("__best")).select(key, F.posexplode("__best").alias("__at", "__one"))
    return ranked.select(key, "__one.neighbour", (F.col("__at") + 1).cast("int").alias("rank"), "__one.distance")
