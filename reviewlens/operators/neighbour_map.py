"""Reduction that keeps neighbours: a map of landmarks, drawn from their neighbour graph, into which every row is placed.

Principal components hold directions of large variance and lose neighbours wherever the vectors lie along a curved surface.
Here a bounded number of rows are landmarks. Each is tied to its nearest landmarks, and the landmarks are moved in the small
space until near ones lie together and others apart (heavy-tailed similarities, gradient steps from a start at the principal
components). Any row, also one not seen before, then goes between the landmarks that it is nearest to, by distance. The fit
is bounded by the landmarks; placing is one matrix product for a batch and moves no row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.clustering import choose_pivots
from reviewlens.operators.ivf import closest, neighbours

#: The fit takes time with the square of the landmarks, on the driver: about 5 seconds for these.
LANDMARKS, NEAR, STEPS = 1024, 15, 300


@dataclass
class NeighbourMap:
    """Unit vectors of the landmarks and where they lie in the small space."""

    landmarks: np.ndarray
    places: np.ndarray
    near: int

    def place(self, x: np.ndarray) -> np.ndarray:
        """The mean of the places of each row's nearest landmarks, weighted by a bell as wide as the farthest of them is away."""
        k = min(self.near, len(self.landmarks))
        # Distances are measured row by row, so a vector has the same place in every batch.
        _, best, d = closest(_unit(x), self.landmarks, k, False)
        best, d = best.reshape(-1, k), d.reshape(-1, k)
        weight = np.exp(-2 * (d / np.maximum(d.max(axis=1, keepdims=True), 1e-300)) ** 2)
        weight = weight / weight.sum(axis=1, keepdims=True)
        return (weight[:, :, None] * self.places[best]).sum(axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b**2).sum(axis=1)[None, :], 0.0)


def _ties(x: np.ndarray, near: int) -> np.ndarray:
    """Shares of all ties for each pair of landmarks: symmetric, zero where neither is among the other's nearest."""
    d2 = _squares(x, x)
    np.fill_diagonal(d2, np.inf)
    best = np.argsort(d2, axis=1, kind="stable")[:, :near]
    mine = np.take_along_axis(d2, best, axis=1)
    ties = np.zeros_like(d2)
    ties[np.arange(len(x))[:, None], best] = np.exp(-2 * mine / np.maximum(mine[:, -1:], 1e-300))
    ties = np.maximum(ties, ties.T)
    return ties / ties.sum()


def layout(x: np.ndarray, k: int, near: int = NEAR, steps: int = STEPS) -> np.ndarray:
    """Places of unit vectors in ``k`` dimensions such that tied ones lie close. The same input gives the same places."""
    n, k_near = len(x), min(near, len(x) - 1)
    centred = x - x.mean(axis=0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    start = centred @ axes[:k].T
    y = np.zeros((n, k))
    y[:, : start.shape[1]] = start / max(start.std(), 1e-300)
    if n < 3 or k_near < 1:
        return y
    ties, speed, tail = _ties(x, k_near), np.zeros_like(y), max(k - 1, 1)
    for step in range(steps):
        bell = 1 / (1 + _squares(y, y) / tail)
        alike = bell ** ((tail + 1) / 2)
        np.fill_diagonal(alike, 0)
        # Ties pull harder at first, so that groups form before they are pushed apart.
        pull = (ties * (4 if step < steps // 6 else 1) - alike / alike.sum()) * bell
        gradient = 2 * (tail + 1) / tail * (pull.sum(axis=1)[:, None] * y - pull @ y)
        speed = 0.8 * speed - 0.5 * n * gradient
        y = y + speed
    return y


def fit(df: DataFrame, key: str, k: int = 10, vec: str = "embedding", landmarks: int = LANDMARKS, near: int = NEAR) -> NeighbourMap:
    """A map fitted on at most ``landmarks`` different vectors, drawn in hash order of their key."""
    some = choose_pivots(df.filter(F.col(vec).isNotNull()), key, landmarks, vec).orderBy("cell").collect()  # ``landmarks`` rows
    if not some:
        raise ValueError("no vectors to fit on")
    x = np.unique(_unit(np.array([r.pivot for r in some], "float64")), axis=0)
    return NeighbourMap(x, layout(x, k, near), near)


def place(df: DataFrame, fitted: NeighbourMap, vec: str = "embedding", out: str = "reduced") -> DataFrame:
    """Add ``out``, the place of every row; null where there is no vector. Equal vectors get equal places."""

    def run(vectors: pd.Series) -> pd.Series:
        found = pd.Series([None] * len(vectors), dtype=object)
        there = np.flatnonzero(vectors.notna().to_numpy())
        for start in range(0, len(there), 1000):
            rows = there[start : start + 1000]
            for r, y in zip(rows, fitted.place(np.stack(vectors.iloc[rows].to_numpy()).astype("float64"))):
                found[r] = y
        return found

    return df.withColumn(out, F.pandas_udf(run, "array<double>")(F.col(vec)))


def reduce_by_neighbours(df: DataFrame, key: str, k: int = 10, vec: str = "embedding", landmarks: int = LANDMARKS) -> DataFrame:
    """``df`` with ``reduced``: ``k`` dimensions in which rows that are near by cosine stay near."""
    return place(df, fit(df, key, k, vec, landmarks), vec)


def kept_neighbours(df: DataFrame, key: str, full: str, reduced: str, k: int = 15, queries: Column | None = None) -> DataFrame:
    """One row: ``kept``, the share of the ``k`` nearest rows in ``full`` that are among the ``k`` nearest in ``reduced``.

    Over all rows as queries, or those where ``queries`` holds, always against all rows.
    """
    side = lambda vec: neighbours(df, key, k, vec, queries).select(key, "neighbour")
    both = side(full).withColumn("__full", F.lit(1)).join(side(reduced).withColumn("__small", F.lit(1)), [key, "neighbour"], "left")
    return both.agg((F.count("__small") / F.count("__full")).alias("kept"))
