"""Gradient-boosted trees for two classes on a bounded training table, with histogram splits."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boost:
    """Trees of a fixed depth, each as arrays over its inner nodes (feature, threshold) and leaves (value)."""

    base: float = 0.0
    depth: int = 4
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += leaf[at - (2**self.depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 2.0) -> Boost:
    """Newton boosting on the logistic loss. Ties between splits go to the first feature and lowest threshold."""
    n, columns = x.shape
    share = float(np.clip(y.mean(), 0.01, 0.99)) if n else 0.5
    model = Boost(float(np.log(share / (1 - share))), depth)
    if not n or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(columns)]
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    score = np.full(n, model.base)
    inner = 2**depth - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            pick, cut = np.zeros(width, np.int64), np.full(width, bins)
            for j in range(columns):
                key = (at - first) * (bins + 1) + codes[:, j]
                gs = np.bincount(key, g, width * (bins + 1)).reshape(width, -1).cumsum(1)
                hs = np.bincount(key, h, width * (bins + 1)).reshape(width, -1).cumsum(1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (ga - gs) ** 2 / (ha - hs + ridge) - ga**2 / (ha + ridge)
                k = gain[:, : len(cuts[j])].argmax(1) if len(cuts[j]) else np.zeros(width, np.int64)
                top = gain[np.arange(width), k] if len(cuts[j]) else np.zeros(width)
                better = top > best + 1e-9
                best, pick, cut = np.where(better, top, best), np.where(better, j, pick), np.where(better, k, cut)
            for m in range(width):
                if cut[m] < bins:
                    feature[first + m], threshold[first + m] = pick[m], cuts[pick[m]][cut[m]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf_of = at - inner
        gs, hs = np.bincount(leaf_of, g, inner + 1), np.bincount(leaf_of, h, inner + 1)
        leaf = rate * gs / (hs + ridge)
        score += leaf[leaf_of]
        model.trees.append((feature, threshold, leaf))
    return model
