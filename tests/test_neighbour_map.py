"""Reduction by the neighbour graph of landmarks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import neighbour_map as nm
from reviewlens.operators import vectors as ve


def curved(n, seed=0):
    """Points of a curved surface of three dimensions in a space of 64."""
    rng = np.random.default_rng(seed)
    turn, shift = np.random.default_rng(99).normal(size=(3, 64)) * 7, np.random.default_rng(98).uniform(0, 6.3, 64)
    return np.cos(rng.uniform(0, 1, (n, 3)) @ turn + shift)


def frame(spark, x):
    return spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "vec_id long, embedding array<float>")


def brute_kept(full, small, k, asked):
    def near(x):
        d = ((x[asked][:, None, :] - x[None]) ** 2).sum(axis=2)
        d[np.arange(len(asked)), asked] = np.inf
        return np.argsort(d, axis=1)[:, :k]

    return np.mean([len(set(a) & set(b)) / k for a, b in zip(near(full), near(small))])


def test_more_neighbours_than_principal_components(spark):
    x = curved(4000)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = frame(spark, x)
    fitted = nm.fit(df, "vec_id", 6, landmarks=512)
    assert len(fitted.landmarks) == 512
    both = ve.reduce_dims(nm.place(df, fitted, out="mapped"), 6).checkpoint()
    asked = F.col("vec_id") % 20 == 0
    share = {c: nm.kept_neighbours(both, "vec_id", "embedding", c, 15, asked).first().kept for c in ("mapped", "reduced")}
    print(share)
    assert share["mapped"] > share["reduced"] + 0.05
    rows = both.orderBy("vec_id").collect()
    got = brute_kept(np.array([r.embedding for r in rows]), np.array([r.mapped for r in rows]), 15, np.arange(0, 4000, 20))
    assert abs(got - share["mapped"]) < 1e-3
    # The same among rows that were not there when the map was fitted.
    new = curved(800, seed=5)
    new /= np.linalg.norm(new, axis=1, keepdims=True)
    _, _, axes = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    asked = np.arange(0, 800, 4)
    unseen = [brute_kept(new, small, 15, asked) for small in (fitted.place(new), new @ axes[:6].T)]
    print(unseen)
    assert unseen[0] > unseen[1] + 0.05


def test_same_places_and_copies(spark):
    x = np.vstack([curved(60), np.tile(curved(1, 3), (90, 1))])
    df = frame(spark, x).unionByName(spark.createDataFrame([(900, None), (901, [0.0] * 64)], "vec_id long, embedding array<float>"))
    df = df.withColumn("near", F.lit("mine"))
    a, b = (nm.reduce_by_neighbours(part, "vec_id", 5).orderBy("vec_id").collect() for part in (df, df.repartition(7)))
    assert [r.vec_id for r in a] == [*range(150), 900, 901] and {r.near for r in a} == {"mine"}
    assert a[150].reduced is None and len(a[151].reduced) == 5
    assert len({tuple(r.reduced) for r in a[60:150]}) == 1
    for r, s in zip(a, b):
        assert r.reduced is None and s.reduced is None or np.allclose(r.reduced, s.reduced, atol=1e-9)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_few_rows(spark, n):
    rows = nm.reduce_by_neighbours(frame(spark, curved(n)), "vec_id", 10).collect()
    assert len(rows) == n and all(len(r.reduced) == 10 and np.isfinite(r.reduced).all() for r in rows)


def test_no_vectors(spark):
    with pytest.raises(ValueError):
        nm.fit(frame(spark, np.zeros((0, 64))), "vec_id")
