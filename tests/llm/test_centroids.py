"""Centroid clustering against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, distance string"


def brute(rows, k, rounds, dims):
    kept = [(i, tuple(max(-centroids.WIDE, min(centroids.WIDE, math.floor(64 * float(x))))
                      for x in v)) for i, v in rows
            if v is not None and len(v) == dims
            and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(
        f"1:{r[0]}".encode()).hexdigest(), r[1]))
    now = [v for _, v in order[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for last in range(rounds + 1):
        near = [min((square(v, c), j) for j, c in enumerate(now)) for _, v in kept]
        if last < rounds:
            for j in range(len(now)):
                mine = [v for (_, v), (_, w) in zip(kept, near) if w == j]
                if mine:
                    now[j] = tuple(sum(col) // len(mine) for col in zip(*mine))
    per = {j: sum(d for d, w in near if w == j) for _, j in near}
    short = lambda n: n if n < 1 << 63 else None
    unseen = {j for d, j in near if short(d) is None}
    total = None if unseen else short(sum(per.values()))
    return sorted(((i, j, short(d), None if j in unseen else short(per[j]), total,
                    hashlib.sha256(",".join(map(str, now[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, near)), key=repr)


def got(spark, rows, **args):
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, centroids.cluster(frame, **args).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_brute_force(spark, seed):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 2) for _ in range(8)] for _ in range(5)]
    rows = [(i, [float(np.float32(m + rng.gauss(0, 0.3))) for m in middles[i % 5]])
            for i in range(300)]
    rows += rows[:40] + [(900, rows[0][1])] * 30  # repeated rows and copies
    rows += [(1000, None), (1001, []), (1002, [1.0] * 7), (1003, [None] * 8),
             (1004, [float("nan")] * 8), (1005, [float("inf")] + [0.0] * 7), (None, [0.5] * 8)]
    assert got(spark, rows, k=6, dims=8) == brute(rows, 6, 3, 8)
    assert got(spark, rows, k=6, dims=8, leading=2) == brute(rows, 6, 3, 8)


def test_ties_few_vectors_and_empty_table(spark):
    grid = [(i, [float(i % 3), float(i // 3 % 3)]) for i in range(27)]
    assert got(spark, grid, k=5, dims=2) == brute(grid, 5, 3, 2)
    assert got(spark, grid[:3], k=16, dims=2) == brute(grid[:3], 16, 3, 2)
    assert got(spark, [], k=16) == []
    assert got(spark, [(1, [1.0, 2.0])]) == []  # no vector of 64 components


def test_values_beyond_64_bits_stay_exact(spark):
    rows = [(i, [float(np.float32(v)), float(i)]) for i, v in
            enumerate([0, 1, 2.5e6, 3e6, -4e7, 3e17, 3e38, -3e38, 1, 2])]
    assert got(spark, rows, k=4, dims=2) == brute(rows, 4, 3, 2)


def test_bounds_spare_most_distances(spark):
    rng = np.random.default_rng(5)
    x = np.floor(64 * (rng.normal(size=(16, 64))[np.arange(2000) % 16]
                       + rng.normal(size=(2000, 64)) / 10)).astype(np.int64)
    mean = x.mean(0)
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1]
    now = centroids.Centroids(x[:16].tolist(), mean, axes, centroids.LEADING)
    who, far = now.nearest(x, *centroids._rotated(x, mean, axes, centroids.LEADING))
    full = ((x[:, None] - x[None, :16]) ** 2).sum(2)
    assert (who == full.argmin(1)).all() and far.tolist() == full.min(1).tolist()
    assert now.verified < 2 * len(x)


def test_no_vector_is_shuffled(spark, sf_dir):
    whole = centroids.integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    assert whole.filter(F.size("v") != 64).count() == 0
