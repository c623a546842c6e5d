from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import kmeans

SCHEMA = "vec_id long, embedding array<double>"


def plain_clusters(rows, k, rounds, width=64, scale=256, seed=2):
    """Lloyd's rounds in Python integers."""
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    away = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    nearest = lambda v: min(range(len(centroids)), key=lambda j: (away(v, centroids[j]), j))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v), []).append(v)
        for j, own in groups.items():
            centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, j := nearest(v), away(v, centroids[j])) for i, v in kept]
    per = {}
    for _, j, d in found:
        per[j] = per.get(j, 0) + d
    total = sum(per.values())
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return [(i, j, d, per[j], total, digest(centroids[j])) for i, j, d in found]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made(n, width, seed, centres=6):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(centres)]
    return [(i, [m + rng.gauss(0, 0.3) for m in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_plain_lloyd(spark, seed):
    rows = made(400, 8, seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = kmeans.clusters(df, k=9, rounds=5, width=8)
    assert rows_of(out) == sorted(plain_clusters(rows, 9, 5, 8), key=repr)


def test_ties_repeats_and_odd_rows(spark):
    rows = [(i % 7, [float(i % 3), float(i % 2)]) for i in range(40)]  # many equal distances
    rows += [(None, [0.5, 0.5]), (50, None), (51, []), (52, [1.0]), (53, [1.0, None]), (54, [float("nan"), 1.0]),
             (55, [float("inf"), 0.0]), (56, [-0.001, -3.7])]
    df = spark.createDataFrame(rows, SCHEMA).select(
        "*", *(F.lit(1).alias(c) for c in ["id", "v", "cluster", "upper", "lower", "distance"])
    )
    out = kmeans.clusters(df, k=4, rounds=3, width=2)
    assert rows_of(out) == sorted(plain_clusters(rows, 4, 3, 2), key=repr)
    few = df.where("vec_id = 56")
    assert rows_of(kmeans.clusters(few, k=4, width=2)) == sorted(plain_clusters(rows[-1:], 4, 5, 2), key=repr)
    assert kmeans.clusters(df.where("vec_id = 54"), width=2).count() == 0
    assert kmeans.clusters(df.limit(0), width=2).columns == out.columns


def test_large_components_stay_exact(spark):
    rows = [(i, [1e6 * (i % 5) + i, -1e6 * (i % 3)]) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = kmeans.clusters(df, k=5, rounds=4, width=2)
    assert rows_of(out) == sorted(plain_clusters(rows, 5, 4, 2), key=repr)


def test_bounds_spare_most_distances_and_change_nothing():
    points = np.array([[math.floor(256 * x) for x in v] for _, v in made(3000, 16, 3, 12)])
    centroids = points[:12].copy()
    rounds, n = [centroids], len(points)
    every = np.stack([kmeans.squared(points, c) for c in centroids], axis=1)
    lower, cluster = np.sqrt(every), every.argmin(1)
    upper = lower[np.arange(n), cluster]
    state = cluster, upper, np.zeros(n, int), lower, np.zeros(lower.shape, int)
    computed = []
    for _ in range(8):
        rounds.append(np.array([
            points[state[0] == j].sum(0) // max(1, (state[0] == j).sum()) if (state[0] == j).any() else c
            for j, c in enumerate(rounds[-1])
        ]))
        *state, evaluated = kmeans.History(rounds).assign(points, *state)
        exact = np.stack([kmeans.squared(points, c) for c in rounds[-1]], axis=1)
        assert (state[0] == exact.argmin(1)).all()
        computed.append(evaluated)
    assert computed[-1] < n * 12 / 10  # a tenth of what a full scan computes


def test_displacement_since_is_at_most_the_sum_of_moves():
    rng = np.random.default_rng(5)
    rounds = [rng.integers(-50, 50, (3, 4)) for _ in range(6)]
    history = kmeans.History(rounds)
    for t in range(6):
        drift = sum(np.linalg.norm(b - a, axis=1) for a, b in zip(rounds[t:], rounds[t + 1 :]))
        assert (history.moved[t] <= drift + 1e-6).all()
