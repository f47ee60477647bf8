from __future__ import annotations

import hashlib
import math
import random

import numpy as np

from utxoflow.llm import centroids

SCHEMA = "vec_id bigint, embedding array<double>, label int, cluster int, n bigint, key string"


def model(rows, k=16, rounds=3, dims=64, seed=1):
    """Plain clustering of (id, vector) in Python integers."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        owned = {}
        for _, v in kept:
            owned.setdefault(nearest(v)[1], []).append(v)
        cents = [[sum(col) // len(owned[n]) for col in zip(*owned[n])] if n in owned else c for n, c in enumerate(cents)]
    out = [(i, *reversed(nearest(v))) for i, v in kept]
    inertia = {}
    for _, c, d in out:
        inertia[c] = inertia.get(c, 0) + d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest())
                   for i, c, d in out), key=str)


def got(frame):
    return sorted((tuple(r[c] for c in ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
                   for r in frame.collect()), key=str)


def random_rows(rng, n=400, dims=64):
    middles = [[rng.gauss(0, 0.4) for _ in range(dims)] for _ in range(9)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(middles)]) for i in range(n)]
    rows += [(1000 + i, list(rows[0][1])) for i in range(150)]  # a third is one vector
    rows += [(None, list(rows[1][1])), (7, list(rows[2][1])), (7, list(rows[7][1])), (7, list(rows[7][1]))]
    rows += [(2000, None), (2001, []), (2002, rows[0][1][:-1]), (2003, [None] + rows[0][1][1:]), (2004, [math.nan] + rows[0][1][1:]),
             (2005, [math.inf] + rows[0][1][1:]), (2006, [-math.inf] + rows[0][1][1:]), (2007, [0.0] * dims),
             (2008, [9000.5] + [0.25] * (dims - 1)), (2009, [-150000.0] + [2.0] * (dims - 1))]
    return rows


def test_against_plain_clustering(spark):
    rows = random_rows(random.Random(3))
    frame = spark.createDataFrame([(i, v, 0, 5, 1, "k") for i, v in rows], SCHEMA)
    want = model(rows)
    assert got(centroids.cluster(frame, block_rows=32)) == want
    assert got(centroids.cluster(frame.repartition(7), block_rows=7, partitions=3)) == want


def test_few_vectors_and_ties(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(9)]  # equal first centroids: ties go to the smaller number
    assert got(centroids.cluster(spark.createDataFrame([(i, v, 0, 0, 0, "") for i, v in rows], SCHEMA), block_rows=4)) == model(rows)
    one = [(5, [0.5] * 64)]
    assert got(centroids.cluster(spark.createDataFrame([(i, v, 0, 0, 0, "") for i, v in one], SCHEMA))) == model(one)
    none = centroids.cluster(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_candidates_hold_the_nearest():
    rng = np.random.default_rng(4)
    for _ in range(200):
        dims = int(rng.integers(1, 6))
        cents = rng.integers(-9, 9, (int(rng.integers(1, 12)), dims))
        v = rng.integers(-6, 6, dims) + rng.integers(0, int(rng.integers(1, 7)), (30, dims))
        left = centroids.candidates(v.min(axis=0), v.max(axis=0), cents)
        d = ((v[:, None, :] - cents[None]) ** 2).sum(axis=2)
        assert set(d.argmin(axis=1).tolist()) <= set(left.tolist()) and (np.diff(left) > 0).all()


def test_curve_visits_neighbours():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
        keys = centroids.hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        walk = grid[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_boxes_spare_comparisons(spark):
    rng = random.Random(8)
    rows = random_rows(rng, 2000)
    frame = spark.createDataFrame([(i, v, 0, 0, 0, "") for i, v in rows], SCHEMA)
    kept = centroids.integer_vectors(frame, "vec_id", "embedding", 64, 64)
    first = centroids.first_centroids(kept, 16, 1)
    blocks = centroids.build_blocks(kept, first, 64, 4)
    counts = [r["compared"] for r in centroids.summed(blocks, first).collect()]
    assert sum(counts) < 0.6 * 16 * kept.count()


def test_large_components():
    rng = np.random.default_rng(6)
    v, c = rng.integers(-(1 << 26), 1 << 26, (20, 64)), rng.integers(-(1 << 26), 1 << 26, (3, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c] for x in v]
    assert centroids.distances(v, c).tolist() == want
    assert centroids.distances(v >> 4, c >> 4).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c >> 4] for x in v >> 4]
