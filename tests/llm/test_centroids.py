import hashlib
import math
import random

import numpy as np
import pytest

from recordloom.llm import centroids as c


def brute(rows, clusters=16, rounds=3):
    kept = []
    for vec, x in rows:
        if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec, [math.floor(64 * max(-(2**24) / 64, min(2**24 / 64, v))) for v in x]))
    mark = lambda vec: hashlib.sha256(f"1:{'' if vec is None else vec}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, w)), i) for i, w in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [
            [sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else w for i, w in enumerate(centres)
        ]
    best = [(vec, *near(v)) for vec, v in kept]
    sums = {}
    for _, d, i in best:
        sums[i] = sums.get(i, 0) + d
    sha = lambda w: hashlib.sha256(",".join(map(str, w)).encode()).hexdigest()
    top = 2**63 - 1
    return sorted(
        ((vec, i, d, min(sums[i], top), min(sum(sums.values()), top), sha(centres[i])) for vec, d, i in best), key=repr
    )


def run(spark, rows):
    table = spark.createDataFrame([(i, x, 5, "x") for i, x in rows], "vec_id long, embedding array<double>, cluster int, parts string")
    made = c.centroid_digests(c.cluster_vectors(table.repartition(3)))
    assert made.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in made.collect()), key=repr)


def vectors(n, seed=1, spread=1.0):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(5, 64))
    return [(i, (centres[i % 5] + spread * rnd.normal(size=64)).tolist()) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 7, 16, 300])
def test_agrees_with_all_distances(spark, n):
    rows = vectors(n)
    assert run(spark, rows) == brute(rows)


def test_ties_repeats_and_unfit_vectors(spark):
    rnd = random.Random(2)
    grid = [(i, [rnd.choice([0.0, 1 / 64]) for _ in range(64)]) for i in range(60)]
    zero = [0.0] * 64
    unfit = [(70, None), (71, []), (72, zero[1:]), (73, [*zero, 0.0]), (74, [None, *zero[1:]])]
    unfit += [(75, [float("nan"), *zero[1:]]), (76, [float("inf"), *zero[1:]]), (77, [float("-inf"), *zero[1:]])]
    rows = grid + unfit + [(80, zero), (80, zero), (None, zero), (None, grid[3][1])] + [(100 + i, zero) for i in range(30)]
    assert run(spark, rows) == brute(rows)


def test_huge_components(spark):
    rows = vectors(40) + [(90, [1e300] * 64), (91, [-1e300] * 64), (92, [3e5, -3e5] * 32)]
    assert run(spark, rows) == brute(rows)


def test_transform_is_exact_and_keeps_distances():
    x = np.random.default_rng(3).integers(-(2**24), 2**24, (50, 64))
    h = c.transform(x)
    assert (c.transform(h) == 64 * x).all()
    d = x[:25] - x[25:]
    assert ((h[:25] - h[25:]) ** 2).sum(axis=1).tolist() == (64 * (d**2).sum(axis=1)).tolist()


@pytest.mark.parametrize("steps", [(0, 64), (0, 4, 16, 64), (0, 1, 2, 4, 8, 16, 32, 64)])
def test_search_keeps_the_first_of_equals(steps):
    rnd = np.random.default_rng(4)
    points, centres = rnd.integers(0, 2, (200, 64)), rnd.integers(0, 2, (9, 64))
    centres[7] = centres[2]
    d = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    cluster, distance = c.nearest(points, centres, steps)
    assert cluster.tolist() == d.argmin(axis=1).tolist() and distance.tolist() == d.min(axis=1).tolist()
