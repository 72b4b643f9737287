import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from wardlight.llm import clustering as C

WIDTH = 6


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in rows],
                                 "vec_id bigint, embedding array<float>, cluster int, distance int, place double")


def plain(rows, k=8, rounds=10, width=WIDTH):
    """The same clusters by meeting every centroid, in Python integers."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    mark = {i: hashlib.sha256(f"3:{i}".encode()).hexdigest() for i, _ in kept if i is not None}
    starts = sorted(kept, key=lambda r: (r[0] is None, mark.get(r[0], ""), r[1]))[:k]
    points = [v for _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        mine = [nearest(v)[1] for _, v in kept]
        for c in range(len(points)):
            members = [v for (_, v), m in zip(kept, mine) if m == c]
            if members:
                points[c] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {c: sum(d for _, d, m in found if m == c) for c in range(len(points))}
    return sorted(repr((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(
        ",".join(map(str, points[c])).encode()).hexdigest())) for i, d, c in found)


def ours(spark, rows, **more):
    got = C.cluster_table(frame(spark, rows), width=WIDTH, **more).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(repr(tuple(r)) for r in got.collect())


def vectors(n, seed=1, spread=1.0):
    rng = random.Random(seed)
    heart = [[rng.gauss(0, 3) for _ in range(WIDTH)] for _ in range(5)]
    return [(i, [float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(heart)])
            for i in rng.sample(range(4 * n), n)]


def test_equals_meeting_every_centroid(spark):
    rows = vectors(500)
    assert ours(spark, rows) == plain(rows)


def test_a_third_of_all_rows_alike_and_ties(spark):
    rows = vectors(200) + [(10_000 + i, [1.0] * WIDTH) for i in range(100)]
    rows += [(20_000 + i, [float(s)] * WIDTH) for i, s in enumerate((-2, -1, 0, 1, 2) * 8)]
    assert ours(spark, rows) == plain(rows)


def test_repeats_nulls_and_unusable_vectors(spark):
    rows = vectors(30) + [(1, None), (2, [1.0, None] * 3), (3, [float("nan")] * WIDTH), (4, [1.0]),
                          (5, [float("-inf")] * WIDTH), (None, [0.5] * WIDTH), (6, []), (7, [2.0] * WIDTH),
                          (7, [2.0] * WIDTH), (7, [-2.0] * WIDTH)]
    assert ours(spark, rows) == plain(rows)


@pytest.mark.parametrize("n", [1, 3])
def test_fewer_vectors_than_centroids(spark, n):
    rows = vectors(n)
    assert ours(spark, rows) == plain(rows)


def test_empty_table(spark):
    got = C.cluster_table(frame(spark, []), width=WIDTH)
    assert got.count() == 0 and "centroid_sha256" in got.columns


def test_far_away_components_stay_exact(spark):
    rows = [(i, [float(np.float32(x + 3e9)) for x in v]) for i, v in vectors(40, spread=300.0)]
    assert ours(spark, rows, rounds=3) == plain(rows, rounds=3)


def test_too_long_distances_fail_instead_of_wrapping(spark):
    rows = [(0, [1e9] * WIDTH), (1, [-1e9] * WIDTH)]
    with pytest.raises(Exception):
        C.cluster_table(frame(spark, rows), width=WIDTH, k=1).collect()


@given(st.integers(0, 10 ** 6))
@settings(deadline=None, max_examples=60)
def test_bounds_lose_no_centroid_and_spare_distances(seed):
    rng = np.random.default_rng(seed)
    heart = rng.integers(-10 ** 5, 10 ** 5, (8, 5))
    rows = heart[rng.integers(0, 8, 300)] + rng.integers(-50, 50, (300, 5)) * int(rng.choice([0, 1, 1000]))
    pivots = [list(map(int, p)) for p in heart]
    points = [list(map(int, p)) for p in heart + rng.integers(-20, 20, heart.shape)]
    stored = np.stack([C.squared_distances(rows, p) for p in heart], axis=1)
    cluster, best, met = C.Centroids(points, pivots).nearest(rows, stored)
    every = np.stack([C.squared_distances(rows, np.array(p)) for p in points], axis=1)
    assert (cluster == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert met <= every.size


def test_near_centroids_need_few_distances():
    rng = np.random.default_rng(3)
    heart = rng.integers(-10 ** 6, 10 ** 6, (8, 20))
    rows = heart[rng.integers(0, 8, 1000)] + rng.integers(-50, 50, (1000, 20))
    stored = np.stack([C.squared_distances(rows, p) for p in heart], axis=1)
    _, _, met = C.Centroids(heart.tolist(), heart.tolist()).nearest(rows, stored)
    assert met < 1.1 * len(rows)
