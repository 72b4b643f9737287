import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import brute
from wardlight.llm import search as S


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 9, 0) for i, v in rows],
                                 "vec_id bigint, embedding array<float>, lane int, score int")


def vectors(n, width, seed=6):
    rng = random.Random(seed)
    common = [float(np.float32(rng.gauss(0, 1))) for _ in range(width)]
    return [(i, common if rng.random() < 0.3 else [float(np.float32(rng.gauss(0, 1))) for _ in range(width)])
            for i in rng.sample(range(5 * n), n)]


@pytest.mark.parametrize("blocks", [(4096, 512), (16, 3)])
def test_equals_brute_force_with_ties(spark, monkeypatch, blocks):
    monkeypatch.setattr(S, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(S, "QUERY_ROWS", blocks[1])
    rows = vectors(400, 19)
    got = {tuple(r) for r in S.nearest_table(frame(spark, rows)).select(
        "query_id", "rank", "vec_id", "score").collect()}
    assert got == set(brute.top_products(rows))


def test_unusable_vectors_and_few_candidates(spark):
    rows = [(0, [1.0, 2.0]), (20, [0.5, -1.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 0.0]), (None, [1.0, 1.0]), (7, [3.0, 3.0]), (7, [3.0, 3.0])]
    got = sorted(map(tuple, S.nearest_table(frame(spark, rows)).select(
        "query_id", "rank", "vec_id", "score").collect()))
    assert got == sorted(brute.top_products(rows[:6] + rows[7:8]))
    assert S.nearest_table(frame(spark, [])).count() == 0
    assert S.nearest_table(frame(spark, [(0, [1.0])])).count() == 0


def test_shorter_vectors_count_as_zero_beyond_their_end(spark):
    rows = [(0, [1.0, 1.0, 5.0]), (1, [2.0]), (2, [])]
    got = {(r.vec_id, r.score) for r in S.nearest_table(frame(spark, rows)).collect()}
    assert got == {(1, 64 * 128), (2, 0)}


@given(st.integers(0, 10 ** 6), st.integers(1, 25), st.integers(1, 12))
@settings(deadline=None, max_examples=60)
def test_a_block_loses_nothing(seed, width, k):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 60))
    grid = rng.integers(-4, 5, (width, n)) * int(rng.choice([1, 1000, 10 ** 7]))
    query = rng.integers(-4, 5, width)
    best = S.Best(k)
    for part in np.array_split(np.arange(n), 3):
        block = S.Block(len(part), width, part.astype("<i8").tobytes(),
                        np.ascontiguousarray(grid[:, part]).tobytes(), step=4)
        block.search(query, -1, best)
    plain = sorted(zip((-(query @ grid)).tolist(), range(n)))[:k]
    assert list(zip((-best.scores).tolist(), best.keys.tolist())) == plain


@given(st.integers(0, 10 ** 6), st.sampled_from([1, 100, 30_000, 2 ** 31 - 1, 2 ** 40]))
@settings(deadline=None, max_examples=40)
def test_grids_are_narrowed_without_loss(seed, most):
    grid = np.random.default_rng(seed).integers(-most - 1, most + 1, (3, 5))
    small = S.narrowed(grid)
    assert (S.widened(small.tobytes(), small.itemsize, 3, 5) == grid).all()
    assert small.itemsize == min(b for b in (1, 2, 4, 8) if -2 ** (8 * b - 1) <= grid.min()
                                 and grid.max() < 2 ** (8 * b - 1))
