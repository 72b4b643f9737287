import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import brute
from llm_fixtures import documents, edges, prose  # noqa: F401
from wardlight.llm import parity_join as P
from wardlight.llm.graph import components


def answer(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


@given(st.integers(0, 10 ** 6), st.integers(1, 3000), st.sampled_from([80, 90, 95]))
@settings(deadline=None, max_examples=150)
def test_similar_sets_share_a_key_and_sketches_bound_the_difference(seed, size, percent):
    rng = np.random.default_rng(seed)
    whole = np.unique(rng.integers(0, 2 ** 63, 2 * size + 20, dtype=np.uint64))
    rng.shuffle(whole)
    a = whole[:size]
    # As different as the similarity still allows.
    for lost in {0, size * (100 - percent) // (100 + percent), size * (100 - percent) // 100}:
        gained = max(0, (100 * (size - lost) - percent * size) // percent)
        b = np.concatenate([a[lost:], whole[size:size + gained]])
        both = len(np.intersect1d(a, b))
        if 100 * both < percent * (len(a) + len(b) - both) or set(a) == set(b) or not len(b):
            continue
        x, y = np.sort(a), np.sort(b)
        assert set(P.part_keys(x, percent).tolist()) & set(P.part_keys(y, percent).tolist())
        for band in set(P.bands_of(len(x), percent)) & set(P.bands_of(len(y), percent)):
            apart = np.bitwise_count(P.part_sketches(x, band, percent)[0]
                                     ^ P.part_sketches(y, band, percent)[0]).sum()
            assert apart <= len(a) + len(b) - 2 * both
            short = np.bitwise_count(P.folded(P.part_sketches(x, band, percent)[0])
                                     ^ P.folded(P.part_sketches(y, band, percent)[0])).sum()
            assert short <= apart
            assert len(a) + len(b) - 2 * both <= P.most_apart(len(a), len(b), percent)


def corpus(prose):
    """Groups of copies and near copies, chains, and unrelated texts."""
    rng = random.Random(5)
    docs = []
    for group in range(6):
        text = prose(group, 60 + 150 * group)
        for _ in range(12):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10 ** 6)}"
            docs.append(" ".join(copy))
    walk = prose(99, 300)
    for step in range(12):
        walk = list(walk)
        walk[step * 20] = f"y{step}"
        walk[step * 20 + 7] = f"z{step}"
        docs.append(" ".join(walk).upper())
    docs += [" ".join(prose(1000 + i, i)) for i in range(25)]
    rng.shuffle(docs)
    return [(i * 3 + 1, text) for i, text in enumerate(docs)]


@pytest.mark.parametrize("percent,words", [(90, 3), (80, 5)])
def test_classes_equal_brute_force(spark, documents, prose, percent, words):
    rows = corpus(prose)
    got = answer(P.similarity_classes(documents(*rows), percent, words))
    assert got == brute.similar(rows, percent, words)


def test_classes_hold_without_reach(spark, documents, prose, monkeypatch):
    """Blocks of three members, one partner a round: more rounds, the same classes."""
    monkeypatch.setattr(P, "BLOCK", 3)
    monkeypatch.setattr(P, "REACH", (1, 2, 3))
    rows = corpus(prose)
    assert answer(P.similarity_classes(documents(*rows))) == brute.similar(rows)


def test_edges_and_repeated_rows(spark, documents, edges, prose):
    rows = [r for r in edges if r[0] is not None] + [(10, "One"), (11, "a b"), (12, "A  B"),
                                                     (13, "a b c"), (14, "b a")]
    rows += [(20, " ".join(prose(1, 100)))] * 3
    frame = P.similarity_classes(documents(*rows, (None, "one"), (None, "nowhere else at all")))
    got = answer(frame.where("doc_id is not null"))
    assert got == brute.similar([r[:2] for r in dict.fromkeys(rows)])
    assert frame.count() == len(rows) + 2
    assert sorted((r.n_shingles, r.component_id or -1) for r in
                  frame.where("doc_id is null").collect()) == [(1, 10), (2, -1)]


def test_empty_table(spark, documents):
    assert P.similarity_classes(documents()).count() == 0
    assert P.one_of_each(documents()).count() == 0


def test_one_of_each_keeps_columns(spark, documents, prose):
    rows = corpus(prose)
    kept = P.one_of_each(documents(*rows))
    assert kept.columns == documents().columns
    want = {d for d, (_, c) in brute.similar(rows).items() if d == c}
    assert {r.doc_id for r in kept.collect()} == want


def test_one_of_each_takes_any_column_name(spark, documents, prose):
    from pyspark.sql import functions as F

    frame = documents(*corpus(prose)).withColumns({"parity_gone": F.lit("own"), "parity_row": F.lit(3), "doc": F.lit(4)})
    kept = P.one_of_each(frame)
    assert kept.columns == frame.columns
    assert {(r.parity_gone, r.parity_row, r.doc) for r in kept.collect()} == {("own", 3, 4)}


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 80)]
    random.Random(1).shuffle(chain)
    roots = {r.node: r.root for r in
             components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert roots == {**{i: 1 for i in range(2, 41)}, 90: 80, 100: 80}


def test_no_link_is_lost_beyond_the_last_reach(spark, documents, prose, monkeypatch):
    """One passage in all texts, of which only 100 and 101 are linked: by the first words of their
    sketches others are nearer to 100, and they share no key that a smaller text does not have."""
    monkeypatch.setattr(P, "REACH", (1,))
    passage = prose(7, 200, 10 ** 6)
    tails = dict.fromkeys([*range(60), *range(200, 260)], 17) | {100: 9, 101: 9}
    rows = [(i, " ".join(passage + [f"s2t{i}x{k}" for k in range(n)])) for i, n in tails.items()]
    want = brute.similar(rows)
    assert len({c for _, c in want.values()}) == len(rows) - 1
    assert answer(P.similarity_classes(documents(*rows))) == want


@pytest.mark.parametrize("percent,words", [(90, 3), (80, 5)])
def test_unlinked_texts_of_one_passage_give_few_pairs(spark, documents, prose, monkeypatch, percent, words):
    """Candidates that leave a block grow with the texts, not with their pairs."""
    seen = []
    plain = P.linked_pairs
    monkeypatch.setattr(P, "linked_pairs", lambda pairs, *rest: (
        seen.append(pairs.count()), plain(pairs, *rest))[1])
    passage = prose(7, 200, 10 ** 6)
    tail = 40 if percent == 80 else 19

    def pairs(n):
        rows = [(i, " ".join(passage + [f"t{i}x{k}" for k in range(tail)])) for i in range(n)]
        got = answer(P.similarity_classes(documents(*rows), percent, words))
        assert {c for _, c in got.values()} == set(range(n))
        total = sum(seen)
        seen.clear()
        return total

    few, many = pairs(500), pairs(2000)
    assert many <= 6 * few and many <= 20 * 2000


def test_a_block_with_few_partners_on_average_is_left_whole():
    """One member meets all others, which differ among themselves: one round settles the block."""
    n = 9
    docs, block = np.arange(n), np.zeros(n, dtype=int)
    sketches = np.zeros((n, 8), dtype=np.uint64)
    sketches[1:] = (np.arange(1, n, dtype=np.uint64)[:, None] == np.arange(1, 9, dtype=np.uint64)) * np.uint64(0x7F)
    sizes = np.full(n, 100)
    args = (docs, docs, sizes, block, sketches, 0, 0, 90)
    assert P.near_in_block(*args, 1) == ([0] * 8, list(range(1, 9)), False)
    # Where all meet all, the nearest are left, and the rest is said to be missing.
    sketches[:] = 0
    a, b, cut = P.near_in_block(*args, 2)
    assert cut and len(a) == len(b) == 2 * (n - 2) + 1
    assert [len(P.near_in_block(*args, reach)[0]) for reach in (4, None)] == [36, 36]
