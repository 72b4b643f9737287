import random
from collections import Counter

import pytest

import brute
from llm_fixtures import documents, edges  # noqa: F401
from wardlight.llm import mixing as M


def corpus(n=700, seed=5):
    rng = random.Random(seed)
    sources = ["a", "B", "ä", "src10", "src9", None, "", "tiny"]
    rows = []
    for doc in range(n):
        source = "a" if rng.random() < 0.4 else rng.choice(sources[:-1])
        rows.append((doc, "w " * rng.choice([0, 1, 5, 30, 200]), "en", source))
    return rows + [(9000, "just three words", "en", "tiny")]


def sizes(rows):
    total = Counter()
    for _, text, _, source in rows:
        total[source] += len(brute.words(text))
    return dict(total)


def test_targets_and_taken_words(spark, documents, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_DOCS", 16)
    rows = corpus()
    total, source = sizes(rows), {r[0]: r[3] for r in rows}
    target = brute.targets(total)
    got = M.mix_table(documents(*rows)).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == total[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size and (r.taken % r.size == 0 if r.size else True)
        taken[source[r.doc_id]] += r.taken
    for name in total:
        # The last block holds some sixteen documents; what is left is smaller than most.
        assert abs(taken[name] - target[name]) <= 60, (name, taken[name], target[name])
    again = M.mix_table(documents(*reversed(rows)).repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_limits_are_reshared(spark, documents):
    rows = [(i, "w " * n, "en", s) for i, (s, n) in enumerate(
        [("a", 10), ("b", 1000), ("c", 3000), ("d", 20), ("e", 0)])]
    got = {r.doc_id: r.target for r in M.mix_table(documents(*rows)).collect()}
    want = brute.targets(sizes(rows))
    assert got == pytest.approx({i: want[r[3]] for i, r in enumerate(rows)})
    assert got[0] == 30 and got[3] == 60 and sum(got.values()) == pytest.approx(4030)


def test_mixture_repeats_rows_and_fills_shards(spark, documents, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_DOCS", 8)
    rows = corpus()
    frame = documents(*rows)
    want = {r.doc_id: r.taken // r.size for r in M.mix_table(frame).where("size > 0").collect()}
    mixed = M.mixture(frame, shards=8)
    assert mixed.columns == [*frame.columns, "mix_shard", "mix_place"]
    got = mixed.collect()
    assert Counter(r.doc_id for r in got) == Counter({d: n for d, n in want.items() if n})
    shards = Counter(r.mix_shard for r in got)
    assert len(shards) == 8 and max(shards.values()) < 3 * min(shards.values())
    plain = M.mixed_documents(frame)
    assert plain.columns == frame.columns
    assert Counter(r.doc_id for r in plain.collect()) == Counter(r.doc_id for r in got)


def test_queries_take_what_the_tree_deals(spark, documents, monkeypatch):
    """Units that the tree does not deal are not taken, and shards stand together, shuffled."""
    monkeypatch.setattr(M, "BLOCK_DOCS", 8)
    frame = documents(*corpus())
    table = {r.doc_id: r for r in M.mix_table(frame, shards=8).collect()}
    placed = sorted((s, p, d) for d, r in table.items() for s, p in zip(r.shards, r.places))
    assert all(r.taken == r.size * len(r.shards) for r in table.values())
    want = M.mixture(frame, shards=8).collect()
    assert placed == sorted((r.mix_shard, r.mix_place, r.doc_id) for r in want)
    at = {(d, p): s for s, p, d in placed}
    assert len({s for s, _, _ in placed}) == 8 and len(at) == len(placed)
    order = [[r.doc_id for r in part] for part in
             M.mixed_documents(frame, shards=8).rdd.glom().collect()]
    by_shard = {s: [d for t, _, d in placed if t == s] for s in range(8)}
    for part in filter(None, order):
        while part:
            shard = next(s for s, docs in by_shard.items() if docs and part[:len(docs)] == docs)
            part = part[len(by_shard.pop(shard)):]
    assert not by_shard
    whole = M.splitting_tree
    monkeypatch.setattr(M, "splitting_tree", lambda *a: whole(*a).where("shard < 0"))
    assert not M.mixed_documents(frame, shards=8).count()
    assert not any(r.taken for r in M.mix_table(frame, shards=8).collect())


def test_room_behind_a_long_document_is_filled(spark, documents, monkeypatch):
    """The source ends only when none of its documents fits any more."""
    monkeypatch.setattr(M, "BLOCK_DOCS", 16)
    rows = [(i, "w " * 30, "en", "a") for i in range(64)]
    rows += [(100 + i, "w " * (2500 + i), "en", "a") for i in range(2)]
    rows += [(200, "w " * 1000, "en", "b")]
    for seed in (8, 9, 10):
        table = M.mix_table(documents(*rows), weights=(1, 2), seed=seed)
        got = [r for r in table.collect() if r.doc_id < 200]
        room = got[0].target - sum(r.taken for r in got)
        assert room >= 0 and not [r for r in got if not r.taken and r.size <= room], (seed, room)


def test_splitting_tree_is_exact_and_spread(spark):
    quotas = {"a": 5000, "b": 40, "c": 1, None: 333, "none": 0}
    frame = spark.createDataFrame(list(quotas.items()), "mix_source string, units bigint")
    leaves = M.splitting_tree(frame, 16, seed=3).collect()
    by_source, by_shard = Counter(), Counter()
    for r in leaves:
        assert r.units > 0
        by_source[r.mix_source] += r.units
        by_shard[r.shard] += r.units
    assert by_source == {s: n for s, n in quotas.items() if n}
    assert max(by_shard.values()) - min(by_shard.values()) <= 4 and len(by_shard) == 16
    shares = [r.units for r in leaves if r.mix_source == "a"]
    assert max(shares) < 1.3 * min(shares) and len(set(shares)) > 4


def test_edges(spark, documents, edges):
    got = {r.doc_id: r for r in M.mix_table(documents(*edges)).collect()}
    assert got[900].size == got[901].size == got[902].size == 0 and got[900].taken == 0
    assert M.mix_table(documents()).count() == 0
    assert M.mix_table(documents((1, None, "en", "a"), (2, "", "en", None))).collect()[0].target == 0.0
    same = M.mix_table(documents(*[(1, "two words", "en", "a")] * 40)).collect()
    assert len(same) == 40 and sum(r.taken for r in same) == 80


@pytest.mark.parametrize("mine,others,room", [(3000, 5000, 4000), (40, 9000, 4500), (5000, 3, 2501), (7, 5, 6),
                                              (200_000, 1_000_000, 600_000)])
def test_draws_follow_the_hypergeometric_law(spark, mine, others, room):
    """A chi-square test in cells of at least a twentieth, at small and large counts alike."""
    from math import lgamma, exp

    from pyspark.sql import functions as F

    n = 4000
    rows = spark.range(n).select("id", *(F.lit(v).cast("bigint").alias(k) for k, v in (
        ("mine", mine), ("others", others), ("room", room))))
    drawn = [r[0] for r in rows.select(M._hypergeometric(
        F.col("mine"), F.col("others"), F.col("room"), F.lit(3), F.col("id"))).collect()]
    low, high = max(0, room - others), min(mine, room)
    assert low <= min(drawn) and max(drawn) <= high

    def choose(a, b):
        return lgamma(a + 1) - lgamma(b + 1) - lgamma(a - b + 1)

    cells, share, edges = [], 0.0, [low]
    for k in range(low, high + 1):
        share += exp(choose(mine, k) + choose(others, room - k) - choose(mine + others, room))
        if share >= 0.05:
            cells.append(share)
            edges.append(k + 1)
            share = 0.0
    cells[-1] += share
    edges[-1] = high + 1
    assert abs(sum(cells) - 1) < 1e-4
    seen = [sum(a <= x < b for x in drawn) for a, b in zip(edges[:-1], edges[1:])]
    chi = sum((s - n * p) ** 2 / (n * p) for s, p in zip(seen, cells))
    # Mean and variance of a chi-square with so many cells; five deviations.
    assert chi <= (len(cells) - 1) + 5 * (2 * max(1, len(cells) - 1)) ** 0.5, (chi, len(cells))


def test_shards_follow_the_size_and_names_may_clash(spark, documents, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(M, "BLOCK_DOCS", 8)
    monkeypatch.setattr(M, "SHARD_WORDS", 2000)
    rows = corpus()
    words = sum(sizes(rows).values())
    frame = documents(*rows).withColumns({"mix_shard": F.lit("mine"), "mix_row": F.lit(1), "deal": F.lit(2)})
    mixed = M.mixture(frame)
    assert mixed.columns == [c for c in frame.columns if c != "mix_shard"] + ["mix_shard", "mix_place"]
    shards = {r.mix_shard for r in mixed.select("mix_shard").distinct().collect()}
    assert len(shards) == 1 << (words // 2000).bit_length()
    whole = M.mixed_documents(frame)
    assert whole.columns == frame.columns and {r.mix_shard for r in whole.select("mix_shard").distinct().collect()} == {"mine"}
