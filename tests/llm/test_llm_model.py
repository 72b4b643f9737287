import math
import random
from collections import Counter

import numpy as np
import pytest

import brute
from llm_fixtures import documents, edges  # noqa: F401
from wardlight.llm import language_model as G


def corpus(n=150, seed=9):
    rng = random.Random(seed)
    follow = {w: rng.sample(range(60), 4) for w in range(60)}
    rows = []
    for doc in range(n):
        word, words = rng.randrange(60), []
        for _ in range(rng.randrange(1, 60)):
            words.append(f"W{word}" if rng.random() < 0.2 else f"w{word}")
            word = rng.choice(follow[word])
        rows.append((doc, " ".join(words)))
    return rows


def bigram_scores(rows, weights):
    """The mixture spelled out over lists, with the learned weights."""
    end, begin = "\n", "\t"
    word, pair = Counter(), Counter()
    for doc, text in rows:
        if doc is None or brute.fold(doc, 7) != 2:
            tokens = [begin, *brute.words(text, lower=True), end]
            word.update(tokens)
            pair.update(zip(tokens, tokens[1:]))
    n = sum(word.values()) - word[begin]
    v = len(word) - 1
    out = {}
    for doc, text in rows:
        tokens = [begin, *brute.words(text, lower=True), end]
        total = 0.0
        for a, b in zip(tokens, tokens[1:]):
            mix = weights[min(39, int(math.log2(word[a])) + 1) if word[a] else 0]
            total += math.log10(mix[0] * pair[a, b] / max(1, word[a]) + mix[1] * word[b] / n
                                + mix[2] * (word[b] + 1) / (n + v + 1))
        out[doc] = total
    return out


@pytest.mark.parametrize("chunk_tokens, range_tokens", [(1_000_000, 1 << 20), (300, 64)])
def test_scores_equal_the_spelled_out_mixture(spark, documents, edges, monkeypatch, chunk_tokens,
                                              range_tokens):
    monkeypatch.setattr(G, "RANGE_TOKENS", range_tokens)
    learned = []
    plain = G.learn_weights
    monkeypatch.setattr(G, "learn_weights", lambda *a: learned.append(plain(*a)) or learned[-1])
    rows = corpus() + [r[:2] for r in edges]
    got = {r.doc_id: r for r in G.score_documents(documents(*rows), chunk_tokens=chunk_tokens).collect()}
    base = brute.unigram_scores(rows)
    mixed = bigram_scores(rows, learned[0])
    for doc, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == base[doc][:4]
        assert r.base_score == pytest.approx(base[doc][4], rel=1e-9)
        assert r.score == pytest.approx(mixed[doc], rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def test_a_context_gives_a_distribution():
    totals = G.Totals(types=3, tokens=10, folded=0)
    weights = np.tile([0.5, 0.3, 0.2], (G._BUCKETS, 1))
    words, pairs = np.array([5, 3, 2, 0]), np.array([3, 1, 0, 0])
    chances = G.token_chances(words, np.full(4, 4), pairs, weights, totals)
    assert chances.sum() == pytest.approx(1.0)


def test_weights_follow_what_predicts(spark):
    totals = G.Totals(types=100, tokens=10_000, folded=0)
    words = np.full(2000, 5)
    good = G._fold_histogram(words, np.full(2000, 8), np.full(2000, 7), totals)
    bad = G._fold_histogram(words, np.full(2000, 8), np.zeros(2000, dtype=np.int64), totals)
    b = int(G.bucket_of(np.array([8]))[0])
    assert G.learn_weights(good[0], good[1], totals)[b][0] > 0.9
    assert G.learn_weights(bad[0], bad[1], totals)[b][0] < 0.01


def test_repeated_rows_nothing_to_learn_and_empty(spark, documents):
    one, two = [d for d in range(100) if brute.fold(d, 7) != 2][:2]
    rows = [(one, "a b a"), (one, "a b a"), (two, None)]
    got = G.score_documents(documents(*rows)).collect()
    assert len(got) == 3 and {r.train_tokens for r in got} == {9}
    held = next(d for d in range(100) if brute.fold(d, 7) == 2)
    alone = G.score_documents(documents((held, "a b"))).collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in alone] == [(0, 0, 0.0, 0.0)]
    assert G.score_documents(documents()).count() == 0


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = (files.apply(i) for i in range(files.size()))
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}


def test_shuffled_requests_do_not_wait_for_the_garbage_collector(spark, documents):
    """What stays are the shuffles of a few sums, a small part of what was asked and answered."""
    import time

    before = shuffle_files(spark)
    G.score_documents(documents(*corpus(1500)), chunk_tokens=1000)
    for _ in range(50):
        left = sum(n for name, n in shuffle_files(spark).items() if name not in before)
        if left < 10_000:
            break
        time.sleep(0.1)
    assert left < 10_000


def test_settling_alone_leaves_the_session_as_it_was(spark):
    from pyspark.sql import functions as F

    from wardlight import session

    rows = spark.range(3)
    held = spark.conf.get(session._CLEANUP, None)
    try:
        for value in ("false", "true"):
            spark.conf.set(session._CLEANUP, value)
            assert session.settled_alone(rows, "as-it-was").count() == 3
            with pytest.raises(Exception):
                session.settled_alone(rows.select(F.raise_error(F.lit("no"))), "as-it-was")
            assert spark.conf.get(session._CLEANUP) == value
    finally:
        spark.conf.unset(session._CLEANUP)
    session.settled_alone(rows, "as-it-was")
    assert spark.conf.get(session._CLEANUP, None) == held
