import random
import re
from collections import Counter, defaultdict

import pytest

from llm_fixtures import documents, edges  # noqa: F401
from wardlight.llm import divergence as D


def plain(rows, least=10, ranks=10):
    """Every kept term against every group, in Python integers."""
    n, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        n[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in langs.items():
        kept = [t for t, c in docs[lang].items() if c >= least]
        whole = Counter()
        for s in sources:
            whole.update({t: n[lang, s][t] for t in kept})

        def share(counts):
            below = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // below for t in kept}

        def value(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = {s: share(n[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pair = [(-sum(value(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources - {s}]
            term = [(-value(p[s][t], q[t]), t.encode()) for t in kept
                    if n[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:ranks])):
                out |= {(lang, s, part, i.decode(), -v, r + 1) for r, (v, i) in enumerate(found)}
    return out


def ours(frame, **more):
    rows = [tuple(r) for r in D.divergence(frame, **more).select(
        "lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(n, seed=2):
    rng = random.Random(seed)
    words = ["Über", "ÜBER", "über", "naïve", "日本", "Zeta", "zeta", "don't", "x1y"] + [f"w{c}" for c in "abcdefghijklmnop"]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None, "é"])
        some = rng.sample(words, 8) if source == "a" else words
        rows.append((i, " ".join(rng.choice(some) for _ in range(rng.randrange(30))),
                     rng.choice(["en", "de", None]), source))
    return rows


@pytest.mark.parametrize("limits", [(1 << 18, 200_000), (7, 5)])
def test_equals_plain_counts(documents, monkeypatch, limits):
    monkeypatch.setattr(D, "BLOCK_ROWS", limits[0])
    monkeypatch.setattr(D, "HELD_TERMS", limits[1])
    rows = corpus(240)
    assert ours(documents(*rows)) == plain(rows)


def test_ties_end_at_the_rank_in_utf8_order(documents):
    # 14 terms with equal counts: ten of them, smallest bytes first, astral after the rest.
    terms = [f"t{c}" for c in "abcdefghij"] + ["\U0001f600", "￮", "é", "z"]
    rows = [(i, " ".join(terms), "en", "one") for i in range(12)]
    rows += [(50 + i, "other words", "en", "two") for i in range(12)]
    assert ours(documents(*rows)) == plain(rows)
    ranked = sorted((r[5], r[3]) for r in plain(rows) if r[1] == "one" and r[2] == "term")
    assert [t for _, t in ranked] == [f"t{c}" for c in "abcdefghij"]


def test_groups_without_kept_terms(documents):
    rows = [(i, f"only{chr(97 + i)}", "xx", s) for i, s in enumerate("abc")]
    rows += [(20 + i, "shared word", "en", "a") for i in range(10)] + [(40, None, "en", "b"), (41, "!!", "en", "c")]
    got = ours(documents(*rows))
    assert got == plain(rows)
    assert {r[4] for r in got if r[0] == "xx"} == {0} and {r[1] for r in got if r[0] == "en"} == {"a", "b", "c"}


def test_edge_rows_repeats_and_empty_table(documents, edges):
    rows = [r if len(r) == 4 else (*r, "en", "a") for r in edges]
    assert ours(documents(*rows), least_docs=1) == plain(rows, least=1)
    assert ours(documents(*rows, *rows), least_docs=2) == plain(rows + rows, least=2)
    assert ours(documents()) == set()


def test_a_long_text_is_cut_between_terms_and_is_one_document(documents, monkeypatch):
    monkeypatch.setattr(D, "sections", lambda data: __import__(
        "wardlight.llm.words", fromlist=["sections"]).sections(data, 50))
    rows = [(i, " ".join(["alpha", "beta"] * 200), "en", "ab"[i % 2]) for i in range(9)]
    assert ours(documents(*rows)) == plain(rows)
    rows.append((10, "beta", "en", "a"))
    assert ours(documents(*rows)) == plain(rows)


def test_counts_beyond_63_bits_of_product(spark):
    """Shares of counts whose product with the scale leaves 64 bits."""
    from pyspark.sql import functions as F

    big = 10 ** 15
    frame = spark.createDataFrame([(big, 3 * big, 7)], "c bigint, t bigint, v bigint")
    got = frame.select(D._share(F.col("c"), F.col("t"), F.col("v"))).first()[0]
    assert got == 1 + 10 ** 9 * (big + 2) // (3 * big + 14)
