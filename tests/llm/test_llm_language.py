import random

import brute
from llm_fixtures import documents, edges  # noqa: F401
from wardlight.llm import language as L

SYLLABLES = {"en": "the and tion ing er st wh ha", "de": "der und ung sch ein ß ü ver",
             "fr": "le et eau ou que é è ment", "es": "el ción de os ado ñ í la"}


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for doc in range(n):
        lang = rng.choice(list(SYLLABLES))
        parts = SYLLABLES[lang].split()
        words = ["".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))]
        rows.append((doc, " ".join(words), lang, "a"))
    return rows


def test_held_out_accuracy_and_folds(spark, documents):
    rows = corpus(400)
    got = {r.doc_id: r for r in L.language_table(documents(*rows)).collect()}
    held = [r for r in rows if brute.fold(r[0], 3) == 1]
    assert len(got) == 400 and {d for d, r in got.items() if r.held_out} == {r[0] for r in held}
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_are_never_read(spark, documents):
    rows = corpus(120)
    wrong = [(d, t, "xx" if brute.fold(d, 3) == 1 else lang, s) for d, t, lang, s in rows]
    first = sorted(map(tuple, L.language_table(documents(*rows)).collect()))
    assert first == sorted(map(tuple, L.language_table(documents(*wrong)).collect()))


def test_edges(spark, documents, edges):
    rows = corpus(60) + [(800, "12 34 !! 5", "en", "a"), (801, "zz " * 200_000, "en", "a")]
    got = {r.doc_id: r for r in L.language_table(documents(*rows, *edges)).collect()}
    for doc in (900, 901, 902, 905, 800):
        assert (got[doc].lang_pred, got[doc].score) == ("und", 0.0)
    assert got[None].held_out is False and got[801].lang_pred in SYLLABLES
    assert L.language_table(documents()).count() == 0


def test_nothing_or_one_language_to_learn(spark, documents):
    got = L.language_table(documents((1, "some words", None, "a"), (2, None, "en", "a"))).collect()
    assert {r.lang_pred for r in got} == {"und"}
    one = L.language_table(documents((1, "some words", "en", "a"), (3, "more of them", "en", "a")))
    assert {(r.lang_pred, r.score) for r in one.collect()} == {("en", 1.0)}


def test_families_come_first():
    assert L.family_of("de") == L.family_of("en-GB") == "germanic" and L.family_of("ro") == "romance"
    assert L.family_of("tlh") != L.family_of("qya")


def plain_predict(model, text):
    """The prediction once more, letter by letter and machine by machine."""
    import math
    from itertools import combinations

    import numpy as np

    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    letters = " "
    for c in text.lower():
        letters += c if c.isalpha() else "" if letters[-1] == " " else " "
    counts = {}
    for order in L.ORDERS:
        for at in range(len(letters) - order + 1):
            gram = [np.array([ord(c)], dtype=np.uint64) for c in letters[at:at + order]]
            bucket = int(L.joined(*gram, np.array([order]))[0]) >> (64 - L.WIDTH.bit_length() + 1)
            counts[bucket] = counts.get(bucket, 0) + 1
    # A run of one letter begins behind the space that opens the text.
    first = int(L.joined(np.array([32], dtype=np.uint64), np.array([1]))[0]) >> (64 - L.WIDTH.bit_length() + 1)
    counts[first] -= 1
    total, score, machines = sum(counts.values()), 1.0, model.families
    while True:
        names = machines.names
        sums = [0.0] * len(names)
        for at, (a, b) in enumerate(combinations(range(len(names)), 2)):
            margin = float(machines.biases[at]) + sum(
                n * L._SCALE / total * float(machines.weights[bucket, at]) for bucket, n in counts.items())
            sums[a] += margin
            sums[b] -= margin
        chances = [math.exp(max(-60, 2 * (x - max(sums)) / max(1, len(names) - 1))) for x in sums]
        best = chances.index(max(chances))
        score *= chances[best] / sum(chances)
        if machines is not model.families:
            return names[best], score
        machines = model.within[names[best]]


def test_predictions_equal_plain_ones_and_repeats_agree(spark, documents):
    rows = corpus(150) + [(700, "", "en", "a"), (701, "  ?! ", "en", "a"), (702, "Ünïted WÖRDS 3 und the", None, "a"),
                          (3, "the ingst er"), (3, "the ingst er")]
    frame = documents(*rows)
    model = L.fit_languages(frame.where(~L.held_out(frame.doc_id, 3, 1)))
    got = [(r.text, r.found.lang_pred, r.found.score) for r in frame.withColumn(
        "found", L.language_of(frame.text, model)).collect()]
    for text, lang, score in got:
        want, chance = plain_predict(model, text)
        assert lang == want and abs(score - chance) <= 1e-3, text
    assert len({g for g in got if g[0] == "the ingst er"}) == 1


def test_many_unlisted_labels(spark, documents):
    """Two hundred labels outside the table: few machines, learned within a minute, told apart."""
    import time

    rng = random.Random(8)
    rows, alphabet = [], "abcdefghijklmnopqrstuvwxyz"
    for n in range(200):
        parts = ["".join(rng.choices(alphabet, k=3)) for _ in range(6)]
        rows += [(1000 * n + i, " ".join("".join(rng.choices(parts, k=2)) for _ in range(25)), f"x{n:03d}", "a")
                 for i in range(15)]
    frame = documents(*rows)
    started = time.perf_counter()
    model = L.fit_languages(frame)
    assert time.perf_counter() - started < 60
    assert len(model.families.names) == 25 and all(len(m.names) <= 8 for m in model.within.values())
    some = rng.sample(rows, 200)
    assert sum(model.predict(r[1])[0] == r[2] for r in some) >= 150


def test_sections_make_the_same_buckets(monkeypatch):
    text = "Ein Wort, und noch 3 Wörter! " * 30
    whole = sorted(b for part in L.letter_buckets(text) for b in part.tolist())
    monkeypatch.setattr(L, "_CHARS", 7)
    assert sorted(b for part in L.letter_buckets(text) for b in part.tolist()) == whole
