import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import brute
from llm_fixtures import documents, edges  # noqa: F401
from wardlight.llm import quality as Q

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@given(st.text(alphabet="ab \n\t#|é😀", max_size=80))
@settings(deadline=None)
def test_counts_equal_brute_force(text):
    got = Q.judged(None, text)
    assert {k: got[k] for k in COUNTS} == brute.quality_counts(text)
    assert got["kept"] is not got["base_failed"]


def prose(rng, n):
    return " ".join(rng.choice(["the", "and", "ting", "over", "stone", "river"]) + rng.choice("aeiou")
                    + rng.choice("lmnr") for _ in range(n))


def corpus(n=300, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for doc in range(n):
        good = rng.random() < 0.7
        text = prose(rng, rng.randrange(30, 200))
        if not good:
            text = text.upper().replace(" ", "!! ") if doc % 2 else text.replace(" ", "%%% ")
        rows.append((doc, text))
        labels.append((doc, int(good), 0))
    return rows, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_classifier_separates_and_is_calibrated(spark, documents):
    rows, labels = corpus()
    learned = labels_of(spark, labels[:200])
    got = {r.doc_id: r for r in Q.quality_table(documents(*rows), learned).collect()}
    unseen = labels[200:]
    assert sum(got[d].kept == bool(q) for d, q, _ in unseen) >= 0.97 * len(unseen)
    good = np.mean([got[d].quality for d, q, _ in unseen if q])
    bad = np.mean([got[d].quality for d, q, _ in unseen if not q])
    assert good > 0.9 and bad < 0.1
    kept = Q.good_documents(documents(*rows), learned)
    assert kept.columns == documents().columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, None, 0), (None, 1, 0), (2, 7, 0)]])
def test_without_two_classes_the_rules_decide(spark, documents, edges, labels):
    frame = documents((1, "eleven words " * 5 + "are"), (2, "too few words"), *edges)
    got = {r.doc_id: r for r in Q.quality_table(frame, labels_of(spark, labels)).collect()}
    assert all(r.quality is None and r.kept is not r.base_failed for r in got.values())
    assert got[900].n_words == got[901].n_words == 0 and got[900].base_failed


def test_repeated_rows_and_labels_and_empty_tables(spark, documents):
    rows, labels = corpus(80)
    frame = documents(*rows, *rows[:5])
    again = labels_of(spark, labels + [(d, 0, 0) for d, q, _ in labels[:3]])
    assert Q.quality_table(frame, again).count() == 85
    assert Q.quality_table(documents(), again).count() == 0


def test_long_texts_are_read_whole(monkeypatch):
    text = prose(random.Random(1), 500) + " é😀#"
    whole = [a.tolist() for a in Q.gram_frequencies(text)]
    monkeypatch.setattr(Q, "_CHARS", 11)
    parts = [a.tolist() for a in Q.gram_frequencies(text)]
    assert whole == parts
