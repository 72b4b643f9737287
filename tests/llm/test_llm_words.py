import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import brute
from wardlight.llm.arrays import loosened, sorted_counts, squeezed, steps
from wardlight.llm.cuckoo import CuckooFilter
from wardlight.llm.words import grouped_words, mixed, sections, word_hashes

TEXT = st.text(alphabet="abÉ \t\n\r\x0b\x0c\x1f  😀.", max_size=60)


@given(st.lists(st.one_of(st.none(), TEXT), max_size=12), st.integers(1, 40))
@settings(deadline=None)
def test_words_of_many_texts_are_the_words_of_each(texts, limit):
    known = {}
    seen = 0
    for first, end, hashes, before in grouped_words(
            [None if t is None else t.encode() for t in texts], limit):
        assert first == seen
        seen = end
        for at, text in enumerate(texts[first:end]):
            own = hashes[before[at]:before[at + 1]]
            words = brute.words(text)
            assert len(own) == len(words)
            for word, value in zip(words, own.tolist()):
                assert known.setdefault(word, value) == value
    assert seen == len(texts)
    assert len(set(known.values())) == len(known)


@given(TEXT, st.integers(1, 20))
def test_sections_never_cut_a_word(text, limit):
    parts = list(sections(text.encode(), limit))
    assert b"".join(parts) == text.encode()
    assert [w for p in parts for w in brute.words(p.decode())] == brute.words(text)


def test_hash_does_not_depend_on_place():
    long = b"pad " * 300_000 + b"word"
    assert word_hashes(long)[0][-1] == word_hashes(b"word")[0][0]


@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=50))
def test_squeezed_arrays_come_back(values):
    array = np.array(values, dtype=np.uint64)
    assert (loosened(squeezed(array), np.uint64) == array).all()
    assert (np.cumsum(steps(array), dtype=np.uint64) == array).all()
    distinct, n = sorted_counts(array)
    assert dict(zip(distinct.tolist(), n.tolist())) == {v: values.count(v) for v in values}


@pytest.mark.parametrize("n", [0, 1, 10, 5000, 70_000])
def test_cuckoo_filter_holds_what_it_was_given(n):
    keys = mixed(np.arange(1, n + 1, dtype=np.uint64))
    others = mixed(np.arange(10 ** 9, 10 ** 9 + 50_000, dtype=np.uint64))
    made = CuckooFilter.sized(n)
    assert made.add(keys)
    again = CuckooFilter.loaded(made.dumped())
    assert again.holds(keys).all()
    assert again.holds(others).mean() < 0.001
    again.remove(keys[: n // 2])
    assert again.holds(keys[n // 2:]).all()
    assert again.holds(keys[: n // 2]).mean() < 0.01 if n > 1 else True


def test_overfull_filter_says_so():
    small = CuckooFilter.sized(8)
    assert not small.add(mixed(np.arange(1, 200, dtype=np.uint64)))
