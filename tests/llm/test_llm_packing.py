import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import public_tokenizers
from llm_fixtures import documents, edges  # noqa: F401
from wardlight.llm import packing as K

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def whole_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


@given(st.lists(st.text(alphabet="abIİßéÉ'sdt \n\t.,!?|<>$%&0127 ́ \x1f 中😀", max_size=40),
                min_size=1, max_size=12))
@settings(deadline=None)
def test_words_have_the_ids_of_the_whole_text(tokenizer, texts):
    data = [t.encode() for t in texts] + [b"<|endoftext|> <|ENDOFTEXT|> it's the. The, l'eau!!"]
    ids, stops = K.WordIds(PATH, 2).encode(b"\n".join(data), np.cumsum([len(t) + 1 for t in data]))
    begin = 0
    for text, stop in zip(data, stops):
        assert ids[begin:stop].tolist() == whole_ids(tokenizer, text.decode()).tolist()
        begin = stop


def corpus(n=60):
    rng = random.Random(4)
    return [(i, " ".join(rng.choice(["the", "river", "stone,", "Ünder", "42", "x" * 9])
                         for _ in range(rng.choice([0, 3, 50, 400, 1500])))) for i in range(n)]


def check(tokenizer, rows, packed, capacity):
    texts = dict(rows)
    pieces, sequences = {}, {}
    for r in packed:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(texts)
    for doc, found in pieces.items():
        ids, at = whole_ids(tokenizer, texts[doc]), 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(sequences), sum(r.length for r in packed)


def test_pieces_and_sequences(spark, documents, tokenizer, edges, monkeypatch):
    rows = corpus() + [r[:2] for r in edges]
    packed = K.pack(documents(*rows), PATH, capacity=512).collect()
    n, tokens = check(tokenizer, rows, packed, 512)
    assert n <= -(-tokens // 512) + 1


def test_groups_are_packed_on_their_own(spark, documents, tokenizer):
    rows = corpus(90)
    packed = K.pack(documents(*rows), PATH, capacity=256, group_pieces=40).collect()
    check(tokenizer, rows, packed, 256)
    assert len({r.sequence_id >> 32 for r in packed}) > 3


def test_long_texts_and_memory_begun_anew(spark, documents, tokenizer, monkeypatch):
    monkeypatch.setattr(K, "GROUP_BYTES", 500)
    monkeypatch.setattr(K, "REMEMBERED_WORDS", 3)
    rows = corpus(30)
    batch = documents(*rows).select("doc_id", "text").toArrow().to_batches()
    out = [r for b in K._piece_rows(PATH, 2, 256)(iter(batch)) for r in b.to_pylist()]
    found = {}
    for r in out:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
    assert found == {d: len(whole_ids(tokenizer, t)) for d, t in rows}


def test_repeated_rows_and_empty_table(spark, documents):
    assert K.pack(documents((1, "a b"), (1, "a b"), (2, None)), PATH).count() == 3
    assert K.pack(documents(), PATH).count() == 0


@given(st.lists(st.integers(1, 100), max_size=120))
@settings(deadline=None)
def test_tournament_is_first_fit_decreasing(sizes):
    where, offset = K.first_fit_decreasing(np.array(sizes, dtype=np.int64), 100)
    room, plain = [], {}
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, r in enumerate(room) if r >= sizes[item]), len(room))
        if at == len(room):
            room.append(100)
        plain[item] = (at, 100 - room[at])
        room[at] -= sizes[item]
    assert {i: (int(w), int(o)) for i, (w, o) in enumerate(zip(where, offset))} == plain
