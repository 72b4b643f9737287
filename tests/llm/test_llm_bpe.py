import hashlib
import random
import sys

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from llm_fixtures import documents, edges, prose  # noqa: F401
from wardlight.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = B.read_ranks(PATH)
PLAIN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
WORDS = B.Vocabulary(PATH, public_tokenizers.PATTERN)


def ids_of(texts):
    ids, ends = WORDS.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


def expected(doc_id, text):
    ids = PLAIN.encode_ordinary(text or "")
    return (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(PLAIN.decode_bytes(ids)).hexdigest())


@given(st.lists(st.text(max_size=60), max_size=6))
@settings(deadline=None, max_examples=200)
def test_any_text_as_the_plain_encoder(texts):
    assert ids_of(texts) == [PLAIN.encode_ordinary(t) for t in texts]


def test_every_code_point_alone_and_between_others():
    texts = [f"a{c}b 1{c}2 {c} {c}" for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff"]
    texts = texts[::7] + texts[:0x3000]
    assert ids_of(texts) == [PLAIN.encode_ordinary(t) for t in texts]


def test_runs_repeats_and_special_strings():
    rng = random.Random(4)
    texts = ["a" * 3000, "ab" * 2000, " " * 700, "\n" * 77 + "x", "<|endoftext|>", "", "'ll'LL's",
             "".join(rng.choice("0123456789abcdef") for _ in range(5000)), "ééé" * 900]
    assert ids_of(texts + texts) == [PLAIN.encode_ordinary(t) for t in texts + texts]


@given(st.integers(0, 10 ** 6))
@settings(deadline=None, max_examples=150)
def test_merges_that_open_a_lower_rank(seed):
    """Vocabularies in random order: a merge may open one that comes before it."""
    rng = random.Random(seed)
    pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))).encode() for _ in range(25)}
    tokens = [bytes([b]) for b in range(256)] + rng.sample(sorted(pieces), len(pieces))
    ranks = {t: i for i, t in enumerate(tokens)}
    plain = tiktoken.Encoding("odd", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(20)]
    assert B.Merges(ranks).replay([w.encode() for w in words]) == [plain.encode_ordinary(w) for w in words]


def test_memory_that_is_begun_anew(monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED_WORDS", 3)
    words = B.Vocabulary(PATH, public_tokenizers.PATTERN)
    for text in ["one two three four five", "one six", "seven", "one two"]:
        ids, _ = words.encode([text])
        assert ids.tolist() == PLAIN.encode_ordinary(text)


def test_a_vocabulary_without_single_bytes_is_refused():
    with pytest.raises(ValueError):
        B.Merges({b"a": 0, b"b": 1})


@pytest.mark.parametrize("limits", [(8 << 20, 1 << 21), (40, 5)])
def test_documents(spark, documents, edges, prose, monkeypatch, limits):
    monkeypatch.setattr(B, "BLOCK_BYTES", limits[0])
    monkeypatch.setattr(B, "DECODED_IDS", limits[1])
    rows = [*edges, (903, "one"), (7, " ".join(prose(1, 4000))), (8, "é" * 300 + "\U0001f600 <|endoftext|>")]
    got = B.bpe_table(documents(*rows), PATH, public_tokenizers.PATTERN)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        repr(expected(*r[:2])) for r in rows)
    assert B.bpe_table(documents(), PATH, public_tokenizers.PATTERN).count() == 0


def test_round_trip_gives_the_text(spark, documents, edges):
    coded = B.encode(documents(*edges), PATH, public_tokenizers.PATTERN)
    back = {(r.doc_id, bytes(r.decoded).decode()) for r in B.decode(coded, PATH).collect()}
    assert back == {(r[0], r[1] or "") for r in edges}


def test_whole_small_table(spark):
    from __spark_entry__ import queries
    from conftest import SMALL

    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in queries()["op12_byte_bpe"](spark, SMALL).collect()}
    assert got == {expected(*r) for r in texts}
    assert "public_tokenizers" in sys.modules
