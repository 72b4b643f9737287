"""Byte-level byte-pair encoding by merge replay, and decoding.

A text is split by a pattern, and a word's tokens depend on the word alone. So
the different words of a block of the corpus are laid out once, byte by byte, with
an inverted index from the rank of a token pair to the positions where the pair
stands, whichever word they are in. The ranks that occur are taken in order; each
merges at all its positions, left to right, and only the two pairs next to a merge
are entered anew. A merge may open one of a lower rank; the other positions of
that word then wait until the lower one has been taken, as they would if the word
were encoded by itself. A word that is a token by itself is that token.

Blocks are bounded by bytes, and a task remembers the words of its earlier blocks
(a bounded number), so a frequent word is merged once per task, not once per
document. Nothing is shuffled: a table of all different words of the corpus would
give the same ids.

Defined cases: null text is empty and has no id; repeated rows are encoded each; a
null ``doc_id`` is kept; an empty table gives no row; further columns are ignored;
a very long text is a block by itself; text that looks like a special token is
ordinary text. Lone surrogates cannot occur in a string column.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, functions as F

# UTF-8 bytes of text whose words are laid out together.
BLOCK_BYTES = 8 << 20
# Words that a task remembers; beyond it, its memory is begun anew.
REMEMBERED_WORDS = 400_000
# Ids that are decoded together.
DECODED_IDS = 1 << 21


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Merges:
    """Merges over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"not a byte-level vocabulary: {len(missing)} single bytes have no rank")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.size = max(self.tokens) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        # Rank of every pair of single bytes, -1 for those that do not merge.
        self.double = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)],
                               dtype=np.int32)

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """The ids of every word."""
        found: list[list[int] | None] = [[self.ranks[w]] if w in self.ranks else None for w in words]
        rest = [i for i, ids in enumerate(found) if ids is None]
        if not rest:
            return found
        data = np.frombuffer(b"".join(words[i] for i in rest), dtype=np.uint8)
        ends = np.cumsum([len(words[i]) for i in rest])
        starts = np.append(0, ends[:-1]).tolist()
        # Tokens in a row per word, linked both ways, and the rank of each token's pair with the next.
        at_first = np.append(self.double[data[:-1], data[1:]], np.int32(-1))
        at_first[ends - 1] = -1
        links = np.arange(1, len(data) + 1, dtype=np.int32)
        links[ends - 1] = -1
        backward = np.arange(-1, len(data) - 1, dtype=np.int32)
        backward[starts] = -1
        token, pair, after, before = (
            array("i", a.tobytes()) for a in (self.single[data], at_first, links, backward))
        order = np.argsort(at_first, kind="stable")
        ranks, begins = np.unique(at_first[order], return_index=True)
        index = {r: array("i", part.astype(np.int32).tobytes()) for r, part in zip(
            ranks.tolist(), np.split(order, begins[1:])) if r >= 0}
        heap = list(index)
        heapq.heapify(heap)
        known: dict[int, int] = {}

        def entered(left: int, at: int, right: int) -> int:
            """Enters the pair of tokens ``left`` and ``right`` at its place; its rank."""
            both = left * self.size + right
            r = known.get(both)
            if r is None:
                r = known[both] = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
            pair[at] = r
            if r >= 0:
                if r in index:
                    index[r].append(at)
                else:
                    index[r] = array("i", (at,))
                    heapq.heappush(heap, r)
                return r
            return self.size

        while heap:
            now = heapq.heappop(heap)
            waiting: set[int] = set()
            for at in sorted(index.pop(now)):
                # Since it was entered, the token may have gone or have another neighbour.
                if pair[at] != now:
                    continue
                if waiting and bisect_right(starts, at) in waiting:
                    entered(token[at], at, token[after[at]])
                    continue
                right = after[at]
                token[at] = now
                pair[at] = pair[right] = -1
                behind = after[at] = after[right]
                lowest = self.size
                if behind >= 0:
                    before[behind] = at
                    lowest = entered(now, at, token[behind])
                left = before[at]
                if left >= 0:
                    lowest = min(lowest, entered(token[left], left, now))
                if lowest < now:
                    waiting.add(bisect_right(starts, at))
        for begin, i in zip(starts, rest):
            ids, at = [], begin
            while at >= 0:
                ids.append(token[at])
                at = after[at]
            found[i] = ids
        return found


class _Numbers(dict):
    """Words numbered in order of appearance."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Vocabulary:
    """The ids of the words that a task has met."""

    def __init__(self, path: str, pattern: str):
        self.merges, self.pattern = Merges(read_ranks(path)), regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.ids = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and where each text's ids begin."""
        if len(self.numbers) > REMEMBERED_WORDS:
            self.forget()
        known = len(self.numbers)
        codes, ends = array("i"), [0]
        for text in texts:
            codes.extend(map(self.numbers.__getitem__, (m.group() for m in self.pattern.finditer(text))
                             if len(text) > BLOCK_BYTES else self.pattern.findall(text)))
            ends.append(len(codes))
        words = [w.encode() for w in list(self.numbers)[known:]]
        new = self.merges.replay(words)
        self.ids = np.concatenate([self.ids, np.fromiter(
            (t for ids in new for t in ids), dtype=np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(
            [len(ids) for ids in new], dtype=np.int64)])
        codes = np.frombuffer(codes, dtype=np.int32) if len(codes) else np.zeros(0, np.int32)
        return _gathered(self.ids, self.starts, codes, np.array(ends))


def _gathered(values: np.ndarray, starts: np.ndarray, codes: np.ndarray, ends: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[starts[c]:starts[c + 1]]`` of all codes, and where each of the pieces
    that end at ``ends`` of the codes begins among them."""
    lengths = starts[codes + 1] - starts[codes]
    places = np.append(0, np.cumsum(lengths))
    at = np.repeat(starts[codes] - places[:-1], lengths) + np.arange(places[-1])
    return values[at], places[ends]


def _runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` in all, or of one larger row."""
    first, held = 0, 0
    for at, size in enumerate(sizes):
        if at > first and held + size > limit:
            yield first, at
            first, held = at, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def _encoder(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        for batch in batches:
            words = words or Vocabulary(path, pattern)
            sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).to_pylist()
            for a, b in _runs(sizes, BLOCK_BYTES):
                ids, offsets = words.encode([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))],
                    names=["doc_id", "ids"])

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every document; executors read the rank file at ``ranks_path``."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _encoder(ranks_path, pattern), "doc_id bigint, ids array<int>")


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob = starts = None
        for batch in batches:
            if blob is None:
                tokens = {rank: token for token, rank in read_ranks(path).items()}
                lengths = [len(tokens.get(i, b"")) for i in range(max(tokens) + 1)]
                blob = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), dtype=np.uint8)
                starts = np.append(0, np.cumsum(lengths))
            column = batch.column(1)
            for a, b in _runs(pa.compute.list_value_length(column).to_pylist(), DECODED_IDS):
                part = column.slice(a, b - a)
                ends = np.append(0, np.cumsum(pa.compute.list_value_length(part).to_numpy()))
                data, offsets = _gathered(blob, starts, part.flatten().to_numpy(), ends)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), part, pa.Array.from_buffers(
                        pa.binary(), b - a, [None, pa.py_buffer(offsets.astype(np.int32)),
                                             pa.py_buffer(np.ascontiguousarray(data))])],
                    names=["doc_id", "ids", "decoded"])

    return run


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the bytes ``decoded`` that the ids stand for."""
    return encoded.select("doc_id", "ids").mapInArrow(
        _decoder(ranks_path), "doc_id bigint, ids array<int>, decoded binary")


def bpe_table(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The contract's digests of ids and decoded bytes."""
    return decode(encode(docs, ranks_path, pattern), ranks_path).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
