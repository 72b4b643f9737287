"""Documents packed into sequences of one length (first-fit decreasing).

Documents are tokenized once and cut into pieces of at most ``capacity`` ids.
Pieces are dealt into randomised groups of bounded size; within a group they
are packed by first-fit decreasing over a tournament tree of the capacities
left, so finding the first sequence with room takes logarithmic time.

Defined cases: null text is empty and gives one piece with the end id alone;
repeated rows are packed once each; a null ``doc_id`` is kept; an empty table
gives no piece; further columns are ignored. Long texts are tokenized section by
section.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardlight.llm.words import as_bytes, hand_back, sections, word_hashes
from wardlight.session import settled

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")
PACKED = PIECES + ", sequence_id bigint, offset bigint"
# Words and stems whose ids one worker remembers; beyond it the memory is begun anew.
REMEMBERED_WORDS = 400_000
# Bytes whose words are looked up together.
GROUP_BYTES = 2 << 20
# Punctuation that may end a word: the vocabulary splits between a letter or digit and these.
_TAIL = b".,;:!?|#$%&*"
# Pieces that one group packs, on average.
GROUP_PIECES = 20_000


def _ends_in_letter(stem: bytes) -> bool:
    """Whether it still does as the vocabulary sees it: some letters become letter and mark."""
    return unicodedata.normalize("NFC", stem.decode()).lower()[-1].isalpha()


class WordIds:
    """Token ids of words.

    The vocabulary splits at white space and between letters and punctuation
    before anything else, and has no case, so a text's ids are its words' ids in
    order, and many words share a stem. Each stem is encoded once and remembered.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.closes[number] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        # Runs of ids one behind another; words and stems are kept as the number of their run.
        self.slots: dict[int, int] = {}
        self.stems: dict[bytes, int] = {}
        self.ids = array("I", [self.end_id])
        self.starts = array("q", [0])
        self.lengths = array("i", [1])

    def _run(self, ids: list[int] | array) -> int:
        self.starts.append(len(self.ids))
        self.lengths.append(len(ids))
        self.ids.extend(ids)
        return len(self.lengths) - 1

    def _whole(self, words: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(
            [w.decode() for w in words], add_special_tokens=False)]

    def _alphabetic(self, words: list[bytes], at_once: int = 500) -> list[list[int]]:
        """Ids of words of letters only: one run each, so the ids that close a run part them."""
        found = []
        for begin in range(0, len(words), at_once):
            some = words[begin:begin + at_once]
            ids = self.tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False).ids
            ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
            if len(ends) == len(some):
                found += [ids[a:b] for a, b in zip([0, *ends], ends)]
            else:
                found += self._whole(some)
        return found

    def _learn_stems(self, stems: list[bytes]) -> None:
        letters, others = [], []
        for stem in stems:
            (letters if stem.decode().lower().isalpha() else others).append(stem)
        for some, found in ((letters, self._alphabetic(letters)), (others, self._whole(others))):
            for stem, ids in zip(some, found):
                self.stems[stem] = self._run(ids)

    def _learn(self, hashes: list[int], words: list[bytes]) -> None:
        parted = []
        for word in words:
            stem = word.rstrip(_TAIL)
            plain = stem and len(stem) < len(word) and (
                stem[-1:].isalnum() if stem[-1] < 128 else _ends_in_letter(stem))
            parted.append((stem, word[len(stem):]) if plain else (word,))
        self._learn_stems([s for s in dict.fromkeys(s for parts in parted for s in parts)
                           if s not in self.stems])
        for value, parts in zip(hashes, parted):
            runs = [self.stems[part] for part in parts]
            if len(runs) > 1:
                ids = array("I")
                for run in runs:
                    begin = self.starts[run]
                    ids.extend(self.ids[begin:begin + self.lengths[run]])
                runs = [self._run(ids)]
            self.slots[value] = runs[0]

    def encode(self, data: bytes, end_places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of ``data`` with the end id put in before the given byte places;
        also how many ids stand before the end of each of these texts."""
        if len(self.lengths) > REMEMBERED_WORDS:
            self.forget()
        if b"<|" not in data:
            # Only a special token's own spelling tells upper from lower case.
            data = data.lower()
        hashes, starts, ends = word_hashes(data)
        codes, distinct = pd.factorize(hashes)
        first = np.empty(len(distinct), dtype=np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        values = distinct.tolist()
        new = [i for i, v in enumerate(values) if v not in self.slots]
        if new:
            at = first[new]
            self._learn([values[i] for i in new], [
                data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
        known = np.array([self.slots[v] for v in values], dtype=np.int64)
        slots = known[codes] if len(codes) else np.zeros(0, dtype=np.int64)
        text_ends = np.searchsorted(starts, end_places)
        slots = np.insert(slots, text_ends, 0)
        flat = np.array(self.ids, dtype=np.uint32)
        begins = np.array(self.starts)[slots]
        counts = np.array(self.lengths, dtype=np.int64)[slots]
        before = np.concatenate([[0], np.cumsum(counts)])
        places = np.arange(before[-1]) + np.repeat(begins - before[:-1], counts)
        return flat[places], before[text_ends + np.arange(1, len(text_ends) + 1)]


_encoders: dict[tuple[str, int], WordIds] = {}


def _encoder(path: str, end_id: int) -> WordIds:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = WordIds(path, end_id)
    return _encoders[path, end_id]


def _cut(parts: Iterator[np.ndarray], capacity: int) -> tuple[list[tuple[int, int, int]], int]:
    """Pieces (start, length, crc) of one document whose ids come in parts, and their total."""
    pieces, total, length, crc = [], 0, 0, 0
    for ids in parts:
        raw = ids.astype("<u4", copy=False)
        at = 0
        while at < len(raw):
            take = min(capacity - length, len(raw) - at)
            crc = zlib.crc32(raw[at:at + take].tobytes(), crc)
            at, length, total = at + take, length + take, total + take
            if length == capacity:
                pieces.append((total - length, length, crc))
                length, crc = 0, 0
    if length:
        pieces.append((total - length, length, crc))
    return pieces, total


def _piece_rows(path: str, end_id: int, capacity: int):
    def run(batches):
        encoder = _encoder(path, end_id)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            rows = []
            first = 0
            while first < len(texts):
                end, size = first, 0
                while end < len(texts) and (size + len(texts[end] or b"")) <= GROUP_BYTES:
                    size += len(texts[end] or b"") + 1
                    end += 1
                if end > first:
                    some = [t or b"" for t in texts[first:end]]
                    ids, stops = encoder.encode(
                        b"\n".join(some), np.cumsum([len(t) + 1 for t in some]))
                    begin = 0
                    for key, stop in zip(keys[first:end], stops.tolist()):
                        pieces, total = _cut(iter([ids[begin:stop]]), capacity)
                        rows += [(key, *piece, total) for piece in pieces]
                        begin = stop
                else:
                    end = first + 1
                    nothing = np.zeros(0, dtype=np.int64)
                    parts = (encoder.encode(s, nothing)[0]
                             for s in sections(texts[first], GROUP_BYTES))
                    pieces, total = _cut((p for part in (parts, [np.array([end_id])])
                                          for p in part), capacity)
                    rows += [(keys[first], *piece, total) for piece in pieces]
                first = end
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        hand_back()

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 2,
                 capacity: int = 4096) -> DataFrame:
    """Every document's ids, the end id included, in pieces of at most ``capacity``."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _piece_rows(tokenizer_path, end_id, capacity), PIECES)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, by a tournament over the room left.

    A leaf holds a sequence's room and an inner node the most room below it;
    walking down to the left while the left child has enough finds the first
    sequence that fits.
    """
    order = np.argsort(-sizes, kind="stable")
    leaves = 1 << max(0, int(len(sizes) - 1).bit_length())
    room = [capacity] * (2 * leaves)
    where = np.zeros(len(sizes), dtype=np.int64)
    offset = np.zeros(len(sizes), dtype=np.int64)
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        where[item], offset[item] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return where, offset


def _packed_group(capacity: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"),
                               ("start", "ascending")])
        sizes = table.column("length").to_numpy()
        where, offset = first_fit_decreasing(sizes, capacity)
        sequence = (int(key[0].as_py()) << 32) + where
        return table.drop_columns(["pack_group"]).append_column(
            "sequence_id", pa.array(sequence, pa.int64())).append_column(
            "offset", pa.array(offset, pa.int64()))

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 4096,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces of all documents with the sequence and offset they are packed at.

    Pieces are written to the shared folder once: their number fixes the number
    of groups. A group's sequences are numbered below its own high bits.
    """
    pieces = settled(token_pieces(docs, tokenizer_path, end_id, capacity), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    # Row numbers, not keys: many rows of one document would share a key.
    dealt = pieces.withColumn("pack_group", F.pmod(
        F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInArrow(_packed_group(capacity), PACKED)
