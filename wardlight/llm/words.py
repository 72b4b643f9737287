"""Words and their hashes, worked out over whole batches of UTF-8 bytes.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. Word hashes
come from one running sum over the bytes, so no Python object per word exists.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np

# Texts are worked in sections of about this many bytes, cut at white space.
SECTION_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_state: dict[str, np.ndarray] = {}


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value spread over all the others (one-to-one)."""
    out = values.copy()
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    out ^= out >> np.uint64(33)
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    if "up" not in _state or len(_state["up"]) < n:
        size = max(n, SECTION_BYTES + 4096)
        inverse = pow(_BASE, -1, 1 << 64)
        ones = np.full(size, _BASE, dtype=np.uint64)
        ones[0] = 1
        up = np.multiply.accumulate(ones)
        ones[1:] = np.uint64(inverse)
        down = np.multiply.accumulate(ones)
        if size > 4 * SECTION_BYTES:
            return up, down
        _state["up"], _state["down"] = up, down
    return _state["up"], _state["down"]


def _letters() -> np.ndarray:
    if "letters" not in _state:
        _state["letters"] = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    return _state["letters"]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first byte and end byte of every word of ``data``."""
    raw = np.frombuffer(data, dtype=np.uint8)
    space = np.ones(len(raw) + 2, dtype=bool)
    space[1:-1] = _SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts, ends
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_letters()[raw] * up[:len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes += (ends - starts).astype(np.uint64)
    return mixed(hashes), starts, ends


def sections(data: bytes, limit: int = SECTION_BYTES) -> Iterator[bytes]:
    """``data`` in pieces of about ``limit`` bytes that never cut a word."""
    at = 0
    while len(data) - at > limit:
        window = np.frombuffer(data, dtype=np.uint8, offset=at + limit)
        step = 1 << 16
        for begin in range(0, len(window), step):
            found = np.flatnonzero(_SPACE[window[begin:begin + step]])
            if len(found):
                cut = at + limit + begin + int(found[0])
                break
        else:
            break
        yield data[at:cut]
        at = cut
    yield data[at:]


def grouped_words(texts: list[bytes | None], limit: int = SECTION_BYTES
                  ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes of many texts, several short texts or one long text at a time.

    Yields first text, end text, hashes of their words, and the number of
    words before each text (one entry more than texts).
    """
    first = 0
    while first < len(texts):
        end, size = first, 0
        while end < len(texts) and (end == first or size + len(texts[end] or b"") <= limit):
            size += len(texts[end] or b"") + 1
            end += 1
        if end == first + 1 and size > limit:
            parts = [word_hashes(s)[0] for s in sections(texts[first], limit)]
            hashes = np.concatenate(parts)
            yield first, end, hashes, np.array([0, len(hashes)])
        else:
            lengths = np.array([len(t or b"") + 1 for t in texts[first:end]])
            hashes, starts, _ = word_hashes(b"\n".join(t or b"" for t in texts[first:end]))
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            yield first, end, hashes, np.searchsorted(starts, bounds)
        first = end


def as_bytes(column, lower: bool = False) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes; ``lower`` maps A-Z only."""
    import pyarrow as pa

    values = column.cast(pa.large_binary()).to_pylist()
    if lower:
        # One by one, so that no second copy of all texts is held.
        for at, value in enumerate(values):
            values[at] = value.lower() if value else value
    return values


def each_row(batch) -> Iterator[dict]:
    """A batch's rows one at a time: rows that hold whole blocks are not all copied at once."""
    for at in range(batch.num_rows):
        yield {name: batch.column(i)[at].as_py() for i, name in enumerate(batch.schema.names)}


def hand_back() -> None:
    """Give memory that finished work leaves behind back to the system.

    Workers are reused by later tasks, whose peak would otherwise stand on what
    earlier stages had allocated.
    """
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
