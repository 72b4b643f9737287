"""Small helpers on unsigned 64-bit arrays."""

from __future__ import annotations

import numpy as np
import zstandard


def squeezed(values: np.ndarray) -> bytes:
    """Unsigned integers as bytes, byte planes apart, so that equal high bytes vanish."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def loosened(data: bytes, kind: type) -> np.ndarray:
    """What :func:`squeezed` was given."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


def steps(values: np.ndarray) -> np.ndarray:
    """Differences modulo 2**64, the first value first."""
    out = values.copy()
    out[1:] -= values[:-1]
    return out


def sorted_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted values and how often each occurs."""
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.diff(np.append(first, len(keys)))
