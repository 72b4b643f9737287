"""A cuckoo filter over 64-bit keys: 16-bit marks, four to a bucket, in one array."""

from __future__ import annotations

import numpy as np

from wardlight.llm.words import mixed

SLOTS = 4
_FILL = 0.8
_ROUNDS = 400


class CuckooFilter:
    """Answers "surely not" or "maybe" for a key; keys can be added and removed."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks

    @staticmethod
    def sized(keys: int) -> "CuckooFilter":
        buckets = 1 << max(1, int(np.ceil(keys / (SLOTS * _FILL))) - 1).bit_length()
        return CuckooFilter(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @staticmethod
    def loaded(data: bytes) -> "CuckooFilter":
        return CuckooFilter(np.frombuffer(data, dtype="<u2").reshape(-1, SLOTS).copy())

    def dumped(self) -> bytes:
        return self.marks.astype("<u2").tobytes()

    def _mark(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(len(self.marks) - 1)).astype(np.int64)

    def _other(self, buckets: np.ndarray, marks: np.ndarray) -> np.ndarray:
        step = mixed(marks.astype(np.uint64)) & np.uint64(len(self.marks) - 1)
        return buckets ^ step.astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        marks, home = self._mark(keys).astype(np.uint16), self._home(keys)
        found = (self.marks[home] == marks[:, None]).any(axis=1)
        return found | (self.marks[self._other(home, marks)] == marks[:, None]).any(axis=1)

    def add(self, keys: np.ndarray) -> bool:
        """Adds all keys at once; False if they do not all find a place (build a larger one).

        Each round fills free slots; of the marks left over, the first at each
        bucket pushes out another one, and all go on to their other bucket.
        """
        marks, at = self._mark(keys).astype(np.uint16), self._home(keys)
        for turn in range(_ROUNDS):
            if not len(marks):
                return True
            order = np.argsort(at, kind="stable")
            marks, at = marks[order], at[order]
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
            free = self.marks[at] == 0
            number = np.cumsum(free, axis=1)
            fits = rank < number[:, -1]
            slot = (free & (number == rank[:, None] + 1)).argmax(axis=1)
            self.marks[at[fits], slot[fits]] = marks[fits]
            push = rank == number[:, -1]
            left = marks.copy()
            if turn:
                victim = (mixed(marks[push].astype(np.uint64) + np.uint64(turn))
                          % np.uint64(SLOTS)).astype(np.int64)
                left[push] = self.marks[at[push], victim]
                self.marks[at[push], victim] = marks[push]
            marks, at = left[~fits], at[~fits]
            at = self._other(at, marks)
        return not len(marks)

    def remove(self, keys: np.ndarray) -> None:
        """Removes keys that were added before, one mark each."""
        marks = self._mark(keys).astype(np.uint16)
        home = self._home(keys)
        other = self._other(home, marks)
        for mark, *places in zip(marks.tolist(), home.tolist(), other.tolist()):
            for place in places:
                found = np.flatnonzero(self.marks[place] == mark)
                if len(found):
                    self.marks[place, found[0]] = 0
                    break
