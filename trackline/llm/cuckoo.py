"""Cuckoo filters as plain arrays: insert, look up and delete 64-bit keys by 16-bit marks."""

from __future__ import annotations

import numpy as np

from trackline.llm.common import mixed

#: Marks per bucket, evictions tried before a filter counts as full, and marks per slot it is sized for.
SLOTS, KICKS, LOAD = 4, 500, 0.85


class CuckooFilter:
    """Holds keys in a table of buckets; a look-up never misses a held key and seldom finds another one."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks  # (buckets, SLOTS) of uint16, 0 where free

    @classmethod
    def sized_for(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(keys, 1) / (SLOTS * LOAD) + 1))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter holding the keys, made larger until all have a place."""
        size = len(keys)
        while True:
            found = cls.sized_for(size)
            if found.insert_all(keys):
                return found
            size = 2 * size + 8

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.marks.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mark, first and second bucket of each key; either bucket follows from the other and the mark."""
        spread = mixed(np.asarray(keys).astype(np.uint64))
        mark = (spread >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = spread & np.uint64(len(self.marks) - 1)
        return mark, first.astype(np.int64), self._other(first.astype(np.int64), mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        step = mixed(np.asarray(mark).astype(np.uint64)) & np.uint64(len(self.marks) - 1)
        return bucket ^ step.astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(keys)
        return ((self.marks[first] == mark[:, None]) | (self.marks[second] == mark[:, None])).any(axis=1)

    def insert_all(self, keys: np.ndarray) -> bool:
        """False if a key found no place; the filter is then to be built anew and larger."""
        for mark, first, second in zip(*(part.tolist() for part in self._places(keys)), strict=True):
            if not self._insert(mark, first, second):
                return False
        return True

    def _insert(self, mark: int, first: int, second: int) -> bool:
        for bucket in (first, second):
            free = np.flatnonzero(self.marks[bucket] == 0)
            if len(free):
                self.marks[bucket, free[0]] = mark
                return True
        bucket = second
        for kick in range(KICKS):
            slot = (kick * 7 + mark) % SLOTS
            mark, self.marks[bucket, slot] = int(self.marks[bucket, slot]), mark
            bucket = int(self._other(np.array([bucket]), np.array([mark], np.uint16))[0])
            free = np.flatnonzero(self.marks[bucket] == 0)
            if len(free):
                self.marks[bucket, free[0]] = mark
                return True
        return False

    def delete_all(self, keys: np.ndarray) -> None:
        """Remove one mark per key; the keys must have been inserted before."""
        for mark, first, second in zip(*(part.tolist() for part in self._places(keys)), strict=True):
            for bucket in (first, second):
                held = np.flatnonzero(self.marks[bucket] == mark)
                if len(held):
                    self.marks[bucket, held[0]] = 0
                    break
