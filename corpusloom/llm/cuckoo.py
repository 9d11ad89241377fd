"""A cuckoo filter as numpy arrays: approximate membership of 64-bit hashes, with insertions and deletions in bulk."""

from __future__ import annotations

import numpy as np

from corpusloom.llm.bytewords import mixed

SLOTS = 4
LOAD = 0.8
ROUNDS = 500
_EMPTY = np.uint16(0)


class Full(Exception):
    """The hashes do not fit; build a larger filter."""


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; each hash has two buckets, and each can be found from the other."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.mask = np.uint64(len(slots) - 1)

    @classmethod
    def of_size(cls, hashes: int) -> CuckooFilter:
        """A filter with room for so many hashes."""
        buckets = 1 << max(3, int(np.ceil(hashes / LOAD / SLOTS) - 1).bit_length())
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def from_bytes(cls, held: bytes) -> CuckooFilter:
        return cls(np.frombuffer(held, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    @property
    def held(self) -> int:
        return int(np.count_nonzero(self.slots))

    @property
    def room(self) -> int:
        return int(self.slots.size * LOAD)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        marks = ((hashes >> np.uint64(48)) % np.uint64(0xFFFF) + np.uint64(1)).astype(np.uint16)
        return (mixed(hashes) & self.mask).astype(np.int64), marks

    def _other(self, buckets: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return ((buckets.astype(np.uint64) ^ mixed(marks.astype(np.uint64))) & self.mask).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        """False is certain; true is wrong for about one hash in eight thousand."""
        first, marks = self._places(hashes)
        second = self._other(first, marks)
        return (self.slots[first] == marks[:, None]).any(axis=1) | (self.slots[second] == marks[:, None]).any(axis=1)

    @staticmethod
    def _rank(buckets: np.ndarray) -> np.ndarray:
        """For each entry, how many earlier ones have the same bucket."""
        order = np.argsort(buckets, kind="stable")
        ordered = buckets[order]
        starts = np.flatnonzero(np.diff(ordered, prepend=-1))
        rank = np.empty(len(buckets), dtype=np.int64)
        rank[order] = np.arange(len(buckets)) - np.repeat(starts, np.diff(np.append(starts, len(buckets))))
        return rank

    def _settle(self, buckets: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Put marks into free slots of their buckets; which of them found none."""
        rank = self._rank(buckets)
        free = self.slots[buckets] == _EMPTY
        fits = rank < free.sum(axis=1)
        # The rank-th free slot of the bucket.
        slot = (np.cumsum(free[fits], axis=1) == rank[fits, None] + 1).argmax(axis=1)
        self.slots[buckets[fits], slot] = marks[fits]
        return ~fits

    def insert(self, hashes: np.ndarray) -> None:
        """Add the hashes, each once. Full if they do not fit; the filter is of no use then."""
        buckets, marks = self._places(hashes)
        left = self._settle(buckets, marks)
        marks = marks[left]
        buckets = self._other(buckets[left], marks)
        for step in range(ROUNDS):
            left = self._settle(buckets, marks)
            buckets, marks = buckets[left], marks[left]
            if not len(buckets):
                return
            # One mark per full bucket takes the place of another, which goes on to its own other bucket.
            chosen = self._rank(buckets) == 0
            at, slot = buckets[chosen], (buckets[chosen] + step) % SLOTS
            pushed = self.slots[at, slot].copy()
            self.slots[at, slot] = marks[chosen]
            buckets = np.concatenate((buckets[~chosen], self._other(at, pushed)))
            marks = np.concatenate((marks[~chosen], pushed))
        raise Full

    def delete(self, hashes: np.ndarray) -> None:
        """Take one mark of each hash out; every hash must have been inserted."""
        buckets, marks = self._places(hashes)
        for turn in range(2):
            for _ in range(2 * SLOTS):
                if not len(buckets):
                    return
                same = self.slots[buckets] == marks[:, None]
                rank = self._rank(buckets * 65_536 + marks.astype(np.int64))
                fits = rank < same.sum(axis=1)
                slot = (np.cumsum(same[fits], axis=1) == rank[fits, None] + 1).argmax(axis=1)
                self.slots[buckets[fits], slot] = _EMPTY
                buckets, marks = buckets[~fits], marks[~fits]
                if not fits.any():
                    break
            if turn == 0:
                buckets = self._other(buckets, marks)
        if len(buckets):
            raise KeyError("a hash that was never inserted")
