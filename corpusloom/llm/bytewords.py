"""Words of many texts at once, on their UTF-8 bytes: numpy arrays instead of one Python object per word.

A word is a run of bytes that a table of 256 flags marks as word bytes; both word definitions used here put all
bytes from 0x80 on inside words, so no multi-byte character is ever cut. A word's hash takes its bytes eight at a time, each mixed
with what came before. Hashes of windows are polynomials over word hashes, taken from prefix sums, so a window of any length
costs the same; they are filters, and ``digests`` tells the words of windows that pass one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

#: Words between ASCII blanks: [^\\x20\\x09-\\x0D]+
BLANK_SEPARATED = np.ones(256, dtype=bool)
BLANK_SEPARATED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Digits, letters and everything beyond ASCII: [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_WORD_BASE, _CHUNK_FACTOR = 0xD1342543DE82EF95, np.uint64(0x9E3779B97F4A7C15)
_LONG_WORD = 4096  # bytes; longer words are hashed one by one
#: The bytes of a chunk of eight that belong to a word which has so many left.
_TAILS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
SLICE_BYTES = 4 << 20


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    def series(factor: int) -> np.ndarray:
        out = np.full(size, factor, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return series(base), series(pow(base, -1, 2**64))


def _sized(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(base, 1 << max(16, int(size - 1).bit_length()))
    return up[:size], down[:size]


def mixed(values: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = values ^ (values >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def text_slices(batch: pa.RecordBatch | pa.Table, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text each (one row at least), so that arrays stay small."""
    batches = batch.to_batches() if isinstance(batch, pa.Table) else [batch]
    for part in batches:
        ends = np.cumsum(string_bytes(part.column(column))[1][1:] - string_bytes(part.column(column))[1][:-1])
        start = 0
        while start < part.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield part.slice(start, stop - start)
            start = stop


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offset of each row (one more than rows); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    places = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return held[places[0] : places[-1]], places - places[0]


@dataclass
class Words:
    """Words of a run of texts: byte places, and for each text its first word (``of[i]`` to ``of[i + 1]``)."""

    data: np.ndarray
    texts: np.ndarray
    start: np.ndarray
    end: np.ndarray
    of: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    def rows(self) -> np.ndarray:
        """For each word, the text that it is in."""
        return np.repeat(np.arange(len(self.of) - 1), self.counts)

    def places(self) -> np.ndarray:
        """For each word, its number inside its text."""
        return np.arange(len(self.start)) - np.repeat(self.of[:-1], self.counts)

    def left(self) -> np.ndarray:
        """For each word, how many words its text has from it on."""
        return np.repeat(self.of[1:], self.counts) - np.arange(len(self.start))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        size = self.end - self.start
        out = mixed(size.astype(np.uint64) * _CHUNK_FACTOR + np.uint64(1))
        padded = np.concatenate((self.data, np.zeros(8, dtype=np.uint8)))
        eights = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))  # eight bytes from every byte on
        word = np.flatnonzero(size <= _LONG_WORD)
        at, left = self.start[word], size[word]
        while len(word):
            chunk = eights[at] & _TAILS[np.minimum(left, 8)]
            out[word] = mixed(out[word] ^ (chunk * _CHUNK_FACTOR))
            goes_on = left > 8
            word, at, left = word[goes_on], at[goes_on] + 8, left[goes_on] - 8
        for number in np.flatnonzero(size > _LONG_WORD).tolist():
            out[number] = xxhash.xxh3_64_intdigest(self.data[self.start[number] : self.end[number]].tobytes())
        return out

    def digests(self, first: np.ndarray, length: int) -> np.ndarray:
        """64 bits of BLAKE2 of the ``length`` words from each of the words ``first`` on, joined by one space."""
        sizes = self.end - self.start + 1
        ends = np.cumsum(sizes)
        spread = np.full(int(ends[-1]) if len(ends) else 0, 0x20, dtype=np.uint8)
        inside = np.ones(len(spread), dtype=bool)
        inside[ends - 1] = False
        change = np.zeros(len(self.data) + 1, dtype=np.int8)
        change[self.start] += 1
        change[self.end] -= 1
        spread[inside] = self.data[np.cumsum(change[:-1], dtype=np.int8) > 0]
        held = spread.tobytes()
        begins, stops = (ends[first] - sizes[first]).tolist(), (ends[first + length - 1] - 1).tolist()
        found = b"".join([hashlib.blake2b(held[a:b], digest_size=8).digest() for a, b in zip(begins, stops, strict=True)])
        return np.frombuffer(found, dtype="<u8")

    def windows(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """A 64-bit hash of the ``length`` words from each word on, to filter by; 0 where the text has fewer left."""
        n = len(hashes)
        out = np.zeros(n, dtype=np.uint64)
        if n >= length:
            up, down = _sized(_WORD_BASE, n + 1)
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(hashes * up[:-1], out=sums[1:])
            out[: n - length + 1] = mixed((sums[length:] - sums[:-length]) * down[: n - length + 1] + np.uint64(length))
            out[self.left() < length] = 0
        return out


def words_of(column: pa.Array, kind: np.ndarray = BLANK_SEPARATED, lower: bool = False) -> Words:
    data, texts = string_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = kind[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[texts] = True  # a text's end separates words, too
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, texts, start, end, np.searchsorted(start, texts))


def covered(starts: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in a window of ``length`` words that ``starts`` marks; windows must not pass a text's end."""
    change = np.zeros(len(starts) + length + 1, dtype=np.int32)
    change[: len(starts)] += starts
    change[length : length + len(starts)] -= starts
    return np.cumsum(change)[: len(starts)] > 0
