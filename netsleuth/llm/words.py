"""Word and shingle hashes of Arrow text columns, a few megabytes at a time.

A word is a run of bytes other than space and the ASCII controls tab to carriage
return. Everything here is plain numpy on the column's own buffers: it runs inside
``mapInArrow`` tasks and holds one chunk of texts at once.
"""

from __future__ import annotations

import numpy as np

CHUNK_BYTES = 1 << 21

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _power_tables(n: int):
    """Powers of an odd base and of its inverse modulo 2^64."""
    if len(_powers["up"]) < n:
        n = max(n, CHUNK_BYTES + 1)
        for name, factor in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, factor, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the ordered pair."""
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + (b ^ (b >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)
               + np.uint64(0x2545F4914F6CDD1D))


def string_offsets(column):
    """Offsets and bytes of an Arrow string column; a null is empty."""
    import pyarrow as pa

    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES):
    """Ranges of rows holding about ``size`` bytes, one row at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """The words of a chunk of texts: hashes, byte spans and first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        size = len(data)
        inside = ~_SEPARATOR[data]
        starts, ends = inside.copy(), inside.copy()
        if size:
            edge = np.zeros(size + 1, dtype=bool)
            edge[offsets] = True
            starts[1:] &= ~inside[:-1] | edge[1:-1]
            ends[:-1] &= ~inside[1:] | edge[1:-1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)
        up, down = _power_tables(size + 1)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:size], out=total[1:])
        span = (total[self.end] - total[self.start]) * down[self.start]
        self.hash = mix(span + (self.end - self.start).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))

    @property
    def length(self) -> np.ndarray:
        return self.end - self.start

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values, built by doubling."""
    if len(hashes) < width:
        return np.zeros(0, dtype=np.uint64)
    done, block, size = None, hashes, 1
    have = 0
    while True:
        if width & size:
            if done is None:
                done, have = block, size
            else:
                n = len(hashes) - have - size + 1
                done = pair(done[:n], block[have:have + n])
                have += size
        if have == width:
            return done[:len(hashes) - width + 1]
        n = len(block) - size
        block = pair(block[:n], block[size:size + n])
        size *= 2


def sequence_hash(words: Words, row: int) -> np.ndarray:
    """Two 64-bit hashes of a text's whole word sequence."""
    h = words.hash[words.first[row]:words.first[row + 1]]
    place = mix(np.arange(1, len(h) + 1, dtype=np.uint64) * np.uint64(_BASE))
    n = np.uint64(len(h))
    return mix(np.array([np.sum(pair(h, place), dtype=np.uint64) + n,
                         np.sum(pair(place, h), dtype=np.uint64) ^ (n << np.uint64(32))], dtype=np.uint64))


def word_chunks(column, lower: bool = False):
    """(first row, last row, Words) over an Arrow string column."""
    offsets, data = string_offsets(column)
    for a, b in chunks(offsets):
        yield a, b, Words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], lower)


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(values, dtype=np.uint64).view(np.int64)
