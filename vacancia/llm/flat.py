"""Texts as flat numpy arrays: bytes, words, 64-bit names of words and of word windows.

A batch of texts is one array of UTF-8 bytes with offsets. Words are found with a table of
word bytes. The name of a word is the sum of its eight-byte pieces, each mixed with its place;
windows of words, and long strings of bytes, are named by prefix sums over such mixed numbers,
so no step loops over words. (A polynomial over the bytes themselves has equal names for some
words that differ, whatever its base.) A name is a function of the bytes alone; two seeds give
independent names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 19  # bytes worked on at once; a longer text is a block of its own

SPACE = np.ones(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = False  # words are [^\x20\x09-\x0D]+

ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True  # digits, a-z, all non-ASCII

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def padded_words(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, the last one included; zeros follow the end."""
    return np.ndarray((buf.size + 1,), "<u8", buffer=np.concatenate([buf, np.zeros(8, np.uint8)]), strides=(1,))


def segment_names(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Names of byte strings ``[starts, ends)`` of any lengths."""
    size = ends - starts
    lanes = np.maximum((size + 7) // 8, 1)
    first = np.cumsum(lanes) - lanes
    lane = np.arange(int(lanes.sum())) - np.repeat(first, lanes)
    left = np.repeat(size, lanes) - 8 * lane
    part = padded_words(buf)[np.repeat(starts, lanes) + 8 * lane]
    part = part & np.where(left >= 8, ~_U(0), (_U(1) << (_U(8) * np.clip(left, 0, 7).astype(np.uint64))) - _U(1))
    part = mix(part ^ mix(lane.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed)))
    total = np.add.reduceat(part, first) if first.size else np.zeros(0, np.uint64)
    return mix(total + size.astype(np.uint64) * _U(0xD6E8FEB86659FD93))


class Poly:
    """Names of segments of a sequence of 64-bit numbers, from one prefix sum."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(0, 1 << 62, dtype=np.uint64)) * 4 + 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.seed = rng.integers(0, 1 << 64, dtype=np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > self.up.size:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def of_bytes(self, buf: np.ndarray, gram: int = 8) -> np.ndarray:
        """Prefix sums over all strings of ``gram`` bytes (eight at most), by the place they begin at."""
        keep = ~_U(0) >> _U(64 - 8 * gram)
        values = mix((padded_words(buf)[: buf.size] & keep) ^ self.seed)
        values[max(buf.size - gram + 1, 0) :] = 0
        return self.prefix(values)

    def byte_names(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, gram: int = 8) -> np.ndarray:
        """Names of byte strings of ``gram`` bytes or more, from ``of_bytes``."""
        return self.names(prefix, starts, ends - gram + 1)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._grow(values.size + 1)
        out = np.zeros(values.size + 1, np.uint64)
        np.cumsum(values * self.up[: values.size], out=out[1:])
        return out

    def names(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Names of ``[starts, ends)``, for lengths of any mix."""
        h = (prefix[ends] - prefix[starts]) * self.down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _U(0x9E3779B97F4A7C15))


BYTES = Poly(11)
WORDS = Poly(23)
OTHER = Poly(47)


def arrow_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    text = pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
    column = pc.fill_null(column.cast(pa.large_string()), "") if text else pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``limit`` bytes."""
    n, first = offsets.size - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """The words of some texts: ``starts``/``ends`` in bytes, ``doc`` of each, ``first`` word of each text."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, lower: bool = False) -> None:
        self.buf = LOWER[buf] if lower else buf
        n = buf.size
        is_word = np.zeros(n + 2, bool)
        is_word[1:-1] = word_bytes[self.buf]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        self.starts = np.flatnonzero(is_word[1:-1] & (~is_word[:-2] | cut[:-1]))
        self.ends = np.flatnonzero(is_word[1:-1] & (~is_word[2:] | cut[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(offsets.size - 1), self.count)

    def named(self, seed: int = 0) -> np.ndarray:
        """A 64-bit name of every word; another seed gives names that are independent of these."""
        return segment_names(self.buf, self.starts, self.ends, seed)


def joined_ranges(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in any of the ranges."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``counts[i]`` values each."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - before, counts)
