"""Words of Arrow text columns and their hashes, vectorised over many texts at once.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. All of these are single bytes that occur inside no other UTF-8
character, so texts are cut on bytes without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 20

_U = np.uint64
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
# two independent tables of random values for bytes; hashes are sums of value * BASE**place
_TABLES = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 64, (2, 256), dtype=_U)
_BASE = 0x9E3779B97F4A7C13
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = _U(0xD6E8FEB86659FD93)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    v = values.astype(_U, copy=True)
    v ^= v >> _U(30)
    v *= _U(0xBF58476D1CE4E5B9)
    v ^= v >> _U(27)
    v *= _U(0x94D049BB133111EB)
    v ^= v >> _U(31)
    return v


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, made once per process and grown on demand."""

    up = _powers(_BASE, 1)
    down = _powers(_BASE_INVERSE, 1)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK_BYTES + (1 << 16))
            cls.up, cls.down = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
        return cls.up, cls.down


class Words(NamedTuple):
    """The words of some texts: bytes, word bounds, and for row r the words first[r]..first[r+1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of whole texts with about `most` bytes each, so that scratch memory is bounded
    by that or by the longest text; gives the first row of every slice."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_large_string(texts.type):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    else:
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        stop = min(max(stop, at + 1), len(texts))
        yield at, texts.slice(at, stop - at)
        at = stop


def cut(texts: pa.Array) -> Words:
    """The words of every text; a null text has none."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    n = len(texts)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), none, none, np.zeros(1, np.int64))
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    offsets -= offsets[0]
    return cut_bytes(data, offsets)


def cut_bytes(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of consecutive texts, text r being data[offsets[r]:offsets[r+1]]."""
    inside = _IN_WORD[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True  # a text's end always ends a word
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def lower_ascii(table: np.ndarray) -> np.ndarray:
    """A byte table that takes A-Z for a-z."""
    out = table.copy()
    out[65:91] = table[97:123]
    return out


_LOWERED = np.stack([lower_ascii(t) for t in _TABLES])


def hashes(words: Words, lower: bool = False, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every word's bytes; `which` picks one of two independent ones."""
    table = (_LOWERED if lower else _TABLES)[which]
    up, down = _Powers.of(len(words.data) + 1)
    sums = np.empty(len(words.data) + 1, dtype=_U)
    sums[0] = 0
    terms = table[words.data]
    terms *= up[: len(terms)]
    np.cumsum(terms, out=sums[1:])
    out = sums[words.end] - sums[words.start]
    out *= down[words.start]
    return mix(out)


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Two independent 64-bit hashes of the spans values[start:end] of small integers."""
    up, down = _Powers.of(len(values) + 1)
    out = []
    for salt in _TABLES[:, 0]:
        sums = np.empty(len(values) + 1, dtype=_U)
        sums[0] = 0
        terms = mix(values.astype(_U) + salt)
        terms *= up[: len(terms)]
        np.cumsum(terms, out=sums[1:])
        out.append(mix((sums[end] - sums[start]) * down[start]))
    return out


def windows(words: Words, hashed: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words inside one text, and the place of each run's first word."""
    n = len(hashed) - width + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    out = hashed[:n].copy()
    for k in range(1, width):
        out *= _STEP
        out += hashed[k : n + k]
    row = words.rows()
    at = np.flatnonzero(row[:n] == row[width - 1 :])
    return mix(out[at]), at
