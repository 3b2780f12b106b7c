"""Words, lines and their hashes for many texts at once, on the UTF-8 bytes of an Arrow column.

Everything here is numpy on slices of at most about ``CHUNK`` bytes (or one text, if that is longer), so a task's
memory does not grow with its partition. Words are runs of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_BLOCK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUATION = (np.arange(256) & 0xC0) == 0x80

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)
_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, _BLOCK)
        up, down = np.full(n, _STEP), np.full(n, _INVERSE)
        up[0] = down[0] = 1
        tables = np.cumprod(up), np.cumprod(down)
        if n > 2 * _BLOCK:  # one giant word or line: not kept
            return tables
        _powers = tables
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span ``data[start:end]``; spans are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    cuts = np.searchsorted(starts, np.arange(int(starts[0]), int(starts[-1]) + _BLOCK, _BLOCK))
    cuts = np.unique(np.append(cuts, len(starts)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        first, last = int(starts[a]), int(ends[b - 1])
        up, down = _power_tables(last - first)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_BYTE[data[first:last]] * up[: last - first], out=sums[1:])
        s, e = starts[a:b] - first, ends[a:b] - first
        out[a:b] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _ODD)
    return out


@dataclass
class Texts:
    """Some rows of a batch: their bytes end to end, and where each row begins (one more entry than rows)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def spans(self, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row of each run of bytes marked in ``solid``; no run crosses a row."""
        n = len(self.data)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, none
        edges = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        opens, closes = np.empty(n, bool), np.empty(n, bool)
        opens[0] = closes[-1] = True
        np.logical_not(solid[:-1], out=opens[1:])
        np.logical_not(solid[1:], out=closes[:-1])
        opens[edges], closes[edges - 1] = True, True
        starts, ends = np.flatnonzero(opens & solid), np.flatnonzero(closes & solid) + 1
        return starts, ends, self.rows_of(starts)

    def rows_of(self, places: np.ndarray) -> np.ndarray:
        """The row of each of some ascending byte positions."""
        return np.repeat(np.arange(self.rows), np.diff(np.searchsorted(places, self.offsets)))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.spans(~SPACE[self.data])

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row are marked; fastest where few are."""
        return np.diff(np.searchsorted(np.flatnonzero(flags), self.offsets))


def texts(column: pa.Array, limit: int = CHUNK) -> Iterator[Texts]:
    """The rows of a string column in slices of at most ``limit`` bytes, or one row. Null is the empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield Texts(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def grams(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` successive words inside one row, and the index of each run's first word."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = len(hashes) - n + 1
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total = total * _STEP + hashes[k : k + size]
    inside = np.flatnonzero(rows[:size] == rows[n - 1 :])
    return mix(total[inside]), inside


def in_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes that also tell rows apart."""
    return mix(hashes + (rows.astype(np.uint64) + np.uint64(1)) * _ODD)
