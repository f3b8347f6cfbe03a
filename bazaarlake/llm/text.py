"""Vectorised work on whole texts inside tasks: words, word hashes and shingle hashes of Arrow columns.

Texts are taken as UTF-8 bytes in slices of a few megabytes, so that memory follows the slice (or one
text, if that is longer) and never the partition. Words are runs of bytes other than blank, tab, line feed,
vertical tab, form feed and carriage return. Hashes depend on the bytes of the word or shingle alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SLICE_ROWS = 20_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


#: The longest table of powers made so far, by base.
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64."""
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 20), base, np.uint64)
        held[0] = 1
        np.multiply.accumulate(held, out=held)
        _POWERS[int(base)] = held
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive rows; a null text is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(at, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), n, low + SLICE_ROWS)
        yield low, high, raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


class Words:
    """Words of a slice: byte ``start`` and ``end``, ``row`` (from 0), 64-bit ``hash``, ``counts`` per row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True, between: np.ndarray = _SPACE):
        n = len(data)
        rows = len(offsets) - 1
        word = ~between[data]
        first = np.zeros(n + 1, bool)
        first[offsets[:-1]] = True
        opens, closes = word.copy(), word.copy()
        opens[1:] &= ~word[:-1] | first[1:n]
        closes[:-1] &= ~word[1:] | first[1:n]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        bounds = np.searchsorted(self.start, offsets)
        self.counts = np.diff(bounds)
        self.bounds = bounds
        self.row = np.repeat(np.arange(rows), self.counts)
        total = np.zeros(n + 1, np.uint64)
        held = _LOWER[data] if lower else data
        np.cumsum((held.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
        self._total, self._inverse = total, powers(_INVERSE, n + 1)
        self.hash = self.part(self.start, self.end)

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes from ``start`` to ``end``; equal bytes give equal hashes wherever they stand."""
        return mix((self._total[end] - self._total[start]) * self._inverse[start])


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position of the first word and 64-bit hash of every run of ``size`` words.

    A text with fewer words gives its whole sequence as one shingle; one without words gives none.
    """
    n = len(words.hash)
    full = np.zeros(n, np.uint64)
    place = np.arange(1, size + 1).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)
    usable = n - size + 1
    if usable > 0:
        part = full[:usable]
        for step in range(size):
            part += mix(words.hash[step : step + usable] + place[step])
    last = words.bounds[1:] - size
    where = np.arange(n)
    ok = where <= last[words.row] if n else np.zeros(0, bool)
    rows, at, value = words.row[ok], where[ok], mix(full[ok])
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        mine = np.isin(words.row, short)
        nth = (where - words.bounds[words.row] + 1)[mine].astype(np.uint64)
        total = np.zeros(int(mine.sum()) + 1, np.uint64)
        np.cumsum(mix(words.hash[mine] + np.uint64(0x632BE59BD9B4E019) * nth), out=total[1:])
        ends = np.cumsum(words.counts[short])
        extra = mix(total[ends] - total[ends - words.counts[short]] + words.counts[short].astype(np.uint64))
        rows, at, value = (
            np.concatenate([rows, short]),
            np.concatenate([at, words.bounds[short]]),
            np.concatenate([value, extra]),
        )
        order = np.argsort(rows, kind="stable")
        rows, at, value = rows[order], at[order], value[order]
    return rows, at, value


def distinct(rows: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs, sorted."""
    order = np.lexsort((value, rows))
    rows, value = rows[order], value[order]
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (value[1:] != value[:-1])
    return rows[keep], value[keep]
