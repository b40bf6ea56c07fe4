"""Vectorised hashes of byte strings, for use inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ U((seed * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_tables(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64; grown as longer texts come."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        base = _BASES[which]
        inverse = pow(base, -1, 1 << 64)
        tables = []
        for b in (base, inverse):
            t = np.full(size, b, dtype=U)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=U))
        have = tables[0], tables[1]
        if size <= 1 << 22:
            _powers[which] = have
    return have


class Rolling:
    """Hashes of any stretch of a byte string, from one pass over it."""

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        power, self._inverse = _power_tables(len(data) + 1, which)
        self._prefix = np.zeros(len(data) + 1, dtype=U)
        np.cumsum((data.astype(U) + U(1)) * power[: len(data)], out=self._prefix[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._prefix[ends] - self._prefix[starts]) * self._inverse[starts], 1) ^ (ends - starts).astype(U)

    def every(self, width: int) -> np.ndarray:
        """Of the stretch of ``width`` bytes at each place."""
        n = len(self._prefix) - width
        return mix((self._prefix[width:] - self._prefix[:n]) * self._inverse[:n], 1) ^ U(width)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of non-blank bytes start and end."""
    solid = np.zeros(len(data) + 2, dtype=np.int8)
    solid[1:-1] = ~BLANK[data]
    edge = np.diff(solid)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shingle_set(text: bytes, size: int = 5) -> np.ndarray:
    """The distinct ``size``-word shingles of a text, as sorted 64-bit hashes; A-Z are lower-cased."""
    data = np.frombuffer(text.lower(), dtype=np.uint8)
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, dtype=U)
    words = Rolling(data).of(starts, ends)
    width = min(size, len(words))
    total = np.zeros(len(words) - width + 1, dtype=U)
    for j in range(width):
        total += mix(words[j : j + len(total)], 7 + j)
    return np.unique(mix(total, 3 + width))
