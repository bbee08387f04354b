"""Prefix-free-style parsing of byte texts by rolling-hash triggers, vectorised over a batch of texts.

A text is cut at triggers: a W-byte string whose rolling hash is the smallest (leftmost at ties) among
those inside some SIZE-byte window.  Every window has exactly one trigger, chosen by its own bytes
alone, so equal windows have equal triggers at equal offsets.  Consecutive windows with the same trigger
form a phrase: SIZE-byte windows starting at first..last, covering bytes first..last+SIZE.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .common import kept

SIZE = 100
W = 32
_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_33 = np.uint64(33)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _33)) * _M1
    h = (h ^ (h >> _33)) * _M2
    return h ^ (h >> _33)


@lru_cache(maxsize=4)
def _letters(seed: int) -> np.ndarray:
    """A pseudo-random odd 64-bit value for each byte."""
    return mix(np.arange(1 + seed * 256, 257 + seed * 256, dtype=np.uint64)) | np.uint64(1)


@kept
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, modulo 2**64, for i < n."""
    inverse = pow(_BASE, -1, 1 << 64)
    up = np.full(n, _BASE, dtype=np.uint64)
    down = np.full(n, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Hashes:
    """Hashes of any substrings of one buffer in constant time each."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        n = len(data)
        room = 1 << max(16, (n + 1).bit_length())
        up, self.down = _powers(room)
        self.sums = np.empty(n + 1, dtype=np.uint64)
        self.sums[0] = 0
        np.cumsum(_letters(seed)[data] * up[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def sliding(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.empty(0, np.uint64)


#: A buffer position takes this many low bits beside the hash in one sortable word.
POSITION_BITS = 22
MOST = 1 << POSITION_BITS


def sliding_min(values: np.ndarray, span: int) -> np.ndarray:
    """Smallest value in each run of `span` values, by doubling."""
    have = 1
    while have < span:
        step = min(have, span - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def phrases(cuts: np.ndarray, kmers: np.ndarray, n: int, size: int = SIZE, w: int = W) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigger, first, last) positions in a buffer of n < MOST bytes, of texts that start at cuts.

    kmers: rolling hashes of all W-byte strings.  Their upper bits are compared, then positions.
    """
    if n < size:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    low = np.uint64(MOST - 1)
    trigger = (sliding_min((kmers & ~low) | np.arange(len(kmers), dtype=np.uint64), size - w + 1) & low).astype(np.int64)
    # windows that would cross into the next text have no phrase
    edge = np.zeros(n + 1, dtype=np.int32)
    inner = cuts[1:]
    np.add.at(edge, np.maximum(0, inner - size + 1), 1)
    np.add.at(edge, inner, -1)
    inside = np.cumsum(edge[: n - size + 1]) == 0
    changed = trigger[1:] != trigger[:-1]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | changed
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | changed
    first = np.flatnonzero(start)
    return trigger[first], first, np.flatnonzero(stop)
