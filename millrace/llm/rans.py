"""Static range asymmetric numeral system over token ids, vectorised across interleaved lanes.

Symbol i of a block belongs to lane i % LANES; each lane is a 64-bit coder that renormalises by 32-bit
words, and all lanes share one word stream and one frequency table.  Blocks are independent: each
starts from the lane states stored with it, so the block directory of a file is its list of checkpoints.
"""

from __future__ import annotations

import struct
import zlib
from functools import cached_property

import numpy as np

LANES = 1024
BLOCK = 1 << 18
#: Frequencies sum to 1 << BITS, and a coder's state stays in [1 << 31, 1 << 63).
BITS = 20
LOW = np.uint64(1 << 31)
_32 = np.uint64(32)


class Table:
    """Frequencies of all ids that occur, quantised to sum to 1 << BITS, each at least 1."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    @cached_property
    def step(self) -> np.ndarray:
        """Of each slot: its symbol's frequency, and in the lowest BITS bits its place among the symbol's slots."""
        return (self.freq[self.symbol] << np.uint64(BITS)) | (np.arange(len(self.symbol), dtype=np.uint64) - self.start[self.symbol])

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        total, used = int(counts.sum()), counts > 0
        if not total:
            return cls(np.zeros(len(counts), dtype=np.int64))
        room = (1 << BITS) - int(used.sum())
        if room < 0:
            raise ValueError(f"more than {1 << BITS} symbols")
        freq = np.where(used, 1 + (counts * (room / total)).astype(np.int64), 0)
        rest = (1 << BITS) - int(freq.sum())
        order = np.argsort(-counts, kind="stable")
        while rest:  # what rounding left goes to, or comes from, the most frequent ids
            step = order[: min(abs(rest), int(used.sum()))]
            if rest < 0:
                step = step[freq[step] > 1]
            freq[step] += 1 if rest > 0 else -1
            rest = (1 << BITS) - int(freq.sum())
        return cls(freq)

    def dump(self) -> bytes:
        body = zlib.compress(self.freq.astype("<u4").tobytes(), 6)
        return struct.pack("<4sIII", b"FRQ1", len(self.freq), zlib.crc32(body), len(body)) + body

    @classmethod
    def load(cls, data: bytes) -> Table:
        magic, n, crc, size = struct.unpack_from("<4sIII", data)
        body = data[16 : 16 + size]
        if magic != b"FRQ1" or zlib.crc32(body) != crc:
            raise ValueError("not a frequency table, or damaged")
        freq = np.frombuffer(zlib.decompress(body), dtype="<u4")
        assert len(freq) == n
        return cls(freq.astype(np.int64))


def encode(ids: np.ndarray, table: Table) -> bytes:
    """One block: header, lane states, words.  The checksum is of the ids as unsigned 32-bit integers."""
    n = len(ids)
    rows = -(-n // LANES)
    f_all, c_all = table.freq[ids], table.start[ids]
    if n and not f_all.all():
        raise ValueError("an id is not in the table")
    x = np.full(LANES, LOW, dtype=np.uint64)
    over, gap = f_all << np.uint64(63 - BITS), np.uint64(1 << BITS) - f_all
    out: list[np.ndarray] = []
    for r in range(rows - 1, -1, -1):
        a, b = r * LANES, min(n, (r + 1) * LANES)
        s = x[: b - a]
        full = np.flatnonzero(s >= over[a:b])
        if len(full):
            high = s[full]
            out.append(high.astype("<u4"))
            s[full] = high >> _32
        s += (s // f_all[a:b]) * gap[a:b] + c_all[a:b]  # (q << BITS) + s - q f + c
    words = np.concatenate(out[::-1]) if out else np.empty(0, dtype="<u4")
    head = struct.pack("<IIII", n, len(words), zlib.crc32(ids.astype("<u4").tobytes()), 0)
    body = x[: min(n, LANES)].astype("<u8").tobytes() + words.tobytes()
    return head[:12] + struct.pack("<I", zlib.crc32(body)) + body


def decode(data: bytes, table: Table) -> np.ndarray:
    n, n_words, crc, body_crc = struct.unpack_from("<IIII", data)
    lanes = min(n, LANES)
    if zlib.crc32(data[16 : 16 + 8 * lanes + 4 * n_words]) != body_crc:
        raise ValueError("damaged block")
    x = np.frombuffer(data, "<u8", lanes, 16).astype(np.uint64)
    words = np.frombuffer(data, "<u4", n_words, 16 + 8 * lanes).astype(np.uint64)
    slots = np.empty(n, dtype=np.int64)
    mask, bits, at = np.uint64((1 << BITS) - 1), np.uint64(BITS), 0
    for a in range(0, n, LANES):
        slot = slots[a : a + LANES]
        s = x[: len(slot)]
        np.bitwise_and(s, mask, out=slot.view(np.uint64))
        step = table.step.take(slot)
        s >>= bits
        s *= step >> bits
        s += step & mask
        need = np.flatnonzero(s < LOW)
        if k := len(need):
            s[need] = (s[need] << _32) | words[at : at + k]
            at += k
    ids = table.symbol[slots]
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("checksum of ids")
    return ids
