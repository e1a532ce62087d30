"""Canonical, length-limited Huffman codes of token ids, packed and read in whole arrays."""

from __future__ import annotations

import numpy as np

#: Longest code in bits unless more symbols need a longer one; ids of a block, which starts at
#: a byte of its own; ids between checkpoints.
LONGEST, BLOCK, STEP = 16, 1 << 18, 64


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of every symbol, 0 for those that never occur; optimal among codes of that limit.

    Coins of every size are packed in pairs into the next size up; the cheapest 2n - 2 packets
    of the last size tell how often each symbol's coin is used, which is its length.
    """
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    longest = max(longest, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order].astype(np.float64)
    levels, packets = [], np.zeros(0)
    for _ in range(longest):
        both = np.concatenate([coins, packets])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < len(coins))
        both = both[rank]
        packets = both[0:len(both) // 2 * 2:2] + both[1:len(both) // 2 * 2:2]
    take = 2 * len(coins) - 2
    for own in reversed(levels):
        single = int(own[:take].sum())
        out[order[:single]] += 1
        take = 2 * (take - single)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Code of every symbol: counted up in the order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.flatnonzero(lengths)
    order = order[np.argsort(lengths[order], kind="stable")]
    bits = lengths[order].astype(np.int64)
    if len(order):
        top = int(bits.max())
        room = np.left_shift(np.int64(1), top - bits)
        codes[order] = ((np.cumsum(room) - room) >> (top - bits)).astype(np.uint64)
    return codes


class Code:
    """The two directions of a canonical code, from its lengths alone."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical(lengths)
        self.top = int(lengths.max()) if len(lengths) and lengths.any() else 1
        order = np.flatnonzero(lengths)
        order = order[np.argsort(lengths[order], kind="stable")]
        room = np.left_shift(1, self.top - self.lengths[order])
        size = 1 << self.top
        self.symbol = np.resize(np.append(np.repeat(order, room), 0), size).astype(np.uint32)
        self.bits = np.resize(np.append(np.repeat(self.lengths[order], room), 1), size).astype(np.int64)

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """One block: its bytes, and the bits of every stretch of ``STEP`` ids."""
        bits = self.lengths[ids]
        ends = np.cumsum(bits)
        starts = ends - bits
        n = int(ends[-1]) // 16 + 3
        unit = starts >> 4
        wide = self.codes[ids] << (48 - (starts & 15) - bits).astype(np.uint64)
        units = np.zeros(n + 2)
        for k, shift in enumerate((32, 16, 0)):
            part = ((wide >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.float64)
            if k < 2 or self.top > 17:
                units[k:k + n] += np.bincount(unit, part, n)
        raw = units[:n].astype(">u2").tobytes()[:(int(ends[-1]) + 7) // 8]
        marks = np.append(starts[::STEP], ends[-1])
        return raw, np.diff(marks).astype(np.uint16)

    def unpack(self, raw: bytes, stretches: np.ndarray, n: int) -> np.ndarray:
        """All stretches of a block advance together, one id each a step."""
        units = np.frombuffer(raw + b"\0" * (8 - len(raw) % 2), ">u2").astype(np.uint64)
        wide = (units[:-2] << np.uint64(32)) | (units[1:-1] << np.uint64(16)) | units[2:]
        at = np.cumsum(stretches, dtype=np.int64) - stretches
        out = np.zeros((STEP, len(stretches)), np.uint32)
        mask = np.uint64((1 << self.top) - 1)
        last = len(wide) - 1
        for k in range(STEP):
            peek = (wide[np.minimum(at >> 4, last)] >> (48 - self.top - (at & 15)).astype(np.uint64)) & mask
            out[k] = self.symbol[peek]
            at += self.bits[peek]
        return out.T.ravel()[:n]
