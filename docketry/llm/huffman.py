"""Canonical length-limited Huffman codes over token ids, packed and unpacked as arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# A checkpoint (the bit at which a token begins) is kept for every so many tokens of a block.
CHECKPOINT = 512
# Codes must fit into a window of four bytes at any bit of a byte.
WIDEST = 25


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Best code lengths of at most `limit` bits for the counted symbols (package-merge); 0 for symbols without count."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit into codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    n = len(order)
    # Each level holds the symbols and the pairs of the level below, by weight; only the order is kept.
    levels, below = [], np.zeros(0)
    for _ in range(limit):
        pairs = below[: len(below) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([weight, pairs])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < n)
        below = merged[rank]
    depth = np.zeros(n, np.int64)
    take = 2 * n - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        depth[:symbols] += 1
        take = 2 * (take - symbols)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol); the lengths alone say them all."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    if len(order):
        size = lengths[order].astype(np.int64)
        widest = int(size.max())
        width = np.int64(1) << (widest - size)
        begin = np.concatenate([[0], np.cumsum(width)[:-1]])
        codes[order] = begin >> (widest - size)
    return codes


@dataclass
class Code:
    lengths: np.ndarray

    def __post_init__(self) -> None:
        self.codes = canonical_codes(self.lengths).astype(np.uint64)
        self.bits = max(1, int(self.lengths.max(initial=0)))
        self._table: np.ndarray | None = None

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of the ids, and the bit at which each CHECKPOINT-th id begins."""
        size = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(size)
        begin = ends - size
        total = int(ends[-1]) if len(ends) else 0
        words = np.zeros(total // 32 + 2, np.uint64)
        if total:
            word = begin >> 5
            value = self.codes[ids] << (64 - (begin & 31) - size).astype(np.uint64)
            heads = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
            words[word[heads]] += np.add.reduceat(value >> np.uint64(32), heads)
            low = value & np.uint64(0xFFFFFFFF)
            over = np.flatnonzero(low)
            words[word[over] + 1] += low[over]
        raw = words.astype(">u4").tobytes()[: (total + 7) // 8]
        return raw, begin[::CHECKPOINT].astype(np.int64)

    def table(self) -> np.ndarray:
        """For every window of `bits` bits: the symbol and the length of the code it begins with."""
        if self._table is None:
            used = np.flatnonzero(self.lengths)
            order = used[np.argsort(self.lengths[used], kind="stable")]
            entry = (order.astype(np.uint32) << np.uint32(5)) | self.lengths[order].astype(np.uint32)
            filled = np.repeat(entry, np.int64(1) << (self.bits - self.lengths[order].astype(np.int64)))
            self._table = np.zeros(1 << self.bits, np.uint32)
            self._table[: len(filled)] = filled
        return self._table

    def unpack(self, raws: list[bytes], checkpoints: list[np.ndarray], counts: list[int]) -> list[np.ndarray]:
        """The ids of several blocks. All checkpoints of all blocks are decoded side by side, a token a step."""
        table = self.table()
        data = np.frombuffer(b"".join(r + bytes(4) for r in raws), np.uint8).astype(np.uint32)
        window = data[:-3] << np.uint32(24)
        window |= data[1:-2] << np.uint32(16)
        window |= data[2:-1] << np.uint32(8)
        window |= data[3:]
        base = np.cumsum([0, *[8 * (len(r) + 4) for r in raws]])[:-1]
        lanes = [len(c) for c in checkpoints]
        if not sum(lanes):
            return [np.zeros(0, np.uint32) for _ in raws]
        at = np.concatenate([c + b for c, b in zip(checkpoints, base, strict=True)])
        out = np.empty((CHECKPOINT, len(at)), np.uint32)
        mask, shift = np.uint32((1 << self.bits) - 1), 32 - self.bits
        last = len(window) - 1
        for step in range(CHECKPOINT):
            place = np.minimum(at >> 3, last)
            code = (window[place] >> (shift - (at & 7)).astype(np.uint32)) & mask
            found = table[code]
            out[step] = found >> np.uint32(5)
            at += found & np.uint32(31)
        flat = out.T.reshape(-1)
        begin = np.cumsum([0, *lanes])[:-1] * CHECKPOINT
        return [flat[b : b + n] for b, n in zip(begin.tolist(), counts, strict=True)]
