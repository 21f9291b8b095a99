"""Canonical length-limited Huffman codes, packed and unpacked by arrays."""

from __future__ import annotations

import numpy as np

LEAST_LIMIT = 16
MOST_LIMIT = 24


def limit_for(symbols: int) -> int:
    """Longest code: 16 bits, or one more than it takes to number the symbols."""
    limit = max(LEAST_LIMIT, (max(symbols, 1) - 1).bit_length() + 1)
    if limit > MOST_LIMIT:
        raise ValueError(f"{symbols} different ids are too many for codes of {MOST_LIMIT} bits")
    return limit


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal lengths of at most `limit` bits by package-merge; 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    items, is_leaf = leaves, [np.ones(len(used), bool)]
    for _ in range(limit - 1):
        pairs = len(items) // 2 * 2
        merged = np.concatenate([leaves, items[0:pairs:2] + items[1:pairs:2]])
        order = np.argsort(merged, kind="stable")
        items = merged[order]
        is_leaf.append(order < len(used))
    taken, own = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for flags in reversed(is_leaf):
        n = int(flags[:taken].sum())
        own[:n] += 1
        taken = 2 * (taken - n)
    lengths[used] = own
    return lengths


class Code:
    """The canonical code of some lengths: shorter codes first, equal lengths by symbol."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        self.limit = int(max(self.lengths.max(initial=0), 1))
        used = np.flatnonzero(self.lengths)
        self.order = used[np.lexsort((used, self.lengths[used]))]
        size = np.int64(1) << (self.limit - self.lengths[self.order])
        ends = np.cumsum(size)
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[self.order] = (ends - size) >> (self.limit - self.lengths[self.order])
        # what the next `limit` bits stand for, symbol and length; the rest is never reached
        self.next = np.ones(1 << self.limit, np.int64)
        filled = int(ends[-1]) if len(ends) else 0
        self.next[:filled] = np.repeat(self.order << 5 | self.lengths[self.order], size)

    def pack(self, ids: np.ndarray, step: int) -> tuple[bytes, np.ndarray]:
        """The codes of some ids, first bit highest, and the bit offset of every `step`-th id."""
        sizes, codes = self.lengths[ids], self.codes[ids]
        if step % 2 == 0:  # two codes fit a word
            if len(ids) % 2:
                sizes, codes = np.append(sizes, 0), np.append(codes, np.uint64(0))
            codes = codes[::2] << sizes[1::2].astype(np.uint64) | codes[1::2]
            sizes, step = sizes[::2] + sizes[1::2], step // 2
        ends = np.cumsum(sizes)
        starts = ends - sizes
        n_bits = int(ends[-1]) if len(ends) else 0
        words = np.zeros(n_bits // 64 + 2, np.uint64)
        if len(ids):
            at = starts >> 6
            left = 64 - (starts & 63) - sizes
            over = left < 0
            head = np.where(
                over,
                codes >> np.where(over, -left, 0).astype(np.uint64),
                codes << np.where(over, 0, left).astype(np.uint64),
            )
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            words[at[first]] = np.bitwise_or.reduceat(head, first)
            words[at[over] + 1] |= codes[over] << (64 + left[over]).astype(np.uint64)
        return words.byteswap().tobytes()[: (n_bits + 7) // 8], starts[::step]

    def unpack(self, payloads: list[bytes], checkpoints: list[np.ndarray], step: int) -> np.ndarray:
        """Rows of `step` ids, one for each checkpoint of each payload, all advanced together.

        The last row of a payload goes on into zeros; the caller knows where ids end.
        """
        base = np.cumsum([0, *map(len, payloads)][:-1])
        # the last row ends less than `step` codes behind the payloads
        buffer = b"".join([*payloads, bytes(step * self.limit // 8 + 8)])
        ahead = np.ndarray(len(buffer) - 4, ">u4", buffer, strides=(1,))
        at = np.concatenate(
            [8 * b + c for b, c in zip(base, checkpoints, strict=True)] or [np.zeros(0, np.int64)]
        ).astype(np.int64)
        out = np.empty((step, len(at)), np.uint32)
        shift = 32 - self.limit
        for k in range(step):
            bits = ahead[at >> 3].astype(np.uint32)
            bits = (bits << (at & 7).astype(np.uint32)) >> np.uint32(shift)
            found = self.next[bits]
            out[k] = found >> 5
            at += found & 31
        return out.T
