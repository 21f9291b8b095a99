"""Many literals at once in batches of texts, by hashes of windows.

The hash of every window of a text comes from running sums, in a few array operations for
each length there is a literal of. A bit array (a Bloom filter) tells which windows can be a
literal at all: first for the window's head, the longest power of two of characters in it, and
only where that is known, for the window itself. `Literals` also holds the literals
themselves and compares survivors character by character; `WindowFilter` is of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

#: Bits of the filter for each literal (its head and itself), and bits at most.
BITS_EACH = 64
MOST_BITS = 1 << 28
#: Characters worked on at a time; a longer text is worked on as a whole.
CHARS = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_HEAD = 1 << 40
# filters of different levels share no places
_LEVEL = 1 << 42


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the usual size only."""
    size = max(n, CHARS * 2)
    if size == CHARS * 2:
        if size not in _TABLES:
            _TABLES[size] = (_powers(_BASE, size), _powers(_INVERSE, size))
        return _TABLES[size]
    return _powers(_BASE, size), _powers(_INVERSE, size)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Sums:
    """Hashes of all windows of some characters."""

    def __init__(self, codes: np.ndarray) -> None:
        powers, self.inverse = _tables(len(codes))
        terms = (codes.astype(np.uint64) + np.uint64(1)) * powers[: len(codes)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def windows(self, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.inverse[at]


def head_of(length: int) -> int:
    return 1 << (length.bit_length() - 1)


def _places(hashes: np.ndarray, tag: int | np.ndarray, size: int) -> list[np.ndarray]:
    """Two bits of `size`, a power of two, for each hash."""
    own = hashes ^ (np.atleast_1d(np.asarray(tag, np.uint64)) * np.uint64(_BASE))
    shift = np.uint64(65 - size.bit_length())
    return [((own ^ (own >> np.uint64(29))) * m) >> shift for m in _MIX]


def tag_of(length: int, level: int) -> int:
    return length + level * _LEVEL


def literal_hashes(literals: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and lengths of literals."""
    lengths = np.array([len(x) for x in literals], np.int64)
    begin = np.cumsum(lengths) - lengths
    return Sums(codes_of("".join(literals))).windows(begin, lengths), lengths


def filter_bits(literals: int) -> int:
    """How many bits a filter for that many literals has."""
    return 1 << min(max(literals * BITS_EACH, 1 << 12), MOST_BITS).bit_length() - 1


def marks(literals: list[str], size: int) -> np.ndarray:
    """The bits of a filter of `size` bits that these literals, none empty, set."""
    if not literals:
        return np.zeros(0, np.uint64)
    lengths = np.array([len(x) for x in literals])
    begin = np.cumsum(lengths) - lengths
    sums = Sums(codes_of("".join(literals)))
    heads = np.array([head_of(int(n)) for n in lengths])
    tags = heads.astype(np.uint64) + np.uint64(_HEAD)
    found = _places(sums.windows(begin, heads), tags, size)
    found += _places(sums.windows(begin, lengths), lengths.astype(np.uint64), size)
    return np.unique(np.concatenate(found))


def packed(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of many rows, rising in each, as bytes, and where the bytes of each row begin: how
    far a span starts after the one before and how long it is, 7 bits a byte, the last one
    below 128."""
    if not len(starts):
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    steps = np.diff(starts, prepend=0)
    first = offsets[:-1][np.diff(offsets) > 0]
    steps[first] = starts[first]
    numbers = np.empty(2 * len(starts), np.uint64)
    numbers[::2], numbers[1::2] = steps, ends - starts
    sizes = np.ones(len(numbers), np.int64)
    for k in range(1, 5):
        sizes += numbers >= np.uint64(1 << 7 * k)
    places = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    out = np.empty(places[-1], np.uint8)
    some = np.arange(len(numbers))
    for k in range(5):
        some = some[sizes[some] > k]
        part = (numbers[some] >> np.uint64(7 * k)) & np.uint64(127)
        out[places[some] + k] = part + np.where(sizes[some] > k + 1, 128, 0).astype(np.uint64)
    return out, places[2 * offsets]


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The spans of one row of `packed`."""
    some = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(some < 128)
    begin = np.concatenate([np.zeros(1, np.int64), last[:-1] + 1])[: len(last)]
    if len(last) == len(some):
        numbers = some.astype(np.int64)
    else:
        place = np.arange(len(some)) - np.repeat(begin, last - begin + 1)
        numbers = np.add.reduceat((some & 127).astype(np.int64) << 7 * place, begin)
    starts = np.cumsum(numbers[::2])
    return starts, starts + numbers[1::2]


def own_marks(literals: list[str], size: int, level: int) -> np.ndarray:
    """The bits that literals, none empty, set in a filter of a level, which tests no heads."""
    if not literals:
        return np.zeros(0, np.uint64)
    hashes, lengths = literal_hashes(literals)
    tags = lengths.astype(np.uint64) + np.uint64(level * _LEVEL)
    return np.unique(np.concatenate(_places(hashes, tags, size)))


@dataclass(frozen=True)
class WindowFilter:
    """Which windows can be literals: `lengths` there are, rising, and the bits, 64 a word."""

    lengths: tuple[int, ...]
    words: np.ndarray

    @classmethod
    def of(cls, lengths: tuple[int, ...], bits: np.ndarray, size: int) -> WindowFilter:
        words = np.zeros(size // 64, np.uint64)
        np.bitwise_or.at(words, (bits >> np.uint64(6)).astype(np.int64), _bit(bits))
        return cls(lengths, words)

    def has(self, hashes: np.ndarray, tag: int | np.ndarray) -> np.ndarray:
        """Which hashes can be those of literals of a length."""
        known = np.ones(len(hashes), bool)
        for place in _places(hashes, tag, len(self.words) * 64):
            known &= (self.words[(place >> np.uint64(6)).astype(np.int64)] & _bit(place)) != 0
        return known

    def may_hold(self, literals: list[str], level: int) -> np.ndarray:
        """Which literals a filter of a `level` can have."""
        hashes, lengths = literal_hashes(literals)
        return self.has(hashes, lengths.astype(np.uint64) + np.uint64(level * _LEVEL))

    def survivors(
        self, codes: np.ndarray, room: np.ndarray
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """`length, places, hashes` of windows that can be literals, by rising length. `room`
        is the number of characters from each place to the end of its text."""
        sums, at, head = Sums(codes), np.zeros(0, np.int64), 0
        for length in self.lengths:
            if head_of(length) != head:
                head = head_of(length)
                at = np.flatnonzero(room >= head)
                at = at[self.has(sums.windows(at, head), _HEAD + head)]
            some = at[room[at] >= length]
            hashes = sums.windows(some, length)
            known = self.has(hashes, length)
            yield length, some[known], hashes[known]


def _bit(places: np.ndarray) -> np.ndarray:
    return np.uint64(1) << (places & np.uint64(63))


class Batch:
    """Some texts as one array of characters."""

    def __init__(self, texts: list[str | None]) -> None:
        self.sizes = np.array([len(t or "") for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.text = "".join(t or "" for t in texts)

    @cached_property
    def codes(self) -> np.ndarray:
        return codes_of(self.text)

    @cached_property
    def room(self) -> np.ndarray:
        return np.repeat(self.ends, self.sizes) - np.arange(len(self.codes))

    def rows(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")


def batches(texts: list[str | None]) -> Iterator[Batch]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= CHARS:
            yield Batch(held)
            held, size = [], 0
    if held:
        yield Batch(held)


@dataclass(frozen=True)
class Literals:
    """Literals by hash, with their characters."""

    filter: WindowFilter
    hashes: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray
    codes: np.ndarray

    @classmethod
    def of(cls, literals: list[str]) -> Literals:
        some = sorted(set(literals) - {""})
        size = filter_bits(len(some))
        lengths = np.array([len(x) for x in some], np.int64)
        codes = codes_of("".join(some))
        begins = np.cumsum(lengths) - lengths
        hashes = Sums(codes).windows(begins, lengths)
        order = np.lexsort((lengths, hashes))
        filter_ = WindowFilter.of(tuple(np.unique(lengths).tolist()), marks(some, size), size)
        return cls(filter_, hashes[order], begins[order], lengths[order], codes)

    def holds(
        self, batch: Batch, at: np.ndarray, hashes: np.ndarray, length: int
    ) -> np.ndarray:
        """Which windows of a batch, of one length, are literals."""
        found = np.zeros(len(at), bool)
        slot, open_ = np.searchsorted(self.hashes, hashes), np.arange(len(at))
        if not len(self.hashes):
            return found
        # literals of one hash stand side by side
        while len(open_):
            near = np.minimum(slot[open_], len(self.hashes) - 1)
            open_ = open_[(self.hashes[near] == hashes[open_]) & (slot[open_] < len(self.hashes))]
            near = slot[open_]
            same = self.lengths[near] == length
            for k in range(length):
                if not same.any():
                    break
                own = np.flatnonzero(same)
                same[own] = (
                    batch.codes[at[open_[own]] + k] == self.codes[self.begins[near[own]] + k]
                )
            found[open_[same]] = True
            open_ = open_[~same]
            slot[open_] += 1
        return found

    def longest(self, batch: Batch) -> np.ndarray:
        """At each place of a batch the length of the longest literal that starts there."""
        best = np.zeros(len(batch.codes), np.int32)
        for length, at, hashes in self.filter.survivors(batch.codes, batch.room):
            best[at[self.holds(batch, at, hashes, length)]] = length
        return best
