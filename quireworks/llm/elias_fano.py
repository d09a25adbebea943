"""Elias-Fano sequences and an n-gram trie made of them, laid out to be mapped without parsing.

A rising sequence keeps the low bits of its numbers in a packed array; the high bits are
unary in a bit vector. A trie keeps, for each level, the last ids of its n-grams, the
pointers to their successors in the next level, and 16-bit codes. Ids rise only among
siblings, so each range of siblings is shifted by the last number of the range before:
the whole level rises, and an id is searched relative to its context's shift.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_WORDS = 8  # 64-bit words of a block of the rank directory


@dataclass(frozen=True)
class EliasFano:
    """Numbers that never fall, all queries for many places or numbers at once."""

    n: int
    low_bits: int
    lows: np.ndarray
    highs: np.ndarray
    ranks: np.ndarray

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        n = len(values)
        most = int(values[-1]) if n else 0
        low_bits = max(0, ((most + 1) // max(n, 1)).bit_length() - 1)
        bits = np.zeros(-(-(n + (most >> low_bits) + 1) // (64 * _WORDS)) * 64 * _WORDS, np.uint8)
        bits[(values >> low_bits) + np.arange(n)] = 1
        highs = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(highs).reshape(-1, _WORDS).sum(1, dtype=np.int64)
        return EliasFano(n, low_bits, _pack_lows(values, low_bits), highs, np.concatenate([[0], np.cumsum(ones)]))

    def get(self, places: np.ndarray) -> np.ndarray:
        return (self._select(places, False) - places) << self.low_bits | self._low(places)

    def search(self, values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first place from ``begin`` on, before ``end``, of a number not below the value; else ``end``."""
        high, low = values >> self.low_bits, values & ((1 << self.low_bits) - 1)
        lo, hi = np.clip(self._before(high), begin, end), np.clip(self._before(high + 1), begin, end)
        going = np.flatnonzero(lo < hi)
        while len(going):
            middle = (lo[going] + hi[going]) // 2
            less = self._low(middle) < low[going]
            lo[going] = np.where(less, middle + 1, lo[going])
            hi[going] = np.where(less, hi[going], middle)
            going = going[lo[going] < hi[going]]
        return lo

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many numbers have smaller high bits: the ones before that many zeros."""
        zeros = 64 * len(self.highs) - int(self.ranks[-1])
        known = np.clip(high - 1, 0, max(zeros - 1, 0))
        found = np.minimum(self._select(known, True) - known, self.n)
        return np.where(high <= 0, 0, found)

    def _low(self, places: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(places), np.int64)
        bit = places * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        over = self.lows[word + 1] << (np.uint64(63) - shift) << np.uint64(1)
        return ((self.lows[word] >> shift | over) & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def _select(self, k: np.ndarray, zeros: bool) -> np.ndarray:
        """The place in the bit vector of the k-th one (or zero)."""
        size = 64 * _WORDS
        ranks = np.arange(len(self.ranks)) * size - self.ranks if zeros else self.ranks
        block = np.searchsorted(ranks, k, "right") - 1
        left, word = k - ranks[block], block * _WORDS
        for _ in range(_WORDS - 1):
            ones = np.bitwise_count(self.highs[word]).astype(np.int64)
            count = 64 - ones if zeros else ones
            on = left >= count
            left = left - np.where(on, count, 0)
            word = word + on
        bits, at = ~self.highs[word] if zeros else self.highs[word], np.zeros(len(k), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(bits & np.uint64((1 << half) - 1)).astype(np.int64)
            on = left >= count
            left = left - np.where(on, count, 0)
            bits = np.where(on, bits >> np.uint64(half), bits)
            at += np.where(on, half, 0)
        return 64 * word + at


def _pack_lows(values: np.ndarray, low_bits: int) -> np.ndarray:
    parts = []
    for at in range(0, len(values) if low_bits else 0, 1 << 16):
        part = values[at : at + (1 << 16), None] >> np.arange(low_bits) & 1
        parts.append(np.packbits(part.astype(np.uint8).ravel(), bitorder="little"))
    flat = np.concatenate([*parts, np.zeros(16, np.uint8)])
    return np.concatenate([flat, np.zeros(-len(flat) % 8, np.uint8)]).view(np.uint64)


@dataclass(frozen=True)
class Level:
    ids: EliasFano
    codes: np.ndarray
    pointers: EliasFano | None  # to the successors: those of node i begin at pointers[i]


@dataclass(frozen=True)
class Trie:
    levels: tuple[Level, ...]

    @staticmethod
    def of(columns: list[np.ndarray], codes: list[np.ndarray]) -> Trie:
        """Of distinct n-grams sorted by their columns; ``codes`` has those of each level's nodes."""
        n = len(columns[0])
        levels: list[Level] = []
        fresh = np.zeros(n, bool)
        begins: list[np.ndarray] = []
        for k, column in enumerate(columns):
            parent_starts = fresh.copy()
            fresh[:1] = True
            fresh[1:] |= column[1:] != column[:-1]
            nodes = np.flatnonzero(fresh)
            ids = column[nodes]
            if k:
                first = np.flatnonzero(parent_starts[nodes])
                begins.append(np.concatenate([first, [len(nodes)]]))
                last = np.concatenate([[0], np.cumsum(ids[begins[-1][1:] - 1])])[:-1].astype(np.int64)
                ids = ids + np.repeat(last, np.diff(begins[-1]))
            levels.append(Level(EliasFano.of(ids), codes[k], None))
        pointers = [*map(EliasFano.of, begins), None]
        return Trie(tuple(Level(x.ids, x.codes, p) for x, p in zip(levels, pointers)))

    def find(self, columns: list[np.ndarray]) -> np.ndarray:
        """The node of each n-gram in the level of its length, -1 where it isn't there."""
        count = len(columns[0])
        node, there = np.zeros(count, np.int64), np.ones(count, bool)
        for k, column in enumerate(columns):
            level, asked = self.levels[k], np.flatnonzero(there)
            if k:
                up = self.levels[k - 1].pointers
                begin, end = up.get(node[asked]), up.get(node[asked] + 1)
                shift = np.where(begin > 0, level.ids.get(np.maximum(begin - 1, 0)), 0)
            else:
                begin, end, shift = np.zeros(len(asked), np.int64), np.full(len(asked), level.ids.n), 0
            wanted = column[asked] + shift
            place = level.ids.search(wanted, begin, end)
            found = np.flatnonzero(place < end)
            found = found[level.ids.get(place[found]) == wanted[found]]
            there[:] = False
            there[asked[found]] = True
            node[asked[found]] = place[found]
        return np.where(there, node, -1)

    def tobytes(self) -> bytes:
        """Lengths and arrays, each from a multiple of eight bytes on."""
        arrays: list[np.ndarray] = []
        heads: list[tuple] = []
        for level in self.levels:
            for part in (level.ids, level.pointers):
                heads.append((part.n, part.low_bits, len(part.lows), len(part.highs)) if part else (-1, 0, 0, 0))
                arrays += [part.lows, part.highs, part.ranks] if part else []
            arrays.append(np.concatenate([level.codes, np.zeros(-len(level.codes) % 4, np.uint16)]))
        head = struct.pack("<q", len(self.levels)) + b"".join(struct.pack("<4q", *x) for x in heads)
        return head + b"".join(x.tobytes() for x in arrays)

    @staticmethod
    def map(data: bytes | memoryview | np.ndarray) -> Trie:
        """A view of what ``tobytes`` gave, in memory or a mapped file: nothing is copied."""
        data = np.frombuffer(data, np.uint8)
        count = int(data[:8].view(np.int64)[0])
        heads = data[8 : 8 + 64 * count].view(np.int64).reshape(count, 2, 4).tolist()
        at = 8 + 64 * count

        def take(n: int, kind: type) -> np.ndarray:
            nonlocal at
            out = data[at : at + n * np.dtype(kind).itemsize].view(kind)
            at += n * np.dtype(kind).itemsize
            return out

        def part(n: int, low_bits: int, lows: int, highs: int) -> EliasFano | None:
            if n < 0:
                return None
            return EliasFano(n, low_bits, take(lows, np.uint64), take(highs, np.uint64), take(highs // _WORDS + 1, np.int64))

        levels = []
        for ids, pointers in heads:
            own, up = part(*ids), part(*pointers)
            codes = take(-(-own.n // 4) * 4, np.uint16)[: own.n]
            levels.append(Level(own, codes, up))
        return Trie(tuple(levels))

    def sizes(self) -> Iterator[int]:
        return (level.ids.n for level in self.levels)
