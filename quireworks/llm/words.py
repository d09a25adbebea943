"""Words of many texts at once: bounded caches and vectorised hashes."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable
from types import ModuleType

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SEGMENT = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def kept_by_worker(name: str) -> dict:
    """A dictionary that a Python worker keeps between its tasks.

    The package's functions travel by value, and what they hold in globals of their own
    goes with the task.
    """
    place = sys.modules.setdefault("_quireworks_kept", ModuleType("_quireworks_kept"))
    return place.__dict__.setdefault(name, {})


class WordCache:
    """Values of words, computed once while they keep coming.

    Two generations of about ``limit`` words each (fewer where they are long) bound the
    memory; what is forgotten is computed again, so the limit changes no result.
    """

    def __init__(self, compute: Callable[[list], Iterable], limit: int = 300_000):
        self.compute, self.limit = compute, limit
        self.new: dict = {}
        self.old: dict = {}
        self.held = 0

    def ready(self, words: Iterable) -> dict:
        """A dictionary that holds all of the words, good until the next call."""
        if len(self.new) > self.limit or self.held > 40 * self.limit:
            self.old, self.new = (self.new if self.held < 80 * self.limit else {}), {}
            self.held = 0
        new, old, missing = self.new, self.old, []
        for word in set(words).difference(new):
            value = old.get(word)
            if value is None:
                missing.append(word)
            else:
                new[word] = value
        if missing:
            new.update(zip(missing, self.compute(missing)))
            self.held += sum(map(len, missing))
        return new


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    size = max(_SEGMENT, 1 << (n - 1).bit_length())
    tables = kept_by_worker("powers")
    if size not in tables:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        up, down = np.full(size, _BASE), np.full(size, inverse)
        up[0] = down[0] = 1
        if len(tables) > 1:
            tables.pop(max(tables))  # that of an unusually long word
        tables[size] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return tables[size]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; the words must be in order.

    Polynomials modulo 2**64 by running sums over segments of about a megabyte.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, begin + _SEGMENT, "right")))
        stop = ends[to - 1]
        up, down = _powers(int(stop - begin))
        sums = np.zeros(stop - begin + 1, np.uint64)
        np.cumsum((data[begin:stop].astype(np.uint64) + np.uint64(1)) * up[: stop - begin], out=sums[1:])
        s, e = starts[at:to] - begin, ends[at:to] - begin
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


class Texts:
    """The words of a list of texts as flat arrays: text i has words first[i]:first[i + 1]."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        blob = b"\n".join(texts)
        self.data = np.frombuffer(blob.lower() if lower else blob, np.uint8)  # A-Z only
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begins = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.starts, self.ends = word_spans(self.data)
        self.first = np.searchsorted(self.starts, self.begins)
        self.first[-1] = len(self.starts)

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out = (out ^ hashes[k : k + count]) * np.uint64(0xFF51AFD7ED558CCD) + np.uint64(2 * k + 1)
        out ^= out >> np.uint64(29)
    return mix(out)
