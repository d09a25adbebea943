import bisect

import numpy as np
import pytest

from quireworks.llm.elias_fano import EliasFano, Trie


@pytest.mark.parametrize("n, most", [(1, 0), (1, 1 << 40), (5, 3), (1000, 50), (1000, 1000), (3000, 1 << 30), (70_000, 1 << 45)])
def test_sequence(n, most):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, most + 1, n))
    packed = EliasFano.of(values)
    assert (packed.get(np.arange(n)) == values).all()
    wanted = np.concatenate([rng.choice(values, 200), rng.integers(0, most + 2, 200), [0, most + 5, 2 * most + 9]])
    begin = rng.integers(0, n + 1, len(wanted))
    end = np.array([rng.integers(b, n + 1) for b in begin])
    found = packed.search(wanted, begin, end)
    own = values.tolist()
    assert found.tolist() == [bisect.bisect_left(own, w, b, e) for w, b, e in zip(wanted.tolist(), begin.tolist(), end.tolist())]


def test_size_follows_the_numbers_and_not_the_universe():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 100_000))
    packed = EliasFano.of(values)
    held = sum(x.nbytes for x in (packed.lows, packed.highs, packed.ranks))
    assert held * 8 / len(values) < 2 + np.log2((1 << 40) / len(values)) + 1


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_trie(order, tmp_path):
    rng = np.random.default_rng(order)
    grams = np.unique(rng.zipf(1.3, (4000, order)).clip(0, 5000) - 1, axis=0)
    codes = []
    for k in range(order):
        codes.append(np.arange(len(np.unique(grams[:, : k + 1], axis=0)), dtype=np.uint16))
    trie = Trie.of([grams[:, k].copy() for k in range(order)], codes)
    file = tmp_path / "trie"
    file.write_bytes(trie.tobytes())
    mapped = Trie.map(np.memmap(file, np.uint8, "r"))
    assert list(mapped.sizes()) == [len(c) for c in codes]
    for k in range(1, order + 1):
        known = {tuple(g): i for i, g in enumerate(np.unique(grams[:, :k], axis=0).tolist())}
        asked = np.concatenate([grams[:, :k], rng.zipf(1.3, (4000, k)).clip(0, 6000) - 1])
        found = mapped.find([asked[:, j].copy() for j in range(k)])
        assert found.tolist() == [known.get(tuple(g), -1) for g in asked.tolist()]
        assert (mapped.levels[k - 1].codes[found[found >= 0]] == found[found >= 0]).all()


def test_empty_trie():
    none = np.zeros(0, np.int64)
    trie = Trie.map(Trie.of([none, none], [none.astype(np.uint16)] * 2).tobytes())
    assert trie.find([np.array([3]), np.array([4])]).tolist() == [-1]
