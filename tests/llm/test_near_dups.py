import random
import re

import numpy as np
import pytest

from quireworks.llm import near_dups
from quireworks.llm.components import components
from tests.llm.conftest import MESSY

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def expected(rows, size=4):
    """(doc_id, n, component, kept) by comparing all pairs."""
    sets = [(doc_id, shingles(text, size)) for doc_id, text in rows]
    ids = sorted({d for d, _ in sets if d is not None})
    parent = {d: d for d in ids}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted(
        (str(d), len(x), None if d is None else find(d), d is None or find(d) == d) for d, x in sets
    )


def found(df):
    return sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_messy_rows(messy):
    assert found(near_dups.near_duplicates(messy)) == expected([row[:2] for row in MESSY])


def test_no_rows(none):
    assert near_dups.near_duplicates(none).collect() == []


def test_groups_chains_and_a_common_line(documents):
    """Copies of different closeness, a chain, pairs at the threshold, and a line in all texts."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    line = " ".join(words[:12])
    texts = []
    for group in range(12):
        base = rng.choices(words, k=rng.choice([6, 20, 60, 150]))
        for _ in range(rng.choice([1, 3, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    chain = rng.choices(words, k=100)
    for i in range(12):
        chain = list(chain)
        chain[i * 8 : i * 8 + 3] = rng.choices(words, k=3)
        texts.append(" ".join(chain).upper())
    for shared in (7, 8, 9):  # 8 of 10 shingles link, 7 do not
        start = rng.choices(words, k=shared + 3)
        texts += [" ".join(start + rng.choices(words, k=k)) for k in (1, 1)]
    texts += [f"{line}\n" + " ".join(rng.choices(words, k=20)) for _ in range(60)]
    texts += ["one two three", "One Two  three", "one two", "ONE two"]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 100))
    assert found(near_dups.near_duplicates(documents(rows))) == expected(rows)


def test_ids_with_several_texts(documents):
    """Links pass through every text of an id, also when the id names none of its classes."""
    texts = [" ".join(f"{name}{i}" for i in range(30)) for name in "abcde"]
    a, b, c, d, e = texts
    rows = [(1, a), (5, a), (5, b), (6, b), (6, c), (9, c), (9, ""), (2, d), (3, d), (3, d), (10, e), (10, None), (None, a)]
    assert found(near_dups.near_duplicates(documents(rows[:3]))) == expected(rows[:3])
    assert found(near_dups.near_duplicates(documents(rows))) == expected(rows)


def test_blocks_are_bounded_in_hashes(spark):
    members = [(1, 100)] * 600 + [(2, 400_000)] * 50 + [(3, 5)]
    found = near_dups._family_blocks(spark.createDataFrame(members, "family long, n long")).collect()
    assert {r.family: r.blocks for r in found} == {1: 3, 2: -(-20_000_000 // near_dups._FAMILY_HASHES), 3: 1}


def test_matches_miss_few_pairs_at_any_percent():
    rng = np.random.default_rng(3)
    assert near_dups.matches(80) == 35 and near_dups.matches(100) == 63
    for percent in (20, 50, 60, 70, 80, 95):
        agree = rng.binomial(near_dups.COORDINATES, percent / 100, 200_000)
        assert (agree < near_dups.matches(percent)).mean() < 5e-5
    for percent in (0, 10, 18, 101):
        with pytest.raises(ValueError):
            near_dups.matches(percent)


def test_five_words(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(near_dups.near_duplicates(docs, 5)) == expected(rows, 5)


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)]
    links += [(200 + rng.randrange(80), 200 + rng.randrange(80)) for _ in range(60)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    df = spark.createDataFrame(links, "u long, v long")
    assert {r.node: r.component for r in components(df).collect()} == {x: find(x) for x in parent}
    assert components(df.limit(0)).collect() == []
