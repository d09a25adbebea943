import hashlib
import random

import numpy as np
import pytest

from quireworks.llm import repeats
from tests.llm.conftest import MESSY


def expected(rows, length=100):
    """Each row's counts, by a dictionary of all strings of the length."""
    first = {}
    for doc_id, text in rows:
        for p in range(len(text) - length + 1):
            key = text[p : p + length]
            here = (-1 if doc_id is None else doc_id, p)
            first[key] = min(first.get(key, here), here)
    out = []
    for doc_id, text in rows:
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            if first[text[p : p + length]] < (-1 if doc_id is None else doc_id, p):
                gone[p : p + length] = True
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((str(doc_id), len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out)


def found(df):
    return sorted(
        (str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in df.collect()
    )


def test_messy_rows(messy):
    rows = [(row[0], (row[1] or "").encode()) for row in MESSY]
    assert found(repeats.remove_repeats(messy.repartition(3))) == expected(rows)


def test_no_rows(none):
    assert repeats.remove_repeats(none).collect() == []


@pytest.mark.parametrize("many", [repeats._MANY, 1])
def test_passages_edges_and_runs(documents, monkeypatch, many):
    """Shared passages with other edges, near copies, runs of one character, short periods."""
    monkeypatch.setattr(repeats, "_MANY", many)
    rng = random.Random(8)

    def noise(n):
        return "".join(rng.choices("abcdefgh é", k=n))

    passages = [noise(n) for n in (99, 100, 101, 150, 400)]
    texts = []
    for _ in range(40):
        parts = [noise(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(p) + 1), 2)) if rng.random() < 0.4 else (0, len(p))
            parts += [p[a:b], noise(rng.randint(0, 60))]
        texts.append("".join(parts))
    base = noise(700)
    for _ in range(15):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = "X"
        texts.append("".join(copy))
    texts += ["a" * 350, "a" * 120, "ab" * 130, "abc" * 90 + noise(30), noise(50) + "ab" * 80]
    rows = [(i, text) for i, text in enumerate(texts)]
    rng.shuffle(rows)
    wanted = expected([(d, t.encode()) for d, t in rows])
    for parts in (1, 5):
        assert found(repeats.remove_repeats(documents(rows).repartition(parts))) == wanted


def test_other_lengths(documents):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices("ab", k=rng.randint(0, 120)))) for i in range(25)]
    wanted = expected([(d, t.encode()) for d, t in rows], 24)
    assert found(repeats.remove_repeats(documents(rows), 24, 8)) == wanted


def test_long_texts_in_segments(documents, monkeypatch):
    monkeypatch.setattr(repeats, "_SEGMENT", 200)
    monkeypatch.setattr(repeats, "_SLICE", 500)
    rng = random.Random(6)
    base = "".join(rng.choices("abcdefghij ", k=3000))
    rows = [(1, base), (2, base[700:2500] + "tail" * 40), (3, "x" + base[:1200] + base[:1200])]
    texts = [t.encode() for _, t in rows]
    whole = {}
    for i, start, number, *_ in zip(*repeats.phrases(texts)):
        for p in range(start, start + number):
            assert (i, p) not in whole
            whole[i, p] = True
    assert len(whole) == sum(len(t) - 99 for t in texts)


def test_places_grow_with_the_texts_and_not_their_square(documents):
    """Texts without id, and texts of one id, don't carry each other's places."""
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh ", k=1500))

    def places(count, doc_id):
        rows = [(doc_id, "".join(rng.choices("abcdefgh ", k=40 + i)) + passage) for i in range(count)]
        found = repeats.repeats(documents(rows)).collect()
        assert len(found) == count
        return sum(len(r.places or []) for r in found)

    for doc_id in (None, 7):
        assert places(80, doc_id) < 6 * places(20, doc_id)


def test_rows_that_ask_leave_a_batch_in_the_order_of_places():
    """Neighbouring rows then share most bytes of their places, which the shuffle's codec uses."""
    import pyarrow as pa

    rng = random.Random(7)
    texts = [bytes(rng.randrange(97, 123) for _ in range(4000)) for _ in range(3)]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 1, 9]), pa.array(texts)], names=["doc", "text"])
    rows = repeats._phrase_rows(100, 32)(batch).to_pylist()
    asks = [(r["doc"], r["at"] >> 32) for r in rows if r["kind"] == repeats.ASK]
    by_text = [sorted(a for a in asks if a[0] == doc) for doc in (5, 1, 9)]
    assert asks == sum(by_text, []) and len(asks) > 50
