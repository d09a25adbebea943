import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireworks.llm import ngrams

from .conftest import LONG, MESSY


def held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0


def plain(rows):
    """Counts of words and pairs in dictionaries, probabilities without codes."""
    docs = []
    for doc_id, text, *_ in rows:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        docs.append((doc_id, [*re.findall("[^\x20\x09-\x0d]+", lower), None]))
    words, pairs, starts = Counter(), Counter(), Counter()
    for doc_id, tokens in docs:
        if not held(doc_id):
            words.update(tokens)
            for a, b in zip([""] + tokens, tokens):
                pairs[a, b] += 1
                starts[a] += 1
    n, v = words.total(), len(words)
    out = []
    for doc_id, tokens in docs:
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        score = 0.0
        for a, b in zip([""] + tokens, tokens):
            single = (words[b] + v / (v + 1)) / (n + v) if n else 1.0
            c = starts[a]
            m = ngrams.MASS * c**ngrams.GROWTH
            score += math.log10((pairs[a, b] + m * single) / (c + m) if c else single)
        known = sum(words[w] > 0 for w in tokens)
        out.append(((doc_id is None, doc_id or 0), held(doc_id), len(tokens), known, n, base, score))
    return sorted(out)


def run(docs, **sizes):
    found = ngrams.score_documents(docs, ngrams.held_out(F.col("doc_id")), **sizes).collect()
    return sorted(
        ((r.doc_id is None, r.doc_id or 0), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        for r in found
    )


def same(got, wanted):
    assert [x[:5] for x in got] == [x[:5] for x in wanted]
    for a, b in zip(got, wanted):
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
        assert abs(a[6] - b[6]) <= 1.5e-4 * a[2] + 1e-9


def some(count=300):
    rng = random.Random(7)
    words = [f"W{i}" for i in range(400)]
    return [
        (i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(400)], k=rng.randrange(60))) + f" only{i}") for i in range(count)
    ]


def test_equals_brute_force(documents):
    rows = some()
    same(run(documents(rows)), plain(rows))
    same(run(documents(rows), block_bytes=700, shard_words=20), plain(rows))


def test_hot_words_are_spread(documents, monkeypatch):
    monkeypatch.setattr(ngrams, "HOT", 50)
    rows = [(i, " ".join(f"the {random.Random(i).choice('abcdefgh')}{j % 9}" for j in range(40))) for i in range(80)]
    same(run(documents(rows), block_bytes=2000, shard_words=10), plain(rows))


def test_messy_rows(documents):
    same(run(documents(MESSY)), plain(MESSY))
    assert any(x[2] > 100_000 for x in plain([(6, LONG)]))


def test_no_rows_and_nothing_to_learn_from(documents, none):
    assert run(none) == []
    out = [i for i in range(60) if held(i)][:3]
    rows = [(out[0], "a b c"), (out[1], None), (out[2], "")]
    assert [x[5:] for x in run(documents(rows))] == [(0.0, 0.0)] * 3
    same(run(documents(rows)), plain(rows))


def test_probabilities_sum_to_one():
    counts = np.array([3, 1, 0, 7, 2])
    c, v = 20, len(counts)
    m = ngrams.mass(np.array([c]))[0]
    single = (np.append(np.array([9, 4, 2, 30, 5]), 0) + v / (v + 1)) / (50 + v)
    total = sum((np.append(counts, 7 * 0)[i] + m * single[i]) / (c + m) for i in range(v + 1))
    assert single.sum() == pytest.approx(1) and total == pytest.approx((13 + m) / (20 + m))


def test_codes():
    shares = 10.0 ** -np.linspace(0, 15.9, 1000)
    back = ngrams.shares_of(ngrams.share_codes(shares))
    assert np.abs(np.log10(back) - np.log10(shares)).max() <= 0.5 / ngrams._STEPS + 1e-9
    for values in ([], [0], [5, 0, 1 << 40], list(range(1000))):
        assert ngrams.unpack(ngrams.pack(np.array(values, np.int64))).tolist() == values


def test_held_out_texts_are_likelier_than_by_single_words(spark, small):
    found = ngrams.op12_scores(spark, small.replace("0.001", "0.01")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]
