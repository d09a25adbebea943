import re
from collections import Counter

import numpy as np

from quireworks.llm import quality
from tests.llm.conftest import MESSY


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
    seen, same = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            same += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), same, len(covered)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def check(docs, rows):
    expected = Counter((doc_id, *counts(text)) for doc_id, text in rows)
    assert Counter((r.doc_id, *(r[n] for n in NAMES)) for r in quality.quality(docs).collect()) == expected


def test_counts_of_messy_rows(messy, documents):
    check(messy, [(row[0], row[1]) for row in MESSY])
    odd = ["a b c d e a b c d e", "x\nx\n \n\nx \ny\n", "###\u0085é é\x1c b", "a b c d\ne a b c d e", "🙂 " * 12]
    check(documents(list(enumerate(odd))), list(enumerate(odd)))


def test_no_rows(none):
    assert quality.quality(none).collect() == []


def test_estimate_finds_the_classes():
    rng = np.random.default_rng(3)
    good = rng.random(5000) < 0.8
    fires = np.where(good[:, None], 0.01, [0.6, 0.4, 0.5, 0.3])
    votes = -(rng.random((5000, 4)) < fires).astype(int)
    speaks = (rng.random(5000) < np.where(good, 0.95, 0.2)).astype(int)
    table, inverse, times = np.unique(np.column_stack([votes, speaks]), axis=0, return_inverse=True, return_counts=True)
    posterior = quality.estimate(table, times)[inverse.ravel()]
    assert ((posterior >= 0.5) == good).mean() > 0.93


def test_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = quality.op6_quality(spark, folder).filter("NOT base_failed").join(labels, "doc_id").collect()
    good = [r.kept for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.15
