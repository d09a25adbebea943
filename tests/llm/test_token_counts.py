import random

import pytest
from tokenizers import Tokenizer, models, normalizers

from quireworks.llm import token_counts
from quireworks.llm.packing import tokenizer_path
from tests.llm.conftest import MESSY


def library(vocabulary, by_bytes):
    pieces = [(piece or f"<control {i}>", score) for i, (piece, score) in enumerate(vocabulary)]
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=by_bytes))
    tokenizer.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.read_vocabulary(tokenizer_path(token_counts.VOCABULARY))


def test_counts_equal_the_tokenizer(vocabulary):
    count = library(vocabulary, True)
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab  the\n\tñé中🙂▁1", k=rng.randint(0, 40))) for _ in range(3000)]
    texts += [row[1] or "" for row in MESSY] + ["a" * 3000, " " * 500]
    for text, (n, _) in zip(texts, token_counts.PieceCounter(vocabulary).count(texts)):
        assert n == count(text), text


def test_ties_and_small_vocabularies():
    rng = random.Random(7)
    for trial in range(150):
        scores = [-1.0, -2.0] if trial % 2 else [-1.0, -2.0, -0.5, -1.25]
        pieces = {"".join(rng.choices("abc▁", k=rng.randint(1, 4))) for _ in range(rng.randint(1, 12))}
        vocabulary = [("", 0.0), *((p, rng.choice(scores)) for p in sorted(pieces))]
        count, own = library(vocabulary, False), token_counts.PieceCounter(vocabulary)
        texts = ["".join(rng.choices("abcd ", k=rng.randint(0, 20))) for _ in range(30)]
        for text, (n, _) in zip(texts, own.count(texts)):
            assert n == count(text), (vocabulary, text)


def test_score_is_the_best(vocabulary):
    pieces = {p: s for p, s in vocabulary if p}
    counter = token_counts.PieceCounter(vocabulary)

    def best(text):
        if not text:
            return 0.0
        found = [pieces[text[:n]] + best(text[n:]) for n in range(1, len(text) + 1) if text[:n] in pieces]
        return max(found)

    for word in ("▁the", "▁then", "▁nation", "abba"):
        assert counter.best(word)[1] == best(word)


def test_messy_rows(messy, none, vocabulary):
    count = library(vocabulary, True)
    found = sorted((str(r.doc_id), r.n_tokens) for r in token_counts.count_tokens(messy).collect())
    assert found == sorted((str(row[0]), count(row[1] or "")) for row in MESSY)
    assert token_counts.count_tokens(none).collect() == []
