import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quireworks.llm import packing
from tests.llm.conftest import MESSY


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path(packing.TOKENIZER))


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(5)
    parts = ["Don't", "STOP", "it's", "Áb", "x.y,", "12", "3a", "<|endoftext|>", "<|STARTOFTEXT|>", "é", "中文",
             "🙂", "'s", "--", " ", " ", "\x1c", "\x85", "ab;", "Σας", "ﬁ", "!", "<", "̸"]
    texts = ["".join(rng.choice(["", " ", "\n", "\t  "]) + rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    found = packing.WordEncoder(packing.tokenizer_path(packing.TOKENIZER)).ids([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def check(rows, expected):
    """Pieces give each document back, and sequences are gapless and need no padding."""
    pieces, sequences = {}, {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and at & (at - 1) == 0
    total = sum(len(x) for _, x in expected)
    assert sum(r.length for r in rows) == total
    texts = {}
    for doc_id, ids in expected:
        texts.setdefault((doc_id, len(ids)), []).append(np.array(ids, np.uint32).tobytes())
    for key, own in pieces.items():
        own = sorted(own, key=lambda r: r.start)
        times = len(texts[key])
        if times == 1:
            assert b"".join(r.ids for r in own) == texts[key][0]
            assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        else:
            assert sum(r.length for r in own) == times * key[1]


def test_messy_rows(messy, tokenizer):
    rows = packing.pack_documents(messy.repartition(2)).collect()
    check(rows, [(row[0], whole(tokenizer, row[1])) for row in MESSY])


def test_no_rows(none):
    assert packing.pack_documents(none).collect() == []


def test_small(spark, small, tokenizer):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    check(packing.pack_documents(docs).collect(), [(r.doc_id, whole(tokenizer, r.text)) for r in docs.collect()])


def test_fill_finds_the_least_slack():
    rng = random.Random(9)
    for _ in range(300):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        capacity = rng.randint(30, 60)
        packer = packing.Packer(capacity, 10**9, 0)
        for n in lengths:
            packer._put(packing.Document(0, b"\0" * 4 * n), 0, n)
        seed = max(lengths)
        chosen = packer.fill(capacity - seed, seed)
        rest = list(lengths)
        rest.remove(seed)
        sums = {0}
        for n in rest:
            sums |= {s + n for s in sums}
        best = max(s for s in sums if s <= capacity - seed)
        assert sum(n * c for n, c in chosen.items()) == best
        assert all(c <= rest.count(n) for n, c in chosen.items())


def test_windows_without_an_exact_fill_are_cut():
    packer = packing.Packer(16, 10**9, 0)
    docs = [packing.Document(i, b"\0" * 4 * 11) for i in range(7)]
    for doc in docs:
        packer.add(doc)
    packer.finish()
    lengths = {}
    for _, _, length, sequence, _ in packer.out:
        lengths[sequence] = lengths.get(sequence, 0) + length
    assert sorted(lengths.values(), reverse=True) == [16, 16, 16, 16, 8, 4, 1]


def test_words_of_letters_equal_the_tokenizer(tokenizer):
    """All Latin letters, alone and in words, in both cases."""
    letters = [chr(c) for c in range(0x41, 0x300) if chr(c).isalpha()]
    rng = random.Random(9)
    texts = letters + ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(3000)]
    texts += ["".join(rng.choices("aeinrstéüßÉÜ", k=rng.randint(2, 12))) for _ in range(3000)]
    found = packing.WordEncoder(packing.tokenizer_path(packing.TOKENIZER)).ids([t.encode() for t in texts])
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
