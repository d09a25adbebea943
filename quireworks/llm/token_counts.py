"""Operator 2: token counts of a unigram vocabulary without tokens.

An Aho-Corasick automaton enumerates the vocabulary's pieces in a text. Viterbi carries
the best score and the piece count to each position, and nothing else. Ties are decided as
the tokenizers do: of equal scores the path stays that was found first, which is the one
with the longest last piece; a character without a piece of its own may also be unknown, at
the lowest score less ten, and counts a piece for each of its bytes where the vocabulary has
byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quireworks.llm.common import map_batches, spread_table
from quireworks.llm.words import WordCache, kept_by_worker

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # fixed by the tokenizers
_SLICE = 1 << 20
_BYTE = re.compile(r"<0x[0-9A-F]{2}>\Z")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, by id; control pieces stand as empty strings."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        ("" if model.is_control(i) or model.is_unknown(i) else model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
    ]


class PieceCounter:
    """Counts pieces of whole texts.

    Spaces are written as the space mark and one is put before a text that isn't empty.
    Where all scores are whole numbers, sums don't round, and a text is cut where no piece
    reaches across: before space marks (if no piece has one after another character) and
    at line ends (if no piece has them). Parts that come again are counted once.
    """

    def __init__(self, pieces: Iterable[tuple[str, float]]):
        import ahocorasick

        vocabulary = list(pieces)
        self.lowest = min((score for _, score in vocabulary), default=0.0) - UNKNOWN_PENALTY
        byte_pieces = {piece for piece, _ in vocabulary if _BYTE.match(piece)}
        self.by_bytes = len(byte_pieces) == 256
        self.automaton = ahocorasick.Automaton()
        known: dict[str, float] = {}
        for piece, score in vocabulary:
            if piece:
                known[piece] = score
        for piece, score in known.items():
            self.automaton.add_word(piece, (len(piece), score))
        if known:
            self.automaton.make_automaton()
        self.empty = not known
        whole = all(float(score).is_integer() for _, score in vocabulary)
        inner = any(SPACE in piece.lstrip(SPACE) for piece in known)
        lines = any("\n" in piece for piece in known)
        self.parts = None
        if whole and not inner:
            self.parts = re.compile(
                f"{SPACE}*[^{SPACE}]+|{SPACE}+" if lines else f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+"
            )
        self.cache = WordCache(lambda parts: map(self.best, parts))

    def best(self, text: str) -> tuple[int, float]:
        """Pieces and score of the best path through a part."""
        size = len(text)
        ends: list[list] = [[] for _ in range(size + 1)]
        if not self.empty:
            for end, match in self.automaton.iter(text):  # of one end, the longest first
                ends[end + 1].append(match)
        scores, counts, unknown = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        for end in range(1, size + 1):
            top, at, single = None, 0, False
            for length, score in ends[end]:
                candidate = scores[end - length] + score
                if top is None or candidate > top:
                    top, at = candidate, length
                single = single or length == 1
            if not single:
                candidate = scores[end - 1] + self.lowest
                if top is None or candidate > top:
                    top, at = candidate, 0
            scores[end] = top
            if at:
                counts[end] = counts[end - at] + 1
            elif self.by_bytes:
                counts[end] = counts[end - 1] + len(text[end - 1].encode("utf-8", "replace"))
            else:  # unknown characters in a row are one piece
                counts[end] = counts[end - 1] + (not unknown[end - 1])
            unknown[end] = not at
        return counts[size], scores[size]

    def count(self, texts: list[str]) -> Iterator[tuple[int, float]]:
        """Pieces and score of each text."""
        marked = [SPACE + text.replace(" ", SPACE) if text else "" for text in texts]
        if self.parts is None or not self.by_bytes:
            yield from map(self.best, marked)
            return
        cut = [self.parts.findall(text) for text in marked]
        known = self.cache.ready(part for parts in cut for part in parts)
        for parts in cut:
            found = list(map(known.__getitem__, parts))
            yield sum(n for n, _ in found), sum(score for _, score in found)


def counter(path: str) -> PieceCounter:
    kept = kept_by_worker("counters")
    if path not in kept:
        kept[path] = PieceCounter(read_vocabulary(path))
    return kept[path]


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, score) of documents (doc_id, text), counted over whole texts.

    Null and empty texts have 0 tokens and score 0. Repeated rows give rows of their own,
    ids may be null, an empty table gives no rows, other columns are ignored. ``path`` names
    a model file that the executors can read.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [text or "" for text in batch.column(1).to_pylist()]
        found: list[tuple[int, float]] = []
        at = 0
        while at < len(texts):
            to, size = at + 1, len(texts[at])
            while to < len(texts) and size < _SLICE:
                size += len(texts[to])
                to += 1
            found += counter(path).count(texts[at:to])
            at = to
        counts, scores = zip(*found)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())],
            names=["doc_id", "n_tokens", "score"],
        )

    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, n_tokens long, score double")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and score of all documents."""
    return count_tokens(spread_table(spark, sf_dir, "documents"))
