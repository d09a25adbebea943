"""Operator 7: packing token sequences by minimum bin slack.

Documents longer than a sequence give full sequences first. The rest of each goes to a
pool of remaining lengths. A window takes the longest length of the pool and fills what is
left by subset-sum dynamic programming over a bitset of reachable sums; going back
through the bitsets gives how many of each length. The same multiset is taken again while
the pool holds it. Where no multiset fills the window, one more document is cut to fill
it, and the last tokens of a task are cut to powers of two, which need no padding.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from quireworks.llm.common import as_bytes, spread_table
from quireworks.llm.words import WordCache, kept_by_worker, word_hashes

CAPACITY = 2048
END = 1
TOKENIZER = "word_bpe_49k.json"
_POOL_HIGH, _POOL_LOW = 400_000, 100_000  # tokens that wait in a task
_FLUSH = 8 << 20

SCHEMA = (
    "doc_id long, start long, length long, ids binary, ids_crc32 long, "
    "doc_tokens long, sequence_id long, offset long"
)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Token ids of whole texts for a tokenizer that drops white space, keeps words apart from
    other characters and lowers case.

    A text is cut at ASCII white space and between an ASCII letter and another ASCII
    character that is no apostrophe: no token and no normalisation reaches across. The
    different pieces of some megabytes are found by their 64-bit hashes, and each is
    encoded once while it keeps coming. Texts that may hold a special token, whose case
    counts, are cut at white space only.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces = WordCache(self._encode, 100_000)

    def _encode(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids of each piece. What is a word of letters that nothing would normalise goes to the
        tokenizer's model at once, its bytes written as the characters that stand for them."""
        others = iter(self.tokenizer.encode_batch([p.decode("utf-8", "replace") for p in pieces if not _plain(p)], add_special_tokens=False))
        tokenize = self.model.tokenize
        for piece in pieces:
            if piece.isalpha():
                ids = [token.id for token in tokenize(piece.decode("ascii").lower())]
            elif _plain(piece):
                text = piece.decode().lower().encode().decode("latin-1").translate(_BYTE_NAMES)
                ids = [token.id for token in tokenize(text)]
            else:
                ids = next(others).ids
            yield array("I", ids).tobytes()

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        special = [b"<|" in text for text in texts]
        plain = [b"" if odd else text for odd, text in zip(special, texts)]
        blob = b"\n".join(plain).lower()
        data = np.frombuffer(blob, np.uint8)
        starts, ends = piece_spans(data)
        hashes, first, at = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        pieces = [blob[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
        known = self.pieces.ready(pieces)
        values = list(map(known.__getitem__, pieces))
        flat = np.frombuffer(b"".join(values), np.uint32)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        offsets = np.cumsum(sizes) - sizes
        counts = sizes[at]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ids = flat[np.repeat(offsets[at] - upto[:-1], counts) + np.arange(upto[-1])]
        begins = np.concatenate([[0], np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain)) + 1)])
        edges = upto[np.searchsorted(starts, begins)].tolist()
        for i, text in enumerate(texts):
            if special[i]:
                words = text.split()
                found = self.pieces.ready(words)
                yield b"".join(map(found.__getitem__, words))
            else:
                yield ids[edges[i] : edges[i + 1]].tobytes()


# Byte-level vocabularies write a byte that is no visible Latin-1 character as the next one from 256 on.
_HIDDEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b)]
_BYTE_NAMES = {b: 256 + i for i, b in enumerate(_HIDDEN)}


def _plain(piece: bytes) -> bool:
    """Letters below U+0250 that stay letters in lower case: composed already, one lower-case letter each."""
    if piece.isascii():
        return piece.isalpha()
    text = piece.decode("utf-8", "replace").lower()
    return text.isalpha() and max(text) < "\u0250"


# Of each byte: 0 white space, 1 letter, 2 other ASCII, 3 apostrophe or not ASCII.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_CLASS[[0x27, *range(0x80, 0x100)]] = 3


def piece_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces: words, cut between letters and other ASCII characters."""
    kind = np.zeros(len(data) + 2, np.uint8)
    kind[1:-1] = _CLASS[data]
    before, after = kind[:-1], kind[1:]
    inside = (before ^ after) == 3  # 1 and 2, in either order
    start = ((before == 0) & (after != 0)) | (inside & (before != 0) & (after != 0))
    end = ((before != 0) & (after == 0)) | (inside & (before != 0) & (after != 0))
    return np.flatnonzero(start), np.flatnonzero(end)


def encoder(path: str) -> WordEncoder:
    kept = kept_by_worker("encoders")
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


class Document:
    __slots__ = ("doc_id", "ids")

    def __init__(self, doc_id: int | None, ids: bytes):
        self.doc_id, self.ids = doc_id, ids


class Packer:
    """Packs a stream of documents; ``out`` gets (document, start, length, sequence, offset)."""

    def __init__(self, capacity: int = CAPACITY, high: int = _POOL_HIGH, low: int = _POOL_LOW):
        self.capacity, self.high, self.low = capacity, high, low
        self.pool: dict[int, deque] = {}
        self.present = 0  # bit n: the pool holds a rest of n tokens
        self.waiting = 0
        self.sequences = 0
        self.out: list[tuple[Document, int, int, int, int]] = []

    def add(self, doc: Document) -> None:
        total = len(doc.ids) // 4
        start = 0
        while total - start >= self.capacity:
            self.out.append((doc, start, self.capacity, self.sequences, 0))
            self.sequences += 1
            start += self.capacity
        if start < total:
            self._put(doc, start, total - start)
        if self.waiting >= self.high:
            while self.waiting >= self.low:
                self._window()

    def finish(self) -> None:
        """Pack what waits; the last tokens go into sequences of powers of two."""
        while self.waiting >= self.capacity:
            self._window()
        while self.waiting:
            size = 1 << (self.waiting.bit_length() - 1)
            offset = 0
            while offset < size:
                length = self._longest(self.capacity)
                offset = self._place(length, min(length, size - offset), offset)
            self.sequences += 1

    def _put(self, doc: Document, start: int, length: int) -> None:
        self.pool.setdefault(length, deque()).append((doc, start))
        self.present |= 1 << length
        self.waiting += length

    def _longest(self, most: int) -> int:
        """The longest length of the pool up to ``most``; 0: none."""
        return max(0, (self.present & ((1 << (most + 1)) - 1)).bit_length() - 1)

    def _place(self, length: int, take: int, offset: int) -> int:
        """Move ``take`` tokens of a rest into the sequence; the others go back to the pool."""
        rests = self.pool[length]
        doc, start = rests.popleft()
        if not rests:
            del self.pool[length]
            self.present ^= 1 << length
        self.waiting -= length
        self.out.append((doc, start, take, self.sequences, offset))
        if take < length:
            self._put(doc, start + take, length - take)
        return offset + take

    def fill(self, target: int, seed: int) -> dict[int, int]:
        """How many of each length come closest to ``target``, besides one ``seed``."""
        sums, layers, mask = 1, [], (2 << target) - 1
        length = self._longest(target)
        while length and not sums >> target & 1:
            count = min(len(self.pool[length]) - (length == seed), target // length)
            step = 1
            while count > 0 and not sums >> target & 1:
                take = min(step, count)
                layers.append((length, take, sums))
                sums |= (sums << length * take) & mask
                count -= take
                step *= 2
            length = self._longest(length - 1)
        best, chosen = sums.bit_length() - 1, {}
        for length, take, before in reversed(layers):
            if not before >> best & 1:
                chosen[length] = chosen.get(length, 0) + take
                best -= length * take
        return chosen

    def _window(self) -> None:
        seed = self._longest(self.capacity)
        chosen = self.fill(self.capacity - seed, seed)
        chosen[seed] = chosen.get(seed, 0) + 1
        slack = self.capacity - sum(n * c for n, c in chosen.items())
        again = 1 if slack else min(len(self.pool[n]) // c for n, c in chosen.items())
        for _ in range(again):
            offset = 0
            for length, count in chosen.items():
                for _ in range(count):
                    offset = self._place(length, length, offset)
            if slack and (longest := self._longest(self.capacity)):
                self._place(longest, slack, offset)
            self.sequences += 1


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of documents (doc_id, text) in sequences of at most ``capacity`` tokens.

    Each task packs what it reads, in one pass and without a shuffle, and holds some
    hundred thousand tokens and one document at a time. A sequence is ``capacity`` tokens
    long; a task's last ones (at most one for each power of two) are shorter.

    Null and empty texts are a document of the end token alone. Null ids stay null,
    repeated rows are documents of their own, an empty table gives no rows, other columns
    are ignored. ``ids`` is null unless ``keep_ids``.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    tail = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(path), Packer(capacity)
        base = TaskContext.get().partitionId() << 33

        def rows() -> pa.RecordBatch:
            out, columns = packer.out, [[] for _ in range(8)]
            for doc, start, length, sequence, offset in out:
                ids = doc.ids[4 * start : 4 * (start + length)]
                values = (
                    doc.doc_id, start, length, ids if keep_ids else None, zlib.crc32(ids),
                    len(doc.ids) // 4, base + sequence, offset,
                )
                for column, value in zip(columns, values):
                    column.append(value)
            out.clear()
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = held = 0
            while at < len(texts):
                to = at + 1
                size = len(texts[at])
                while to < len(texts) and size + len(texts[to]) < _FLUSH // 2:
                    size += len(texts[to])
                    to += 1
                for doc_id, found in zip(ids[at:to], encode.ids(texts[at:to])):
                    packer.add(Document(doc_id, found + tail))
                    held += len(found)
                at = to
                if held > _FLUSH:
                    yield rows()
                    held = 0
            if packer.out:
                yield rows()
        packer.finish()
        if packer.out:
            yield rows()

    return docs.select("doc_id", as_bytes("text").alias("text")).mapInArrow(run, SCHEMA)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of all pieces."""
    return pack_documents(spread_table(spark, sf_dir, "documents"), keep_ids=False).drop("ids")
