"""Operator 12: language-model scores from an Elias-Fano n-gram trie (a model of two words).

The probability of a token after the one before it is interpolated:

    P(w | h) = share(h, w) + rest(h) * P(w),    share = c(h w) / (c(h) + m(h)),
    rest = m(h) / (c(h) + m(h)),                m(h) = MASS * c(h) ** GROWTH,

which sums to one over the words whatever m is; m(h) stands for the number of different
words after h, as it grows with c(h), so that no total over h's successors is needed. P(w)
is (c(w) + V / (V + 1)) / (N + V); an unseen word gets the share of one of V + 1.

Texts are coded in blocks of bounded bytes: the block's distinct words and, for each
token, its place among them. A word goes once per block to the shard of its hash, which
adds up its counts, numbers it and answers. A pair of neighbours goes once per block to
the shard of its first word; pairs of a word that holds more than one of HOT tokens are
spread by both words. The shard adds up the counts, builds the trie of its pairs, and
answers from the trie with 16-bit codes. The block then sums up its documents. So the
model is never in one place: no broadcast, no vocabulary on the driver.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quireworks.llm.common import as_bytes, cut, release, spread_table
from quireworks.llm.elias_fano import Trie
from quireworks.llm.words import Texts, mix
from quireworks.session import delete_path, materialize

MASS, GROWTH = 3.0, 0.8
HOT = 1 << 14
BLOCK_BYTES = 12 << 20  # texts of a block, about
SHARD_WORDS = 1_000_000  # words or pairs that a shard gets, about
_END = np.uint64(1)  # in the place of a word's hash
_STEPS = 65534 / 16  # codes of shares: steps of a decimal logarithm from 0 down to -16

_BLOCK = (
    "block long, doc_ids array<long>, held array<boolean>, lengths binary, words binary, counts binary, tokens binary, "
    "n_tokens long, n_words long"
)
_CODED = "block long, doc_ids array<long>, held array<boolean>, lengths binary, ids binary, counts binary, tokens binary"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, as compressed planes of their bytes."""
    values = values.astype("<u8")
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<qB", len(values), width) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    n, width = struct.unpack("<qB", data[:9])
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[9:], max_output_size=n * width + 1), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.reshape(width, n).T
    return out.reshape(-1).view("<i8")


def share_codes(shares: np.ndarray) -> np.ndarray:
    """16-bit codes of numbers above 0, up to 1; code 0 is left for what isn't there."""
    return (1 + np.clip(np.rint(-np.log10(shares) * _STEPS), 0, 65534)).astype(np.uint16)


def shares_of(codes: np.ndarray) -> np.ndarray:
    return np.where(codes == 0, 0.0, 10.0 ** (-(codes.astype(np.float64) - 1) / _STEPS))


def mass(counts: np.ndarray) -> np.ndarray:
    return MASS * counts.astype(np.float64) ** GROWTH


def held_out(doc_id: Column) -> Column:
    """Whether the id, as text (null: empty), leaves 0 of 10."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def code_blocks(docs: DataFrame, held: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block of texts: its words' hashes, their counts in training texts, its tokens."""

    def code(part: pa.RecordBatch, number: int) -> tuple:
        texts = Texts(part.column(2).to_pylist(), lower=True)
        lengths = np.diff(texts.first) + 1
        ends = np.cumsum(lengths) - 1
        tokens = np.empty(int(lengths.sum()), np.uint64)
        tokens[np.arange(len(texts.starts)) + np.repeat(np.arange(len(lengths)), lengths - 1)] = texts.hashes()
        tokens[ends] = _END
        words, at, often = np.unique(tokens, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at = place[at]
        trained = np.repeat(~part.column(1).to_numpy(zero_copy_only=False), lengths)
        counts = np.bincount(at[trained], minlength=len(words))
        return (
            (TaskContext.get().partitionId() << 33) + number, part.column(0).to_pylist(), part.column(1).to_pylist(),
            pack(lengths), words[order].tobytes(), pack(counts), pack(at), len(tokens), len(words),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for part in cut(batch, 2, block_bytes):
                yield _batch(_BLOCK, [code(part, number)])
                number += 1

    return docs.select(F.col("doc_id").cast("long"), held, as_bytes("text")).mapInArrow(run, _BLOCK)


_KINDS = {
    "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()),
}


def _arrays(schema: str, rows: list[tuple]) -> tuple[list[pa.Array], list[str]]:
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    arrays, names = _arrays(schema, rows)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    arrays, names = _arrays(schema, rows)
    return pa.Table.from_arrays(arrays, names=names)


def _slices(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard with the places of what goes there, in their order."""
    order = np.argsort(shard, kind="stable")
    ranked = shard[order]
    edges = np.flatnonzero(np.diff(ranked)) + 1
    for places in np.split(order, edges) if len(order) else []:
        yield int(shard[places[0]]), places


def _word_shard(words: np.ndarray, shards: int) -> np.ndarray:
    return (mix(words ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(shards)).astype(np.int64)


_SENT_WORDS = "shard long, block long, words binary, counts binary"
_NUMBERED = "shard long, block long, ids binary, counts binary, total long, distinct long"


def number_words(blocks: DataFrame, shards: int) -> DataFrame:
    """For each block and shard: ids and training counts of the block's words, the shard's totals.

    A shard numbers its words by falling count, in turn with the other shards, so that ids
    are unique and frequent words have small ones.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, counts in zip(*(batch.column(n).to_pylist() for n in ("block", "words", "counts"))):
                words, counts = np.frombuffer(words, np.uint64), unpack(counts)
                rows = [
                    (shard, block, words[at].tobytes(), pack(counts[at])) for shard, at in _slices(_word_shard(words, shards))
                ]
                yield _batch(_SENT_WORDS, rows)

    def number(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        sent = [np.frombuffer(x, np.uint64) for x in group["words"].to_pylist()]
        words, at = np.unique(np.concatenate(sent), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([unpack(x) for x in group["counts"].to_pylist()])).astype(np.int64)
        ids = np.empty(len(words), np.int64)
        ids[np.lexsort((words, -counts))] = 1 + shard + np.arange(len(words)) * shards
        total, distinct = int(counts.sum()), int((counts > 0).sum())
        parts = np.split(at, np.cumsum([len(x) for x in sent])[:-1])
        rows = [
            (shard, block, pack(ids[own]), pack(counts[own]), total, distinct)
            for block, own in zip(group["block"].to_pylist(), parts)
        ]
        return _table(_NUMBERED, rows)

    return blocks.select("block", "words", "counts").mapInArrow(send, _SENT_WORDS).groupBy("shard").applyInArrow(number, _NUMBERED)


def put_ids(blocks: DataFrame, numbered: DataFrame, shards: int) -> DataFrame:
    """Blocks with the ids and counts of their words over all training texts."""

    def put(left: pa.Table, right: pa.Table) -> pa.Table:
        words = np.frombuffer(left["words"][0].as_py(), np.uint64)
        ids, counts = np.zeros((2, len(words)), np.int64)
        answers = dict(zip(right["shard"].to_pylist(), zip(right["ids"].to_pylist(), right["counts"].to_pylist())))
        for shard, at in _slices(_word_shard(words, shards)):
            ids[at], counts[at] = map(unpack, answers[shard])
        row = {n: left[n][0].as_py() for n in ("block", "doc_ids", "held", "lengths", "tokens")}
        return _table(
            _CODED, [(row["block"], row["doc_ids"], row["held"], row["lengths"], pack(ids), pack(counts), row["tokens"])]
        )

    asked = blocks.select("block", "doc_ids", "held", "lengths", "words", "tokens").groupBy("block")
    return asked.cogroup(numbered.select("block", "shard", "ids", "counts").groupBy("block")).applyInArrow(put, _CODED)


class _Block:
    """The pairs of neighbours of a coded block; before a text's first token stands id 0."""

    def __init__(self, row: dict, starts: int):
        self.doc_ids, self.held = row["doc_ids"], row["held"]
        self.lengths, self.ids, self.counts = (unpack(row[n]) for n in ("lengths", "ids", "counts"))
        self.tokens = unpack(row["tokens"])
        self.begins = np.cumsum(self.lengths) - self.lengths
        n = len(self.ids)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.begins] = n
        self.pairs, self.at = np.unique(before * n + self.tokens, return_inverse=True)
        self.first, self.second = np.divmod(self.pairs, n)
        self.first_ids, self.first_counts = np.append(self.ids, 0)[self.first], np.append(self.counts, starts)[self.first]
        self.asked = np.flatnonzero((self.first_counts > 0) & (self.counts[self.second] > 0))

    def shards(self, shards: int, total: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each shard with the asked pairs that belong there."""
        first, second = self.first_ids[self.asked].astype(np.uint64), self.ids[self.second[self.asked]].astype(np.uint64)
        spread = mix(first * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        hot = self.first_counts[self.asked] > total // HOT
        spread = np.where(hot, mix(spread ^ (second * np.uint64(0xD6E8FEB86659FD93))), spread)
        for shard, at in _slices((spread % np.uint64(shards)).astype(np.int64)):
            yield shard, self.asked[at]


_PAIRS = "shard long, block long, first binary, first_counts binary, runs binary, second binary, counts binary"
_ANSWERS = "shard long, block long, codes binary"


def pair_trie(first: np.ndarray, second: np.ndarray, counts: np.ndarray, first_counts: np.ndarray) -> Trie:
    """Of distinct pairs in order: rests of the first words, shares of the pairs."""
    starts = np.flatnonzero(np.diff(first, prepend=-1))
    own = first_counts[starts].astype(np.float64)
    rests = share_codes(mass(own) / (own + mass(own)))
    return Trie.of([first, second], [rests, share_codes(counts / (first_counts + mass(first_counts)))])


def ask_pairs(coded: DataFrame, shards: int, total: int, starts: int) -> DataFrame:
    """For each block and shard: the codes of the shares of the block's pairs, 0 for unseen ones."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                block = _Block(row, starts)
                trained = np.repeat(~np.array(block.held, bool), block.lengths)
                counts = np.bincount(block.at[trained], minlength=len(block.pairs))
                rows = []
                for shard, at in block.shards(shards, total):
                    begins = np.flatnonzero(np.diff(block.first[at], prepend=-1))
                    rows.append((
                        shard, row["block"], pack(block.first_ids[at[begins]]), pack(block.first_counts[at[begins]]),
                        pack(np.diff(np.append(begins, len(at)))), pack(block.ids[block.second[at]]), pack(counts[at]),
                    ))
                yield _batch(_PAIRS, rows)

    def answer(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        runs = [unpack(x) for x in group["runs"].to_pylist()]

        def column(name: str, spread: bool = False) -> np.ndarray:
            parts = [unpack(x) for x in group[name].to_pylist()]
            return np.concatenate([np.repeat(p, r) for p, r in zip(parts, runs)] if spread else parts)

        first, second = column("first", True), column("second")
        names, place = np.unique(first, return_inverse=True)
        size = int(second.max()) + 1
        pairs, at = np.unique(place * size + second, return_inverse=True)
        counts = np.bincount(at, weights=column("counts")).astype(np.int64)
        first_counts = np.zeros(len(names), np.int64)
        first_counts[place] = column("first_counts", True)
        own, second = np.divmod(pairs, size)
        seen = counts > 0
        built = pair_trie(names[own[seen]], second[seen], counts[seen], first_counts[own[seen]])
        trie = Trie.map(built.tobytes())
        node = trie.find([names[own], second])
        codes = np.where(node >= 0, np.append(trie.levels[1].codes, 0)[node], 0)[at]
        lengths = [int(r.sum()) for r in runs]
        parts = np.split(codes, np.cumsum(lengths)[:-1])
        return _table(_ANSWERS, [(shard, block, pack(c)) for block, c in zip(group["block"].to_pylist(), parts)])

    return coded.mapInArrow(send, _PAIRS).groupBy("shard").applyInArrow(answer, _ANSWERS)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def sum_up(coded: DataFrame, answers: DataFrame, shards: int, total: int, distinct: int, starts: int) -> DataFrame:
    """The scores of each block's documents."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block({name: left[name][0].as_py() for name in left.column_names}, starts)
        codes = np.zeros(len(block.pairs), np.uint16)
        found = dict(zip(right["shard"].to_pylist(), right["codes"].to_pylist()))
        for shard, at in block.shards(shards, total):
            codes[at] = unpack(found[shard])
        single = (block.counts + distinct / (distinct + 1)) / (total + distinct) if total else np.ones(len(block.counts))
        before = block.first_counts.astype(np.float64)
        rest = np.ones(len(before))
        known = before > 0
        rest[known] = shares_of(share_codes(mass(before[known]) / (before[known] + mass(before[known]))))
        pair = np.log10(shares_of(codes) + rest * single[block.second])
        base = np.log10((block.counts + 0.1) / (total + 0.1 * (distinct + 1)))

        def summed(values: np.ndarray) -> list:
            return np.add.reduceat(values, block.begins).tolist()

        columns = [
            block.doc_ids, block.held, block.lengths.tolist(), summed((block.counts > 0).astype(np.int64)[block.tokens]),
            [total] * len(block.lengths), summed(base[block.tokens]), summed(pair[block.at]),
        ]
        return _table(_SCORES, list(zip(*columns)))

    return coded.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, _SCORES)


def score_documents(
    docs: DataFrame, held: Column, block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``docs`` has (doc_id, text) and what ``held`` reads; other columns are ignored. The
    model learns from rows that aren't ``held``. Null and empty texts are the end token
    alone. Repeated rows are documents each, and are counted each. With nothing to learn
    from every token has probability one. Words are told apart by 64-bit hashes. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, blocks_path = materialize(code_blocks(docs, held, block_bytes), "ngram-blocks")
    sizes = blocks.agg(F.sum("n_tokens").alias("tokens"), F.sum("n_words").alias("words")).first()
    if sizes["tokens"] is None:
        return spark.createDataFrame([], _SCORES)
    word_shards = max(least, -(-sizes["words"] // shard_words))
    numbered, numbered_path = materialize(number_words(blocks, word_shards), "ngram-words")
    totals = (
        numbered.groupBy("shard").agg(F.max("total").alias("t"), F.max("distinct").alias("d"))
        .agg(F.sum("t").alias("t"), F.sum("d").alias("d")).first()
    )
    starts = docs.filter(~held).count()
    coded, coded_path = materialize(put_ids(blocks, numbered, word_shards), "ngram-coded")
    delete_path(spark, blocks_path)
    delete_path(spark, numbered_path)
    release(spark)
    pair_shards = max(least, -(-sizes["tokens"] // (2 * shard_words)))
    answers, answers_path = materialize(ask_pairs(coded, pair_shards, totals["t"], starts), "ngram-answers")
    release(spark)
    scores, _ = materialize(sum_up(coded, answers, pair_shards, totals["t"], totals["d"], starts), "ngram-scores")
    delete_path(spark, coded_path)
    delete_path(spark, answers_path)
    return scores


def op12_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of all documents by a model of those that are not held out."""
    return score_documents(spread_table(spark, sf_dir, "documents"), held_out(F.col("doc_id")))
