"""Operator 6: quality by weak supervision.

Rules over a text's statistics vote good, bad or not at all. Expectation-maximisation over
the counts of vote patterns of all documents estimates how each rule votes on good and on
bad texts, and a text is kept if its posterior probability of being good is a half or more.
Rules agree to a number of patterns that does not grow with the documents, so the patterns
are all that reaches the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quireworks.llm.common import as_bytes, cut, map_batches, spread_table
from quireworks.llm.words import Texts, mix, windows

REPEAT_WINDOW = 5
KEEP_FROM = 0.5
ITERATIONS = 200
_SLICE = 4 << 20


def _bytes(chars: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chars)] = True
    return found


_SYMBOLS = _bytes(b"#*$%&|<>")
_UPPER = _bytes(bytes(range(65, 91)))
_LETTER = _bytes(bytes([*range(65, 91), *range(97, 123), *range(0x80, 0x100)]))
_STOP = _bytes(b".!?")
_INNER = _bytes(bytes(range(0x80, 0xC0)))  # bytes that go on with a code point

STATISTICS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_lines long, n_upper long, n_letters long, n_stops long, n_loud long"
)


def repeated(texts: Texts, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Which words stand in a run of ``size`` words that its text holds twice or more."""
    count = len(texts.starts)
    covered = np.zeros(count + 1, np.int64)
    runs = windows(texts.hashes(), size)
    if len(runs):
        doc = np.repeat(np.arange(len(texts.first) - 1), np.diff(texts.first))
        whole = doc[: len(runs)] == doc[size - 1 :]  # not across two texts
        at = np.flatnonzero(whole)
        keys = runs[at] ^ mix(doc[at].astype(np.uint64) + np.uint64(1))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(covered, at[twice], 1)
        np.add.at(covered, at[twice] + size, -1)
    return np.cumsum(covered)[:count] > 0


def statistics(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The counts of STATISTICS for (doc_id, text bytes)."""
    raw = batch.column(1).to_pylist()
    texts = Texts(raw)
    begin, end = texts.begins[:-1], texts.begins[1:] - 1

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[end] - sums[begin]

    data = texts.data
    inside = np.zeros(len(data) + 1, np.int8)
    inside[texts.starts] += 1
    inside[texts.ends] -= 1
    in_word = np.cumsum(inside[:-1], dtype=np.int8) > 0
    again = np.concatenate([[0], np.cumsum(repeated(texts))])
    last = np.zeros(len(data), bool)
    last[texts.ends - 1] = True
    lines = [[line for line in text.split(b"\n") if line.strip()] for text in raw]
    columns = [
        np.diff(texts.first),
        per_text(in_word & ~_INNER[data]),
        per_text(_SYMBOLS[data]),
        np.array([len(x) - len(set(x)) for x in lines], np.int64),
        again[texts.first[1:]] - again[texts.first[:-1]],
        np.array(list(map(len, lines)), np.int64),
        per_text(_UPPER[data]),
        per_text(_LETTER[data]),
        per_text(last & _STOP[data]),
        per_text(last & (data == ord("!"))),
    ]
    names = [c.split()[0] for c in STATISTICS.split(", ")]
    arrays = [batch.column(0), *(pa.array(c.astype(np.int64)) for c in columns)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def text_statistics(docs: DataFrame) -> DataFrame:
    """STATISTICS of every whole text; null counts as empty."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [statistics(part) for part in cut(batch, 1, _SLICE)]
        table = pa.Table.from_batches(parts).combine_chunks()
        return table.to_batches()[0]

    return map_batches(docs.select("doc_id", as_bytes("text").alias("text")), work, STATISTICS)


def votes() -> dict[str, Column]:
    """1: good, -1: bad, 0: no vote. Shares are of words unless named otherwise.

    What is wrong with a text seldom shows in more than two of its counts, so a rule that
    finds nothing wrong does not vote; only sound sentences vote for a text.
    """
    words = F.greatest(F.col("n_words"), F.lit(1))

    def share(name: str, of: Column = words) -> Column:
        return F.col(name) / of

    def bad(when: Column) -> Column:
        return F.when(when, F.lit(-1)).otherwise(F.lit(0))

    symbols, again = share("n_symbols"), share("n_repeat_words")
    length, stops, loud = share("word_chars"), share("n_stops"), share("n_loud")
    lines = share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1)))
    upper = share("n_upper", F.greatest(F.col("n_letters"), F.lit(1)))
    letters = share("n_letters", F.greatest(F.col("word_chars"), F.lit(1)))
    brief = F.col("n_words") < 50  # too few for shares of stops and letters
    sound = brief | ((stops >= 0.02) & (upper < 0.2) & (letters > 0.8))
    sound = sound & (stops <= 0.5) & (symbols < 0.05)
    return {
        "symbols": bad(symbols > 0.1),
        "repeats": bad(again > 0.2),
        "same_lines": bad(lines > 0.5),
        "word_length": bad((F.col("n_words") > 0) & ((length < 2) | (length > 12))),
        "no_sentences": bad((F.col("n_words") >= 50) & (stops < 0.01)),
        "loud": bad(loud > 0.1),
        "capitals": bad((F.col("n_letters") >= 50) & (upper > 0.4)),
        "marks": bad(~brief & (letters < 0.7)),
        "sentences": F.when(sound, F.lit(1)).otherwise(F.lit(0)),
    }


def estimate(patterns: np.ndarray, counts: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Posterior probability of good for each pattern of votes (rows, values -1, 0, 1).

    Expectation-maximisation from the majority vote. Votes and abstentions are independent
    given the class; their probabilities are smoothed by one document, and a good vote
    never speaks against good, which keeps the classes from changing places.
    """
    if not len(patterns):
        return np.zeros(0)
    weights = counts.astype(float)
    total = patterns.sum(1)
    posterior = np.where(total > 0, 0.9, np.where(total < 0, 0.1, 0.5))
    one_hot = patterns[:, :, None] == np.array([-1, 0, 1])
    for _ in range(iterations):
        good = (one_hot * (weights * posterior)[:, None, None]).sum(0) + 1
        bad = (one_hot * (weights * (1 - posterior))[:, None, None]).sum(0) + 1
        ratio = np.log(good / good.sum(1, keepdims=True)) - np.log(bad / bad.sum(1, keepdims=True))
        ratio[:, 2] = np.maximum(ratio[:, 2], 0)
        ratio[:, 0] = np.minimum(ratio[:, 0], 0)
        prior = np.clip((weights * posterior).sum() / weights.sum(), 0.05, 0.95)
        logit = np.log(prior / (1 - prior)) + (one_hot * ratio).sum((1, 2))
        new = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        if np.abs(new - posterior).max() < 1e-9:
            return new
        posterior = new
    return posterior


def quality(docs: DataFrame) -> DataFrame:
    """Statistics, votes and ``posterior`` of documents (doc_id, text).

    Null and empty texts have counts of 0 and get the posterior of their votes. Repeated
    rows are documents of their own, ids may be null, an empty table gives no rows, other
    columns are ignored. Each text is read once: its counts are checkpointed before the
    patterns are counted.
    """
    rules = votes()
    found = text_statistics(docs).checkpoint()
    voted = found.select("*", F.concat_ws(",", *rules.values()).alias("pattern"))
    patterns = voted.groupBy("pattern").count().orderBy("pattern").collect()  # at most 3 ** rules rows
    table = np.array([[int(v) for v in row[0].split(",")] for row in patterns]).reshape(-1, len(rules))
    posterior = estimate(table, np.array([row[1] for row in patterns]))
    known = docs.sparkSession.createDataFrame(
        [(row[0], float(p)) for row, p in zip(patterns, posterior)], "pattern string, posterior double"
    )
    return voted.join(F.broadcast(known), "pattern").drop("pattern")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of all documents."""
    words, again = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < 10) | (100 * again > 20 * words)
    return quality(spread_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= KEEP_FROM)).alias("kept"),
        "posterior",
    )
