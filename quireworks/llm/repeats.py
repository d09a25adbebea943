"""Operator 5: repeated byte strings by prefix-free parsing.

A rolling hash of GRAM bytes triggers phrases: a position triggers where its hash is the
first least one of some window of LENGTH bytes, so that every window holds a trigger (a
fixed residue would leave windows without any). A phrase is the text of all windows of one
trigger; neighbours overlap. Equal windows have equal triggers, so windows are compared
through the dictionary of phrases:

* an occurrence of a phrase that also stands earlier repeats in all its windows;
* a phrase that is alone with its trigger string is new in all its windows;
* where several phrases share a trigger string, those of their windows whose middles also
  stand elsewhere, of the first occurrence of each phrase, are put in order with those of
  all other such phrases, and of equal ones the first in corpus order is new.

So nearly all work is a row per phrase, not per byte, and repetition makes the dictionary
smaller. What is equal within an Arrow batch is combined before any shuffle.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quireworks.llm.common import as_bytes, map_batches, release, spread_table
from quireworks.llm.words import mix
from quireworks.session import bucketed, materialize

LENGTH = 100
GRAM = 32
_SLICE, _SEGMENT = 1 << 20, 1 << 19
_INDEX = np.uint64((1 << 21) - 1)
_MANY = 16  # phrases of one trigger string in a batch from which all are put in order
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_NULL = -(1 << 63)  # stands for a null doc_id
_CHECK = (1 << 18) - 1
_HALF = np.uint64((1 << 32) - 1)
_BLOCK = 8  # neighbouring windows whose common middle is looked up first
_MOST = 127  # windows in one row
_powers: list[tuple[np.ndarray, np.ndarray]] = []

# Rows of the shuffles: a key of two hashes, the place (doc, at), and what the row is.
ASK, KNOWN, SEVERAL, MARK = 0, 1, 2, 3
# Rows that need no others stand for several places of a text in ``more``.
ROWS = "a long, b long, doc long, at long, kind int, more array<long>"


def _tables() -> list[tuple[np.ndarray, np.ndarray]]:
    if not _powers:
        for base in _BASES:
            pair = []
            for x in (base, pow(base, -1, 1 << 64)):
                steps = np.full(int(_INDEX) + 1, x, np.uint64)
                steps[0] = 1
                pair.append(np.cumprod(steps, dtype=np.uint64))
            _powers.append(tuple(pair))
    return _powers


class Hashes:
    """Hashes of substrings of an array of bytes, by running sums of two polynomials."""

    def __init__(self, data: np.ndarray):
        self.sums = []
        for up, _ in _tables():
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
            self.sums.append(sums)

    def of(self, k: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums, (_, down) = self.sums[k], _tables()[k]
        return mix((sums[ends] - sums[starts]) * down[starts] ^ (ends - starts).astype(np.uint64))


def check_of(text: bytes) -> int:
    """Tells texts of one doc_id apart."""
    return zlib.crc32(text) & _CHECK


def place(start: np.ndarray, count: np.ndarray, back: np.ndarray, check: np.ndarray) -> np.ndarray:
    """First window, number of windows, bytes from the first window to the trigger, and check of
    the text, in one number that orders by the first window."""
    parts = (start, 32), (count, 25), (back, 18), (check, 0)
    return sum(x.astype(np.int64) << shift for x, shift in parts)


def _parts(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 32, (at >> 25) & 127, (at >> 18) & 127


def _slices(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Bytes of about a megabyte and their segments (text, offset in it, begin here, windows).

    Long texts are cut so that each window stands in one segment.
    """
    parts: list[bytes] = []
    segments: list[tuple[int, int, int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        windows = len(text) - length + 1
        for offset in range(0, max(windows, 0), _SEGMENT):
            count = min(_SEGMENT, windows - offset)
            if size + count + length > _SLICE and parts:
                yield np.frombuffer(b"".join(parts), np.uint8), segments
                parts, segments, size = [], [], 0
            segments.append((i, offset, size, count))
            parts.append(text[offset : offset + count + length - 1])
            size += count + length - 1
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), segments


def phrases(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of each phrase: text, first window, number of windows, way to the trigger, and the hashes
    of the trigger string and of the phrase."""
    out: list[tuple[np.ndarray, ...]] = []
    for data, segments in _slices(texts, length):
        hashes = Hashes(data)
        grams = np.arange(len(data) - gram + 1)
        values = hashes.of(0, grams, grams + gram)
        least = (values & ~_INDEX) | grams.astype(np.uint64)
        width, wanted = 1, length - gram + 1
        while 2 * width <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wanted:
            least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
        trigger = (least & _INDEX).astype(np.int64)
        text, offset, begin, count = (np.array(x) for x in zip(*segments))
        at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        segment = np.repeat(np.arange(len(count)), count)
        own = trigger[at]
        new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (segment[1:] != segment[:-1])]))
        first, number = at[new], np.diff(np.append(new, len(at)))
        where = segment[new]
        whole = hashes.of(1, first, first + number + length - 1)
        back = own[new] - first
        whole = mix(whole ^ back.astype(np.uint64))
        out.append((text[where], first - begin[where] + offset[where], number, back, values[own[new]], whole))
    if not out:
        return tuple(np.zeros(0, d) for d in (*[np.int64] * 4, np.uint64, np.uint64))
    return tuple(map(np.concatenate, zip(*out)))


def _rows(asked: tuple[np.ndarray, ...], local: tuple[np.ndarray, np.ndarray, int] | None = None) -> pa.RecordBatch:
    """Rows of (a, b, doc, at, kind), and a row for each text of the (doc, at) of one kind that need no others."""
    a, b, doc, at, kind = asked
    b = b & _HALF  # 96 bits tell keys apart
    offsets, values = np.zeros(len(a) + 1, np.int64), np.zeros(0, np.int64)
    if local is not None and len(local[0]):
        docs, places, which = local
        order = np.lexsort((places & _CHECK, docs))
        docs, values = docs[order], places[order]
        heads = np.flatnonzero(np.diff(_groups(docs, values & _CHECK), prepend=-1))
        spread = mix(docs[heads].view(np.uint64) ^ values[heads].view(np.uint64))
        a, b = np.concatenate([a, spread]), np.concatenate([b, spread])
        doc, at = np.concatenate([doc, docs[heads]]), np.concatenate([at, values[heads]])
        kind = np.concatenate([kind, np.full(len(heads), which, np.int32)])
        offsets = np.concatenate([offsets, np.append(heads[1:], len(values))])
    columns = [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, pa.int64()) for x in (a, b, doc, at)]
    more = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(kind, pa.int32()), more], names=["a", "b", "doc", "at", "kind", "more"]
    )


def _places() -> Column:
    """The places that a row stands for, one row each."""
    return F.explode(F.when(F.size("more") > 0, F.col("more")).otherwise(F.array("at"))).alias("at")


def _groups(*keys: np.ndarray) -> np.ndarray:
    """For sorted keys: number of the group of each row."""
    new = np.zeros(len(keys[0]), bool)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def _first_of(a, b, doc, start) -> tuple[np.ndarray, np.ndarray]:
    """An order by (a, b, doc, start), and which rows in it stand at their key's first place."""
    order = np.lexsort((start, doc, b, a))
    group = _groups(a[order], b[order])
    head = np.flatnonzero(np.diff(group, prepend=-1))[group]
    d, s = doc[order], start[order]
    return order, (d == d[head]) & (s == s[head])


def _phrase_rows(length: int, gram: int) -> Callable[[pa.RecordBatch], pa.RecordBatch | None]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = batch.column(1).to_pylist()
        docs = batch.column(0).to_numpy()
        checks = np.fromiter(map(check_of, texts), np.int64, len(texts))
        text, start, number, back, a, b = phrases(texts, length, gram)
        if not len(text):
            return None
        order, first = _first_of(a, b, docs[text], start)
        text, start, number, back, a, b = (x[order] for x in (text, start, number, back, a, b))
        at, doc = place(start, number, back, checks[text]), docs[text]
        kind = np.where(first, ASK, KNOWN).astype(np.int32)
        # Trigger strings with very many phrases: all of them are put in order, wherever
        # else the string stands; one mark tells the others so.
        heads = np.flatnonzero(first)
        keys, same, counts = np.unique(a[heads], return_inverse=True, return_counts=True)
        many = counts[same] > _MANY
        kind[heads[many]] = SEVERAL
        marks = keys[counts > _MANY]
        zero, asks = np.zeros(len(marks), np.int64), np.flatnonzero(kind == ASK)
        asks = asks[np.lexsort((start[asks], text[asks]))]  # neighbours' places compress well in the shuffle
        asked = (
            np.concatenate([a[asks], marks]), np.concatenate([b[asks], zero.view(np.uint64)]),
            np.concatenate([doc[asks], zero]), np.concatenate([at[asks], zero]),
            np.repeat(np.array([ASK, MARK], np.int32), [len(asks), len(marks)]),
        )
        known, several = kind == KNOWN, kind == SEVERAL
        return pa.concat_batches(
            [_rows(asked, (doc[known], at[known], KNOWN)), _rows(tuple(x[:0] for x in asked), (doc[several], at[several], SEVERAL))]
        )

    return work


def _own_places(places: pa.Array, i: int, check: int) -> np.ndarray:
    """The places of a row's list that are its text's."""
    own = places[i].values.to_numpy()
    return np.unique(own[(own & _CHECK) == check])


def _ranges(first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each row, one after the other."""
    return np.repeat(first - (np.cumsum(number) - number), number) + np.arange(number.sum())


def _middle_rows(length: int) -> Callable[[pa.RecordBatch], pa.RecordBatch | None]:
    """Blocks of windows that have the same way to their trigger but for the last bits, keyed by
    what all windows of such a block hold: (doc, text, places) to rows."""
    size = length - _BLOCK + 1

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        texts, places = batch.column(1).to_pylist(), batch.column(2)
        docs = batch.column(0).to_numpy()
        checks = np.fromiter(map(check_of, texts), np.int64, len(texts))
        blocks = []
        for i in range(len(texts)):
            start, number, back = _parts(_own_places(places, i, checks[i]))
            low, high = (back - number + 1) // _BLOCK, back // _BLOCK
            block = _ranges(low, high - low + 1)
            start, number, back = (np.repeat(x, high - low + 1) for x in (start, number, back))
            middle = start + back - _BLOCK * block
            first = np.maximum(start, middle - _BLOCK + 1)
            last = np.minimum(start + number - 1, middle)
            blocks.append((block, middle, first, last - first + 1, start + back - first))
        out = []
        for data, segments in _slices(texts, length):
            hashes = Hashes(data)
            for i, offset, begin, count in segments:
                block, middle, first, number, back = blocks[i]
                at = np.minimum(middle, len(texts[i]) - length)
                here = np.flatnonzero((at >= offset) & (at < offset + count))
                p = middle[here] - offset + begin
                a, b = (mix(hashes.of(k, p, p + size) + block[here].astype(np.uint64)) for k in (0, 1))
                where = place(first[here], number[here], back[here], np.full(len(here), checks[i]))
                out.append((np.full(len(here), docs[i]), where, a, b))
        if not out:
            return None
        doc, at, a, b = map(np.concatenate, zip(*out))
        order = np.lexsort((b, a))
        doc, at, a, b = (x[order] for x in (doc, at, a, b))
        group = _groups(a, b)
        counts = np.bincount(group)
        many = counts[group] > 1
        marks = np.flatnonzero(many & (np.diff(group, prepend=-1) > 0))
        key_a, key_b = a[marks], b[marks]
        zero, single = np.zeros(len(marks), np.int64), ~many
        asked = (
            np.concatenate([a[single], key_a]), np.concatenate([b[single], key_b]),
            np.concatenate([doc[single], zero]), np.concatenate([at[single], zero]),
            np.repeat(np.array([ASK, MARK], np.int32), [single.sum(), len(marks)]),
        )
        return _rows(asked, (doc[many], at[many], SEVERAL))

    return work


def _window_rows(length: int) -> Callable[[pa.RecordBatch], pa.RecordBatch | None]:
    """Windows of phrases to put in order: (doc, text, places) to rows keyed by their hashes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        texts, places = batch.column(1).to_pylist(), batch.column(2)
        docs = batch.column(0).to_numpy()
        checks = np.fromiter(map(check_of, texts), np.int64, len(texts))
        wanted = []
        for i in range(len(texts)):
            first, number, _ = _parts(_own_places(places, i, checks[i]))
            wanted.append(np.unique(_ranges(first, number)))
        out = []
        for data, segments in _slices(texts, length):
            hashes = Hashes(data)
            for i, offset, begin, count in segments:
                here = wanted[i][(wanted[i] >= offset) & (wanted[i] < offset + count)]
                p = here - offset + begin
                out.append((np.full(len(p), i), here, hashes.of(0, p, p + length), hashes.of(1, p, p + length)))
        if not out:
            return None
        text, start, a, b = map(np.concatenate, zip(*out))
        order, first = _first_of(a, b, docs[text], start)
        asks = np.sort(order[first])  # by text and start, which compresses well in the shuffle
        known = np.sort(order[~first])  # by text and start again: neighbours become one row
        t, s = text[known], start[known]
        new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (s[1:] != s[:-1] + 1)])[: len(t)])
        number = np.diff(np.append(new, len(t)))
        pieces = -(-number // _MOST)
        k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        t, s = np.repeat(t[new], pieces), np.repeat(s[new], pieces) + k * _MOST
        number = np.minimum(np.repeat(number, pieces) - k * _MOST, _MOST)
        at = place(s, number, 0 * s, checks[t])
        asked = (
            a[asks], b[asks], docs[text[asks]], place(start[asks], 0 * asks + 1, 0 * asks, checks[text[asks]]),
            np.full(len(asks), ASK, np.int32),
        )
        return _rows(asked, (docs[t], at, KNOWN))

    return work


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, text, places): all texts, with the places of windows that also start earlier.

    ``doc`` is doc_id, with the smallest long for null. Earlier is a smaller doc_id, or the
    same and an earlier start; rows that repeat a doc_id are compared as one document, so a
    repeated row removes nothing from its double.
    """
    spark = docs.sparkSession
    named = docs.select(
        F.coalesce("doc_id", F.lit(_NULL)).alias("doc"), as_bytes("text").alias("text")
    )
    marks = _written(_judged_phrases(named, length, gram), "phrases")
    release(spark)
    # Laid out once for the three joins that bring places to their texts.
    texts = bucketed(named.withColumn("text_check", _text_check()), ["doc", "text_check"], "texts")
    unsettled = marks.filter(F.col("kind") == SEVERAL)
    shared = _written(_shared_blocks(texts, unsettled, length), "blocks")
    release(spark)

    windows = map_batches(_with_places(texts, shared), _window_rows(length), ROWS, "text").withColumn("local", _local())
    same = Window.partitionBy("local", "a", "b").orderBy("doc", F.shiftright("at", 32))
    again = windows.withColumn("rank", F.rank().over(same)).filter((F.col("kind") == KNOWN) | (F.col("rank") > 1))
    again = _written(again.select("doc", _places()), "windows")
    release(spark)
    found = marks.filter(F.col("kind") == KNOWN).select("doc", "at").unionByName(again)
    return texts.join(_lists(found), ["doc", "text_check"], "left")


def _text_check() -> Column:
    """What ``check_of`` gives."""
    return F.crc32("text").bitwiseAND(F.lit(_CHECK))


def _written(df: DataFrame, purpose: str) -> DataFrame:
    return materialize(df, purpose)[0]


def _local() -> Column:
    """Rows that need no others; their keys only spread them."""
    return F.col("kind").isin(KNOWN, SEVERAL)


def _lists(places: DataFrame) -> DataFrame:
    """The places of each text, as a list that is no longer than it: texts of one id don't share a list."""
    check = F.col("at").bitwiseAND(F.lit(_CHECK)).alias("text_check")
    return places.select("doc", check, "at").groupBy("doc", "text_check").agg(F.collect_list("at").alias("places"))


def _with_places(texts: DataFrame, places: DataFrame) -> DataFrame:
    return texts.join(_lists(places), ["doc", "text_check"]).select("doc", "text", "places")


def _judged_phrases(named: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc, at, kind) of phrases that repeat (KNOWN) or share a trigger string (SEVERAL)."""
    rows = map_batches(named, _phrase_rows(length, gram), ROWS, "text").withColumn("local", _local())
    trigger = Window.partitionBy("local", "a")
    phrase = Window.partitionBy("local", "a", "b").orderBy("doc", F.shiftright("at", 32))
    judged = rows.withColumn("rank", F.rank().over(phrase)).withColumn(
        "several", (F.min("b").over(trigger) != F.max("b").over(trigger)) | (F.max("kind").over(trigger) == MARK)
    )
    ask = F.col("kind") == ASK
    kind = (
        F.when((F.col("kind") == KNOWN) | (ask & (F.col("rank") > 1)), KNOWN)
        .when((F.col("kind") == SEVERAL) | (ask & F.col("several")), SEVERAL)
    )
    kept = judged.withColumn("kind", kind).filter("kind IS NOT NULL")
    return kept.select("doc", _places(), "kind")


def _shared_blocks(texts: DataFrame, unsettled: DataFrame, length: int) -> DataFrame:
    """(doc, at) of blocks of the unsettled windows whose middles stand in more than one place."""
    rows = map_batches(_with_places(texts, unsettled), _middle_rows(length), ROWS, "text").withColumn("local", _local())
    middle = Window.partitionBy("local", "a", "b")
    judged = rows.withColumn("others", F.count(F.lit(1)).over(middle))
    shared = (F.col("kind") == SEVERAL) | ((F.col("kind") == ASK) & (F.col("others") > 1))
    return judged.filter(shared).select("doc", _places())


def covered(size: int, places: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which bytes of a text its places cover."""
    change = np.zeros(size + 1, np.int32)
    start, number, _ = _parts(places)
    np.add.at(change, start, 1)
    np.add.at(change, start + number + length - 1, -1)
    return np.cumsum(change[:size]) > 0


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of documents (doc_id, text).

    Every byte that a string of ``length`` bytes covers which also starts earlier is
    removed, judged on the input. Null and empty texts, and those shorter than ``length``,
    lose nothing. An empty table gives no rows; other columns are ignored. ``kept`` holds
    the bytes that remain (a cut may divide a character), null unless ``keep``.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, places = batch.column(1).to_pylist(), batch.column(2)
        sizes, removed, spans, sums, kept = [], [], [], [], []
        for i, text in enumerate(texts):
            gone = 0
            runs = 0
            if places[i].is_valid:
                own = places[i].values.to_numpy()
                mask = covered(len(text), own, length)
                gone = int(mask.sum())
                runs = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
                sizes.append(len(text))
                text = np.frombuffer(text, np.uint8)[~mask].tobytes()
            else:
                sizes.append(len(text))
            removed.append(gone)
            spans.append(runs)
            sums.append(hashlib.sha256(text).hexdigest())
            kept.append(text if keep else None)
        doc_ids = [None if d == _NULL else d for d in batch.column(0).to_pylist()]
        columns = [pa.array(x, pa.int64()) for x in (doc_ids, sizes, removed, spans)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(sums, pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return map_batches(repeats(docs, length, gram).select("doc", "text", "places"), work, schema, "text")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of all documents."""
    return remove_repeats(spread_table(spark, sf_dir, "documents"), keep=False).drop("kept")


OP5_SQL = f"""
WITH t AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {_NULL}) AS d, encode(coalesce(text, '')) AS b FROM documents),
w AS MATERIALIZED (
  SELECT r, d, p, md5(b[p + 1:p + {LENGTH}]) AS k
  FROM (SELECT r, d, b, unnest(range(0, octet_length(b) - {LENGTH - 1})) AS p FROM t)),
f AS (SELECT k, min({{'d': d, 'p': p}}) AS first FROM w GROUP BY k HAVING count(*) > 1),
a AS (SELECT w.r, w.p FROM w JOIN f USING (k) WHERE {{'d': w.d, 'p': w.p}} > f.first),
g AS (
  SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS run
  FROM (SELECT r, p, (coalesce(p - lag(p) OVER (PARTITION BY r ORDER BY p), {LENGTH + 1}) > {LENGTH})::INTEGER AS fresh FROM a)),
runs AS (SELECT r, run, min(p) AS s, max(p) + {LENGTH} AS e FROM g GROUP BY r, run),
cut AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS before FROM runs),
kept AS (
  SELECT t.r, count(*) AS n_spans, sum(e - s)::BIGINT AS n_removed,
    string_agg(hex(t.b[before + 1:s]), '' ORDER BY s) || hex(t.b[max(e) + 1:]) AS h
  FROM cut JOIN t USING (r) GROUP BY t.r, t.b)
SELECT t.doc_id, octet_length(t.b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN h IS NULL THEN t.b ELSE unhex(h) END) AS kept_sha256
FROM t LEFT JOIN kept USING (r)"""
