"""Cutting text into overlapping chunks.

``recursive_chunks`` prefers to cut at separators; ``char_windows`` cuts at fixed
offsets and is what the recursive rule becomes where no separator is left.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireworks.functions.keys import chunk_id
from quireworks.functions.text import clean_text, has_visible_text, reclean_text
from quireworks.session import made_once, spread_over_cores

# Chunk length and overlap in characters, and the separators in
# order of preference.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
SEPARATORS = ("\n\n", "\n", ". ", " ", "")
_SLICE_BYTES = 1 << 20  # of text that a worker cuts at once


def _cut_points(text: str, lo: int, hi: int, separator: str) -> list[int]:
    """Offsets of the pieces of ``text[lo:hi]``; each separator opens the next piece."""
    points, at = [lo], text.find(separator, lo, hi)
    while at >= 0:
        if at > lo:
            points.append(at)
        at = text.find(separator, at + len(separator), hi)
    points.append(hi)
    return points


def _pack(points: list[int], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Spans of at most ``size`` characters that begin and end on cut points.

    All pieces are shorter than ``size``. A span reaches as far as it can; the next one
    starts at the earliest cut point that repeats no more than ``overlap`` characters and
    leaves room for the piece that did not fit.
    """
    start, end = points[0], points[-1]
    while end - start > size:
        last = bisect_right(points, start + size) - 1
        yield start, points[last]
        start = points[bisect_left(points, max(points[last] - overlap, points[last + 1] - size))]
    yield start, end


def _spans(text: str, lo: int, hi: int, size: int, overlap: int, separators: Sequence[str]):
    """Yield (start, end, whole); ``whole`` marks a long piece that nothing can cut."""
    at = next((i for i, s in enumerate(separators) if s == "" or text.find(s, lo, hi) >= 0), None)
    if at is None:
        at = len(separators) - 1
    separator, finer = separators[at], separators[at + 1 :]
    if separator == "":
        while hi - lo > size:
            yield lo, lo + size, False
            lo += max(size - overlap, 1)
        yield lo, hi, False
        return
    points = _cut_points(text, lo, hi, separator)
    run = 0
    for i in range(len(points) - 1):
        if points[i + 1] - points[i] >= size:
            if run < i:
                for start, end in _pack(points[run : i + 1], size, overlap):
                    yield start, end, False
            if finer:
                yield from _spans(text, points[i], points[i + 1], size, overlap, finer)
            else:
                yield points[i], points[i + 1], True
            run = i + 1
    if run < len(points) - 1:
        for start, end in _pack(points[run:], size, overlap):
            yield start, end, False


def split_text(
    text: str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> list[str]:
    """Chunks of one text, stripped, empty ones dropped."""
    if not text:
        return []
    spans = _spans(text, 0, len(text), size, overlap, separators)
    chunks = (text[a:b] if whole else text[a:b].strip() for a, b, whole in spans)
    return [c for c in chunks if c]


def text_slices(texts: pa.Array, most: int = _SLICE_BYTES) -> Iterator[pa.Array]:
    """Slices of about ``most`` bytes of text each, never less than a row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = before = 0
    while start < len(texts):
        to = min(len(texts), int(np.searchsorted(ends, before + most)) + 1)
        yield texts.slice(start, to - start)
        start, before = to, int(ends[to - 1])


def recursive_chunks(
    text: Column,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> Column:
    """Array of the chunks of a text column.

    An Arrow UDF over this one column: where a chunk starts depends on where the one
    before it ended, which built-in array functions can only fold piece by piece
    (interpreted, and slower than Python's own string search). A batch is cut and sent back
    in slices, so that a worker holds the chunks of one slice and not those of 10,000 texts.
    """
    if not 0 <= overlap < size or size < 2:
        raise ValueError("need 0 <= overlap < size and size >= 2")
    separators = tuple(separators)

    return _chunker(size, overlap, separators)(text)


@made_once
def _chunker(size: int, overlap: int, separators: tuple[str, ...]):
    """The function of ``recursive_chunks``, made once."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def chunks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in text_slices(batch):
                cut = [split_text(t or "", size, overlap, separators) for t in part.to_pylist()]
                yield pa.array(cut, type=pa.list_(pa.string()))
                del cut, part  # while the next batch is read
            del batch

    return chunks


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    Lambda variables are the only names an expression can give; without one the optimizer
    may inline ``value`` into every use, also into those inside another lambda.
    """
    return F.transform(F.array(value), body)[0]


def char_windows(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of windows of ``size`` characters, one each ``size - overlap``, trimmed.

    The text is tiled once into steps and each window is glued from its tiles: cutting
    every window out of the whole text would walk the UTF-8 bytes from the start each time.
    """
    step = size - overlap
    tiles_per_window = -(-size // step)

    def windows(tiles: Column) -> Column:
        length = (F.size(tiles) - 1) * step + F.length(F.element_at(tiles, -1))
        kept = F.greatest(F.ceil((length - overlap) / step), F.lit(1)).cast("int")
        return F.transform(
            F.sequence(F.lit(1), kept),
            lambda i: F.trim(
                F.substring(F.array_join(F.slice(tiles, i, tiles_per_window), ""), 1, size)
            ),
        )

    tiles = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    return F.when(F.length(text) > 0, _bind(tiles, windows)).otherwise(
        F.array().cast("array<string>")
    )


def explode_chunks(
    df: DataFrame, chunks: Column, title: str = "title", keep: bool = False
) -> DataFrame:
    """One row per chunk: ``chunk_idx`` from 0 within its row, ``chunk_id``, ``content``.
    With ``keep`` a row without chunks stays, these three null."""
    kept = [c for c in df.columns if c != "content"]
    explode = F.posexplode_outer if keep else F.posexplode
    return df.select(*kept, explode(chunks).alias("chunk_idx", "content")).withColumn(
        "chunk_id", chunk_id(F.col(title), F.col("chunk_idx"))
    )


def chunk_documents(
    pages: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
    clean_first: bool = True,
    keep: bool = False,
) -> DataFrame:
    """Clean page texts, drop the empty ones, cut them and clean every chunk again.

    With ``keep`` a page without chunks is a row whose ``chunk_idx`` is null, and the pages
    are cut where they are.
    """
    if not keep:
        pages = spread_over_cores(pages)
        visible = has_visible_text(F.col("content")) if clean_first else F.col("content") != ""
        pages = pages.filter(visible)
    if clean_first:
        pages = pages.withColumn("content", _cleaned("content"))
    chunks = explode_chunks(
        pages, recursive_chunks(F.col("content"), size, overlap, separators), keep=keep
    )
    return chunks.withColumn("content", (_recleaned if clean_first else _cleaned)("content"))


@made_once
def _cleaned(name: str) -> Column:
    return clean_text(F.col(name))


@made_once
def _recleaned(name: str) -> Column:
    return reclean_text(F.col(name))
