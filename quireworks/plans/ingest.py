"""Ingest: publications or files in, new chunks with embeddings in the store."""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quireworks.functions.keys import UNTITLED, content_hash, metadata_json, row_uuid
from quireworks.functions.text import clean_text, is_blank, strip_whitespace
from quireworks.operators.batching import assign_batches
from quireworks.operators.chunking import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS, chunk_documents
from quireworks.operators.dedupe import (
    BROADCAST_HASHES,
    CHUNK_ORDER,
    drop_known,
    first_seen,
    known_hashes,
)
from quireworks.operators.embedding import Model, embed_documents
from quireworks.operators.ledger import new_files, new_titles
from quireworks.session import beside, delete_path, made_once, scratch_dir
from quireworks.sources.files import (
    PDF_GLOB,
    Decoder,
    decode_pages,
    list_files,
    read_files,
)
from quireworks.sources.listing import with_contents
from quireworks.sources.store import SMALL_BATCH, CollectionStore, Ledger

# Fixed value: files per batch of the main ingest.
FILES_PER_BATCH = 50
# Files of all the batches that are decoded, embedded and published together, about and at
# most; the first wave has a tenth, each further one twice as many as the one before.
WAVE_FILES = 100_000
FIRST_WAVE = 10
# Of a counted small batch: bytes of text that a task embeds and writes, at least.
_TASK_BYTES = 1 << 20
_BATCH = "batch_no"  # the batch of a wave that a page comes from


@dataclass(frozen=True)
class IngestResult:
    batch_id: str
    new_chunks: int
    skipped_chunks: int
    failed_files: int = 0
    failed_examples: tuple[str, ...] = ()  # some of the failed files with their errors

    @property
    def total_chunks(self) -> int:
        return self.new_chunks + self.skipped_chunks


class WaveResults(Sequence):
    """Results of the batches of all waves: numbers in arrays, as there may be one for each file."""

    def __init__(self):
        self._waves: list[tuple[str, int]] = []  # id and first batch
        self._of = array("q")  # the wave of a batch
        self._counts = array("q"), array("q"), array("q")  # new, total, failed

    def add(self, wave_id: str, numbers: range, counts: dict[int, tuple[int, int, int]]) -> None:
        self._waves.append((wave_id, numbers.start - len(self._of)))
        for n in numbers:
            self._of.append(len(self._waves) - 1)
            for column, count in zip(self._counts, counts.get(n, (0, 0, 0))):
                column.append(count)

    def __len__(self) -> int:
        return len(self._of)

    def __eq__(self, other) -> bool:
        return isinstance(other, Sequence) and list(self) == list(other)

    def __getitem__(self, i):
        if isinstance(i, slice):
            return [self[k] for k in range(*i.indices(len(self)))]
        i = range(len(self))[i]
        wave_id, before = self._waves[self._of[i]]
        new, total, failed = (column[i] for column in self._counts)
        return IngestResult(f"{wave_id}.{before + i}", new, total - new, failed)


def publication_title(df: DataFrame) -> Column:
    return _clean_title() if "title" in df.columns else F.lit(UNTITLED)


@made_once
def _clean_title() -> Column:
    return clean_text(F.col("title"))


def publications(df: DataFrame) -> DataFrame:
    """title, page_no, content. A missing title column means ``Untitled``, a null title is
    an empty one; page_no only orders the pages of a title and may be missing."""
    title = publication_title(df)
    page_no = F.col("page_no").cast("long") if "page_no" in df.columns else F.lit(0).cast("long")
    return df.select(*_batch_column(df), title.alias("title"), page_no.alias("page_no"), "content")


def _batch_column(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == _BATCH]


def hashed_chunks(
    df: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
    clean_first: bool = True,
) -> DataFrame:
    """Publications to chunks with their hash, without any shuffle."""
    chunks = chunk_documents(publications(df), size, overlap, separators, clean_first)
    return chunks.select(*_batch_column(chunks), *CHUNK_ORDER, "content", content_hash(F.col("content")).alias("content_hash"))


def page_chunks(pages: DataFrame, **chunking) -> DataFrame:
    """Pages of decoded files to chunks with their hash, all in one pass without a shuffle.

    Columns of the page, but ``blank`` for its text, and those of ``hashed_chunks``. A page
    without chunks (blank, without text, failed) is a row whose ``chunk_idx`` is null, so that
    every page has exactly one row with a chunk_idx of null or 0, see ``chunked_pages``.
    """
    pages = pages.withColumn("title", publication_title(pages)).withColumns(_page_columns())
    chunks = chunk_documents(pages, **chunking, keep=True).drop("chunk_id")
    return chunks.withColumn("content_hash", content_hash(F.col("content")))


@made_once
def _page_columns() -> dict[str, Column]:
    """Of a page whether it is blank, and the text that is cut: that of ``page_rows``."""
    text = F.col("content")
    good = F.col("error").isNull() & ~is_blank(text)
    return {"blank": is_blank(text), "content": F.when(good, strip_whitespace(text))}


def chunked_pages(staged: DataFrame) -> DataFrame:
    """One row per page of ``page_chunks``."""
    return staged.filter("coalesce(chunk_idx, 0) = 0")


def chunks_of_pages(staged: DataFrame) -> DataFrame:
    """The chunks of ``page_chunks`` in the columns of ``hashed_chunks``."""
    kept = [*_batch_column(staged), *CHUNK_ORDER, "content", "content_hash"]
    return staged.filter(F.col("chunk_idx").isNotNull()).select(*kept)


def stored_rows(chunks: DataFrame, collection: str, dedupe: bool, batch_id: str = "") -> DataFrame:
    """Chunks in the columns of the store, still without their embedding.

    With ``dedupe`` a row's key is that of its content. Without, equal chunks are rows of
    their own: the key is made of the batch and the row's place in it, so the chunks must
    be staged ones, which every reading finds in the same place.
    """
    return chunks.select(*_row_columns(collection, dedupe, batch_id))


@made_once
def _row_columns(collection: str, dedupe: bool, batch_id: str) -> list[Column]:
    hash_ = F.col("content_hash")
    if dedupe:
        key = row_uuid(F.lit(collection), hash_)
        metadata = metadata_json(F.col("title"), hash_)
    else:
        key = row_uuid(F.lit(collection), F.lit(batch_id), F.monotonically_increasing_id())
        metadata, hash_ = metadata_json(F.col("title")), F.lit(None).cast("string")
    return [
        key.alias("uuid"),
        F.col("content").alias("document"),
        metadata.alias("cmetadata"),
        F.lit(None).cast("string").alias("custom_id"),
        hash_.alias("content_hash"),
    ]


def new_chunks(
    chunks: DataFrame,
    stored: DataFrame,
    n_chunks: int | None = None,
    max_broadcast: int = BROADCAST_HASHES,
) -> DataFrame:
    """First copy of every chunk that is not stored, for any table of stored hashes.

    A small batch (its size is known) is looked up by broadcasting its hashes to the scan
    of the store's hash column. A large one is de-duplicated and anti-joined on the same
    hash partitioning, so its texts are shuffled once.
    """
    winners = first_seen(chunks)
    if n_chunks is not None and n_chunks <= max_broadcast:
        known = known_hashes(chunks, stored, max_broadcast=max_broadcast, n_chunks=n_chunks)
        return drop_known(winners, known)
    return drop_known(winners, stored)


def insert_publications(
    df: DataFrame,
    store: CollectionStore,
    collection: str,
    model: Model,
    batch_id: str | None = None,
    dedupe: bool = True,
    keys: DataFrame | None = None,
    **chunking,
) -> IngestResult:
    """Clean, chunk, hash, drop what is stored or repeated, embed, append.

    The hashed chunks are written to the scratch folder first. That cuts the lineage
    before the embedding (a lost executor does not chunk again), gives exact counts, and
    tells the optimizer the true size of the batch. Writing a batch id again replaces
    that batch, so a repeated call leaves the store as it was. ``keys`` are published with
    the rows, see ``CollectionStore.append``.
    """
    batch_id = batch_id or uuid.uuid4().hex
    counts = Observation()
    with staged_rows(hashed_chunks(df, **chunking).observe(counts, *_sizes()), "chunks") as staged:
        total = counts.get["chunks"]
        tasks = _tasks(staged.sparkSession, **counts.get)
        new = _insert(staged, total, store, collection, model, batch_id, dedupe, keys, tasks)
    return IngestResult(batch_id, new, total - new)


def _sizes() -> list[Column]:
    """What the tasks that write chunks observe of them; one that is tried again counts once."""
    return [F.expr("count(chunk_idx) AS chunks"), F.expr("sum(octet_length(content)) AS bytes")]


def _tasks(spark: SparkSession, chunks: int, bytes: int | None) -> int | None:
    """Tasks for the chunks of a small batch, which would else be dealt over all shuffle partitions."""
    if chunks > SMALL_BATCH:
        return None
    return max(1, min(spark.sparkContext.defaultParallelism, (bytes or 0) // _TASK_BYTES))


def _insert(
    chunks: DataFrame,
    n_chunks: int,
    store: CollectionStore,
    collection: str,
    model: Model,
    batch_id: str,
    dedupe: bool = True,
    keys: DataFrame | None = None,
    tasks: int | None = None,
) -> int:
    """Insert staged chunks; the number of new ones. Of equal chunks that of the first batch is kept."""
    if not dedupe:
        rows = stored_rows(chunks, collection, dedupe, batch_id)
        return store.append(embed_documents(rows, model), collection, batch_id, keys)
    with store.known_hashes(chunks, collection, without_batch=batch_id, n_chunks=n_chunks) as known:
        fresh = first_seen(chunks, order=[*_batch_column(chunks), *CHUNK_ORDER], tasks=tasks)
        rows = stored_rows(drop_known(fresh, known), collection, dedupe)
        return store.append(embed_documents(rows, model), collection, batch_id, keys)


def store_documents(
    documents: DataFrame,
    store: CollectionStore,
    collection: str,
    model: Model,
    batch_id: str | None = None,
) -> IngestResult:
    """Embed and append finished documents: no cleaning, no chunking, no de-duplication.

    Columns: custom_id (unique), document, cmetadata.
    """
    batch_id = batch_id or uuid.uuid4().hex
    rows = documents.select(
        row_uuid(F.lit(collection), F.col("custom_id")).alias("uuid"),
        "document",
        "cmetadata",
        F.col("custom_id").cast("string").alias("custom_id"),
        F.lit(None).cast("string").alias("content_hash"),
    )
    return IngestResult(batch_id, store.append(embed_documents(rows, model), collection, batch_id), 0)


def ingest_directory(
    spark: SparkSession,
    path: str,
    decoder: Decoder,
    store: CollectionStore,
    collection: str,
    model: Model,
    glob: str = PDF_GLOB,
    **options,
) -> IngestResult:
    """Every file below a folder, without a ledger. Files that fail to decode are left out and
    counted; ``failures`` names a folder for their paths and errors."""
    files = read_files(spark, [path], glob)
    return insert_decoded(decode_pages(files, decoder), store, collection, model, **options)


def ingest_new_titles(
    pages: DataFrame,
    ledger: Ledger,
    store: CollectionStore,
    collection: str,
    model: Model,
    **options,
) -> IngestResult:
    """Pages of titles the ledger does not hold, appended without hash de-duplication.

    The titles are published with their rows, so that a call after a crash, with whatever
    titles, takes none of them again.
    """
    done = ledger.finished(store, collection)
    with staged_rows(new_titles(pages, done), "titles") as fresh:
        keys = ledger.entries(fresh)
        result = insert_publications(fresh, store, collection, model, dedupe=False, keys=keys, **options)
        ledger.settle(store, collection)
        return result


def insert_decoded(
    pages: DataFrame,
    store: CollectionStore,
    collection: str,
    model: Model,
    batch_id: str | None = None,
    failures: str | None = None,
    dedupe: bool = True,
    keys: DataFrame | None = None,
    each_page: Callable[[DataFrame], None] | None = None,
    **chunking,
) -> IngestResult:
    """Insert the pages of decoded files; count those that failed, and record their ``source``
    and ``error`` by batch in the folder ``failures`` if one is named.

    The files are read once: their pages are cut as they are decoded and staged with their
    chunks, counted by what the writing tasks have written. ``each_page`` gets the staged
    rows of the pages, beside the insert.
    """
    batch_id = batch_id or uuid.uuid4().hex
    counts = Observation()
    chunks = page_chunks(pages, **chunking).observe(counts, *_sizes(), F.expr("count(error) AS failed"))
    with staged_rows(chunks, "chunks") as staged:
        sizes = counts.get
        total, n_failed = sizes["chunks"], sizes.pop("failed")
        if failures is not None:
            _record_failures(staged, f"{failures}/batch_id={batch_id}")
        tasks = _tasks(staged.sparkSession, **sizes)
        with beside(each_page and (lambda: each_page(chunked_pages(staged)))):
            new = _insert(chunks_of_pages(staged), total, store, collection, model, batch_id, dedupe, keys, tasks)
        some = staged.filter(F.col("error").isNotNull()).select("source", "error").take(5) if n_failed else []
    return IngestResult(batch_id, new, total - new, n_failed, tuple(f"{r.source}: {r.error}" for r in some))


def _record_failures(staged: DataFrame, path: str) -> None:
    failed = staged.filter(F.col("error").isNotNull()).select("source", "error")
    failed.write.mode("overwrite").parquet(path)


@contextmanager
def staged_rows(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """Rows written to the scratch folder, which goes when the work with them ends or fails.
    They are texts, which zstd makes a third smaller than the usual codec."""
    path = scratch_dir(df.sparkSession, purpose)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete_path(df.sparkSession, path)


def ingest_files_in_batches(
    spark: SparkSession,
    path: str,
    decoder: Decoder,
    ledger: Ledger,
    store: CollectionStore,
    collection: str,
    model: Model,
    files_per_batch: int = FILES_PER_BATCH,
    glob: str = PDF_GLOB,
    wave_files: int = WAVE_FILES,
    failures: str | None = None,
    dedupe: bool = True,
    **chunking,
) -> Sequence[IngestResult]:
    """Files that the ledger does not hold, in batches of ``files_per_batch`` (or one); a
    result for each batch.

    The listing is filtered before any file is opened. The batch is a column: all batches
    of some ``wave_files`` files (the first waves have fewer) are decoded, embedded and
    published together, so that the number of jobs does not follow the number of batches,
    and no file name passes the driver. A path is published with the rows of its wave; a
    file that failed to decode is not, so the next run tries it again.
    """
    listed = list_files(spark, path, glob).select("path")
    plan = assign_batches(new_files(listed, ledger.finished(store, collection)), ["path"], files_per_batch)
    last = plan.agg(F.max(_BATCH)).first()[0] or 0
    most = max(1, wave_files // files_per_batch)
    step = max(1, most // FIRST_WAVE)
    start, results = 1, WaveResults()
    try:
        while start <= last:
            numbers = range(start, min(start + step, last + 1))
            wave = plan.filter(F.col(_BATCH).between(numbers[0], numbers[-1])).select("path", _BATCH)
            contents = with_contents(wave, len(numbers) * files_per_batch)
            with staged_rows(page_chunks(decode_pages(contents, decoder), **chunking), "chunks") as staged:
                results.add(*_insert_wave(staged, numbers, ledger, store, collection, model, failures, dedupe))
            start, step = numbers.stop, min(2 * step, most)
    finally:
        # Once: it reads all keys that were published, also those of the waves before.
        ledger.settle(store, collection)
    return results


def _insert_wave(
    staged: DataFrame,
    numbers: range,
    ledger: Ledger,
    store: CollectionStore,
    collection: str,
    model: Model,
    failures: str | None,
    dedupe: bool,
) -> tuple[str, range, dict[int, tuple[int, int, int]]]:
    """Insert the staged chunks of a wave; its id, and new chunks, all chunks and failed files by batch."""
    wave_id = uuid.uuid4().hex
    if failures is not None:
        _record_failures(staged, f"{failures}/batch_id={wave_id}")
    by_batch = staged.groupBy(_BATCH).agg(F.count("chunk_idx"), F.count("error"))
    counts = {batch: (0, total, failed) for batch, total, failed in by_batch.collect()}
    n_chunks = sum(total for _, total, _ in counts.values())
    chunks = chunks_of_pages(staged)
    keys = ledger.entries(chunked_pages(staged).filter("error IS NULL").select(F.col("source").alias(ledger.key)))
    _insert(chunks, n_chunks, store, collection, model, wave_id, dedupe, keys)
    if dedupe:
        firsts = chunks.groupBy("content_hash").agg(F.min(_BATCH).alias(_BATCH))
        stored = store.batch_rows(collection, wave_id).select("content_hash")
        counted = firsts.join(stored, "content_hash", "left_semi").groupBy(_BATCH).count()
        new = dict(map(tuple, counted.collect()))
    else:
        new = {batch: total for batch, (_, total, _) in counts.items()}
    return wave_id, numbers, {batch: (new.get(batch, 0), *rest) for batch, (_, *rest) in counts.items()}
