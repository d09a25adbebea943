"""Exact de-duplication by content hash, within a batch and against what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quireworks.operators.joins import lookup

# Hashes are 64 characters: this many make a broadcast of some 100 MB.
BROADCAST_HASHES = 1_000_000
CHUNK_ORDER = ("title", "page_no", "chunk_idx")


def first_seen(
    chunks: DataFrame,
    key: str = "content_hash",
    order: Sequence[str] = CHUNK_ORDER,
    tasks: int | None = None,
) -> DataFrame:
    """One row per key: the first in ``order``.

    The filter on row_number = 1 is planned as a window group limit below the exchange,
    so each map task sends at most one row per key and a key that holds a large share of
    all rows reaches its reducer as one row per map task. A small set, whose rows a few
    ``tasks`` can hold, goes to these as it is; to one without a shuffle.
    """
    if tasks is not None:
        chunks = chunks.coalesce(1) if tasks == 1 else chunks.repartition(tasks, key)
    window = Window.partitionBy(key).orderBy(*order)
    return (
        chunks.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def first_seen_keys(
    chunks: DataFrame, key: str = "content_hash", order: Sequence[str] = CHUNK_ORDER
) -> DataFrame:
    """Key and order columns of the first row per key, without the texts."""
    return first_seen(chunks.select(key, *order), key, order)


def known_hashes(
    chunks: DataFrame,
    stored: DataFrame,
    key: str = "content_hash",
    max_broadcast: int = BROADCAST_HASHES,
    n_chunks: int | None = None,
) -> DataFrame:
    """The distinct hashes of the batch that are stored already.

    The store is the big side and only its hash column is read. With a batch of at most
    ``max_broadcast`` rows (``n_chunks``, if the caller has counted them) the batch is
    broadcast and the store is scanned without a shuffle; otherwise both sides are reduced
    to distinct hashes and shuffled on them.
    """
    batch = chunks.select(key).distinct()
    stored = stored.select(key).filter(F.col(key).isNotNull() & (F.col(key) != ""))
    if n_chunks is not None and n_chunks <= max_broadcast:
        batch = F.broadcast(batch)
        return stored.join(batch, key, "left_semi").distinct()
    return stored.distinct().join(batch, key, "left_semi")


def drop_known(chunks: DataFrame, known: DataFrame, key: str = "content_hash") -> DataFrame:
    """Chunks whose hash is not known. After ``first_seen`` the join keeps that partitioning."""
    return lookup(chunks, known.select(key), key, "left_anti")


def keep_known(chunks: DataFrame, known: DataFrame, key: str = "content_hash") -> DataFrame:
    """The other side of ``drop_known``: chunks whose hash is known."""
    return lookup(chunks, known.select(key), key, "left_semi")


def distinct_hashes(stored: DataFrame, key: str = "content_hash") -> DataFrame:
    return stored.select(key).filter(F.col(key).isNotNull() & (F.col(key) != "")).distinct()


def hash_sample(stored: DataFrame, n: int = 3, key: str = "content_hash") -> DataFrame:
    """The ``n`` smallest distinct hashes: a sample that does not change between runs."""
    return distinct_hashes(stored, key).orderBy(key).limit(n)
