"""Queries over chunks: cutting, hashing, de-duplication and their counts."""

from pyspark.sql import functions as F

from quireworks.functions.text import clean_text, has_visible_text
from quireworks.operators.chunking import char_windows, chunk_documents, explode_chunks
from quireworks.operators.dedupe import (
    distinct_hashes,
    drop_known,
    first_seen,
    hash_sample,
    keep_known,
    known_hashes,
)
from quireworks.operators.embedding import embed_documents, hashed_words
from quireworks.operators.summaries import chunks_per, ingest_summary
from quireworks.plans.ingest import hashed_chunks
from quireworks.registry.core import labelled_ids, noisy, pages, query
from quireworks.registry.sql import NOISY, PAGES, chunks, clean
from quireworks.session import materialize, spread_over_cores

_NOISY_PAGES = f"SELECT source AS title, doc_id AS page_no, {NOISY} AS content FROM documents"
_LABELLED = "page_no IN (SELECT doc_id FROM labels)"


def _labelled(df, spark, folder):
    ids = labelled_ids(spark, folder).withColumnRenamed("doc_id", "page_no")
    return df.join(ids, "page_no", "left_semi")


@query(
    "char_windows",
    f"""SELECT title, page_no, i AS chunk_idx, title || '_' || i AS chunk_id,
               trim(substring(t, 800 * i + 1, 1000), ' ') AS content
        FROM (SELECT *, unnest(range(greatest(ceil((length(t) - 200) / 800), 1)::BIGINT)) AS i
              FROM (SELECT title, page_no, {clean("content")} AS t FROM ({PAGES})) WHERE t <> '')""",
)
def char_windows_query(spark, folder):
    kept = spread_over_cores(pages(spark, folder)).filter(has_visible_text(F.col("content")))
    cleaned = kept.withColumn("content", clean_text(F.col("content")))
    windows = explode_chunks(cleaned, char_windows(F.col("content")))
    return windows.withColumn("chunk_idx", F.col("chunk_idx").cast("long"))


@query(
    "chunk_recursive",
    f"""WITH RECURSIVE {chunks(PAGES)}
        SELECT title, page_no, chunk_idx, title || '_' || chunk_idx AS chunk_id, content FROM chunks""",
)
def chunk_recursive(spark, folder):
    cut = chunk_documents(pages(spark, folder))
    return cut.withColumn("chunk_idx", F.col("chunk_idx").cast("long"))


@query(
    "chunk_reclean",
    f"""WITH RECURSIVE {chunks(_NOISY_PAGES)}
        SELECT title, page_no, chunk_idx, content FROM chunks""",
)
def chunk_reclean(spark, folder):
    """Texts in which the first cleaning leaves double spaces that only the second removes."""
    dirty = pages(spark, folder).withColumn("content", noisy(F.col("content")))
    cut = chunk_documents(dirty).drop("chunk_id")
    return cut.withColumn("chunk_idx", F.col("chunk_idx").cast("long"))


@query(
    "chunk_ids",
    f"""WITH RECURSIVE {chunks(PAGES)}
        SELECT page_no, chunk_idx, title || '_' || chunk_idx AS chunk_id, content_hash FROM chunks""",
)
def chunk_ids(spark, folder):
    cut = hashed_chunks(pages(spark, folder))
    return cut.select(
        "page_no",
        F.col("chunk_idx").cast("long").alias("chunk_idx"),
        F.concat_ws("_", "title", "chunk_idx").alias("chunk_id"),
        "content_hash",
    )


@query(
    "chunks_per_page",
    f"""WITH RECURSIVE {chunks(PAGES)}
        SELECT title, page_no, count(*) AS n_chunks FROM chunks GROUP BY ALL""",
)
def chunks_per_page(spark, folder):
    return chunks_per(hashed_chunks(pages(spark, folder)), ["title", "page_no"])


@query(
    "chunks_per_title",
    f"WITH RECURSIVE {chunks(PAGES)} SELECT title, count(*) AS n_chunks FROM chunks GROUP BY ALL",
)
def chunks_per_title(spark, folder):
    return chunks_per(hashed_chunks(pages(spark, folder)), ["title"])


@query(
    "dedupe_batch",
    f"""WITH RECURSIVE {chunks(PAGES)}
        SELECT content_hash, title, page_no, chunk_idx, content FROM chunks
        QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY title, page_no, chunk_idx) = 1""",
)
def dedupe_batch(spark, folder):
    first = first_seen(hashed_chunks(pages(spark, folder)))
    return first.withColumn("chunk_idx", F.col("chunk_idx").cast("long"))


def _batch_and_known(spark, folder):
    """All chunks, and those of the labelled documents as what the store holds."""
    keys = hashed_chunks(pages(spark, folder)).drop("content")
    batch, _ = materialize(keys, "chunks")
    stored = _labelled(batch, spark, folder)
    return batch, known_hashes(batch, stored, n_chunks=batch.count())


@query(
    "known_hash_filter",
    f"""WITH RECURSIVE {chunks(PAGES)}
        SELECT title, page_no, chunk_idx, content_hash FROM chunks
        WHERE content_hash NOT IN (SELECT content_hash FROM chunks WHERE {_LABELLED})""",
)
def known_hash_filter(spark, folder):
    batch, known = _batch_and_known(spark, folder)
    return drop_known(batch, known).select(
        "title", "page_no", F.col("chunk_idx").cast("long").alias("chunk_idx"), "content_hash"
    )


@query(
    "known_hash_match",
    f"""WITH RECURSIVE {chunks(PAGES)}
        SELECT title, page_no, chunk_idx, content_hash FROM chunks
        WHERE content_hash IN (SELECT content_hash FROM chunks WHERE {_LABELLED})""",
)
def known_hash_match(spark, folder):
    batch, known = _batch_and_known(spark, folder)
    return keep_known(batch, known).select(
        "title", "page_no", F.col("chunk_idx").cast("long").alias("chunk_idx"), "content_hash"
    )


@query(
    "distinct_hashes",
    f"WITH RECURSIVE {chunks(PAGES)} SELECT DISTINCT content_hash FROM chunks",
)
def distinct_hashes_query(spark, folder):
    return distinct_hashes(hashed_chunks(pages(spark, folder)))


@query(
    "hash_sample",
    f"""WITH RECURSIVE {chunks(PAGES)}
        SELECT DISTINCT content_hash FROM chunks ORDER BY content_hash LIMIT 3""",
)
def hash_sample_query(spark, folder):
    return hash_sample(hashed_chunks(pages(spark, folder)))


_SUMMARY = f"""
    marked AS (
        SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY title, page_no, chunk_idx) = 1
                  AND content_hash NOT IN (SELECT content_hash FROM chunks WHERE {_LABELLED}) AS fresh
        FROM chunks)"""


@query(
    "ingest_summary",
    f"""WITH RECURSIVE {chunks(PAGES)}, {_SUMMARY}
        SELECT title, count(*) FILTER (fresh) AS new_chunks,
               count(*) FILTER (NOT fresh) AS skipped_chunks, count(*) AS total_chunks
        FROM marked GROUP BY title""",
)
def ingest_summary_query(spark, folder):
    return ingest_summary(*_batch_and_known(spark, folder))


@query(
    "embed_hashed",
    f"""WITH RECURSIVE {chunks(PAGES)}, word AS (
            SELECT page_no, chunk_idx, unnest(string_split(content, ' ')) AS w FROM chunks
        ), bucket AS (
            SELECT page_no, chunk_idx, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS dim, count(*) AS n
            FROM word WHERE w <> '' GROUP BY ALL
        )
        SELECT page_no, chunk_idx, dim,
               round((n / sqrt(sum(n * n) OVER (PARTITION BY page_no, chunk_idx)))::FLOAT::DOUBLE, 6) AS weight
        FROM bucket""",
)
def embed_hashed(spark, folder):
    """Embeddings of all chunks by the stand-in model, as their non-zero entries."""
    cut = hashed_chunks(pages(spark, folder))
    vectors = embed_documents(cut, hashed_words(), text="content")
    entries = vectors.select(
        "page_no",
        F.col("chunk_idx").cast("long").alias("chunk_idx"),
        F.posexplode("embedding").alias("dim", "value"),
    )
    return entries.filter(F.col("value") > 0).select(
        "page_no",
        "chunk_idx",
        F.col("dim").cast("long").alias("dim"),
        F.round(F.col("value").cast("double"), 6).alias("weight"),
    )
