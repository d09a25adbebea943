"""Counts the ingest reports, and the checks its table constraints stand for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireworks.functions.text import is_blank
from quireworks.operators.dedupe import drop_known, first_seen_keys
from quireworks.operators.joins import lookup


def ingest_summary(
    chunks: DataFrame, known: DataFrame, by: Sequence[str] = ("title",)
) -> DataFrame:
    """New, skipped and total chunks per ``by``; skipped holds known hashes and repeats.

    Totals and winners are counted apart and joined as counts, so no window has to mark
    every copy of a hot hash.
    """
    by = list(by)
    total = chunks.groupBy(*by).agg(F.count(F.lit(1)).alias("total_chunks"))
    new = drop_known(first_seen_keys(chunks), known)
    new = new.groupBy(*by).agg(F.count(F.lit(1)).alias("new_chunks"))
    if by:
        both = total.join(new, by, "left")
    else:
        tag = F.lit(1).alias("_all")
        both = total.select("*", tag).join(new.select("*", tag), "_all", "left").drop("_all")
    n_new = F.coalesce(F.col("new_chunks"), F.lit(0))
    return both.select(
        *by,
        n_new.alias("new_chunks"),
        (F.col("total_chunks") - n_new).alias("skipped_chunks"),
        "total_chunks",
    )


def chunks_per(chunks: DataFrame, by: Sequence[str]) -> DataFrame:
    return chunks.groupBy(*by).agg(F.count(F.lit(1)).alias("n_chunks"))


def collection_counts(rows: DataFrame, collection: str = "collection") -> DataFrame:
    return rows.groupBy(collection).agg(F.count(F.lit(1)).alias("n_rows"))


def load_totals(pages: DataFrame, content: str = "content") -> DataFrame:
    """Pages loaded, and pages left without the blank ones."""
    blank = is_blank(F.col(content))
    return pages.agg(
        F.count(F.lit(1)).alias("n_loaded"), F.count_if(~blank).alias("n_after_strip")
    )


def file_counts(files: DataFrame, ledger: DataFrame, key: str = "path") -> DataFrame:
    """Files found, found before and new, in one pass over the listing.

    Both sides are reduced to flags per path first, so neither has to be broadcast.
    """
    flags = files.select(key, F.lit(1).alias("listed"), F.lit(0).alias("done")).unionAll(
        ledger.select(key, F.lit(0).alias("listed"), F.lit(1).alias("done"))
    )
    per_path = flags.groupBy(key).agg(F.sum("listed").alias("listed"), F.max("done").alias("done"))
    done = F.col("done") == 1
    return per_path.agg(
        F.coalesce(F.sum("listed"), F.lit(0)).alias("n_found"),
        F.count_if(done).alias("n_processed"),
        F.coalesce(F.sum(F.when(~done, F.col("listed"))), F.lit(0)).alias("n_new"),
    )


def duplicate_keys(rows: DataFrame, key: str = "uuid") -> DataFrame:
    """Key values held by more than one row: empty where the primary key holds."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def collection_rows(
    rows: DataFrame, collections: DataFrame, key: str = "collection_id"
) -> DataFrame:
    """Rows with the columns of their collection; a collection may hold most of the rows."""
    return lookup(rows, collections, key, "inner")


def orphan_rows(
    rows: DataFrame, collections: DataFrame, key: str = "collection_id"
) -> DataFrame:
    """Rows whose collection does not exist: empty where the foreign key holds."""
    return lookup(rows, collections.select(key).distinct(), key, "left_anti")


def cascade_delete(
    rows: DataFrame, doomed: DataFrame, key: str = "collection_id"
) -> DataFrame:
    """Rows left after the doomed collections and everything in them are gone."""
    return lookup(rows, doomed.select(key).distinct(), key, "left_anti")


def null_byte_titles(pages: DataFrame, has_nul: Column, title: str = "title") -> DataFrame:
    """One row per page that contains a NUL."""
    return pages.filter(has_nul).select(title, *[c for c in pages.columns if c == "page_no"])
