"""Where the named queries and their check SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireworks.session import spread_over_cores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents, spread for work on every character."""
    return spread_over_cores(table(spark, folder, "documents"))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as pages: the source is the title, the document its page."""
    return table(spark, folder, "documents").select(
        F.col("source").alias("title"), F.col("doc_id").alias("page_no"), F.col("text").alias("content")
    )


def document_path():
    return F.concat(F.lit("s3://library/"), "source", F.lit("/"), "doc_id", F.lit(".pdf"))


def file_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: each line of a document is one page of the file."""
    return table(spark, folder, "documents").select(
        document_path().alias("source"),
        F.concat("doc_id", F.lit(".pdf")).alias("title"),
        F.posexplode(F.split("text", "\n")).alias("page_no", "content"),
    )


def labelled_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that stand for what was ingested before."""
    return table(spark, folder, "labels").select("doc_id").distinct()


def noisy(text):
    """Text with some letters exchanged for NUL, zero-width space, no-break space and line
    separator: characters the tables lack."""
    with_nul = F.replace(text, F.lit("z"), F.lit("\u0000"))  # translate cannot write a NUL
    return F.translate(with_nul, "kwq", "\u200b\u00a0\u2028")
