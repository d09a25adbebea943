"""A training corpus from documents: stages of the operators of quireworks.llm, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's documents. All but the last keep the columns of documents;
the last returns the pieces of the packed sequences. Stages take documents with repeated or
null ids, null and empty texts, and no rows at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireworks.llm import mixing, near_dups, packing, pii, toxicity
from quireworks.llm.common import table
from quireworks.session import materialize

NEAR_WORDS = 5  # words of a shingle
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, scores below its threshold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model)
    return scored.filter(F.col("score") < toxicity.THRESHOLD).drop("score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that of the smallest doc_id.

    Several texts under one doc_id are documents of their own: each is kept or dropped by
    its own text. Rows of equal doc_id and text become one.
    """
    return near_dups.first_texts(docs, NEAR_WORDS, NEAR_PERCENT)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked by its kind."""
    return pii.mask_personal_data(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, none to twice each."""
    return mixing.repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2,048 tokens, with their ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix),
    ("packing", pack),
]

# A classifier, signatures, a random field and a tokenizer have no SQL; tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs, _ = materialize(docs, f"pipeline-{name}")
    return docs
