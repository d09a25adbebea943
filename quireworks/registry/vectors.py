"""Queries over vectors, the integrity of the stored rows, and prompts."""

from pyspark.sql import functions as F

from quireworks.functions.keys import metadata_json
from quireworks.operators.prompts import assemble_context, assemble_prompts
from quireworks.operators.search import search_hits, topk, topk_batch
from quireworks.operators.summaries import (
    cascade_delete,
    collection_counts,
    collection_rows,
    duplicate_keys,
    orphan_rows,
)
from quireworks.registry.core import labelled_ids, query, table


def dot_sql(a: str, b: str) -> str:
    return f"list_inner_product({a}::DOUBLE[], {b}::DOUBLE[])"


def distance_sql(a: str, b: str) -> str:
    norms = f"(sqrt({dot_sql(a, a)}) * sqrt({dot_sql(b, b)}))"
    return f"round(1 - {dot_sql(a, b)} / nullif({norms}, 0), 12)"


def _stored(spark, folder):
    """Embeddings as stored vectors: the label is the collection, vec_id the key."""
    return table(spark, folder, "embeddings").withColumnRenamed("label", "collection_id")


def _collections(spark, folder):
    return table(spark, folder, "region").select(
        F.col("r_regionkey").cast("int").alias("collection_id"), F.col("r_name").alias("name")
    )


def _queries(spark, folder):
    """One query vector per conversation: the stored vector with its number."""
    asked = table(spark, folder, "conversations").select(F.col("conv_id").alias("vec_id")).distinct()
    vectors = table(spark, folder, "embeddings").join(asked, "vec_id", "left_semi")
    return vectors.select(F.col("vec_id").alias("query_id"), "embedding")


def _rounded(hits):
    return hits.withColumn("distance", F.round("distance", 6) + F.lit(0.0)).withColumn(
        "rank", F.col("rank").cast("long")
    )


_QUERIES = """SELECT vec_id AS query_id, embedding FROM embeddings
              WHERE vec_id IN (SELECT conv_id FROM conversations)"""
_RANKED = f"""
    SELECT q.query_id, v.vec_id, v.label, {distance_sql("v.embedding", "q.embedding")} AS d
    FROM ({_QUERIES}) q, embeddings v"""
_TOP = """QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d NULLS LAST, vec_id) <= {k}"""
_RANK = "row_number() OVER (PARTITION BY query_id ORDER BY d NULLS LAST, vec_id) AS rank"


@query(
    "topk_cosine",
    f"""SELECT row_number() OVER (ORDER BY d, vec_id) AS rank, vec_id, round(d, 6) + 0.0::DOUBLE AS distance
        FROM (SELECT v.vec_id, {distance_sql("v.embedding", "q.embedding")} AS d
              FROM embeddings v, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q)
        ORDER BY d, vec_id LIMIT 5""",
)
def topk_cosine(spark, folder):
    """One query: the vector with the smallest id, a single row to the driver."""
    vectors = table(spark, folder, "embeddings")
    asked = vectors.orderBy("vec_id").select("embedding").first()[0]
    return _rounded(topk(vectors, asked, 5))


@query(
    "topk_batch",
    f"""SELECT query_id, {_RANK}, vec_id, round(d, 6) + 0.0::DOUBLE AS distance FROM ({_RANKED})
        {_TOP.format(k=5)}""",
)
def topk_batch_query(spark, folder):
    return _rounded(topk_batch(table(spark, folder, "embeddings"), _queries(spark, folder), 5))


@query(
    "topk_in_collection",
    f"""SELECT query_id, {_RANK}, vec_id, collection_id, round(d, 6) + 0.0::DOUBLE AS distance
        FROM (SELECT r.*, label AS collection_id FROM ({_RANKED}) r
              JOIN region ON r_regionkey = label WHERE r_name = 'EUROPE')
        {_TOP.format(k=5)}""",
)
def topk_in_collection(spark, folder):
    named = _collections(spark, folder).filter(F.col("name") == "EUROPE")
    rows = collection_rows(_stored(spark, folder), named)
    return _rounded(topk_batch(rows, _queries(spark, folder), 5, keep=["collection_id"]))


def _rows_with_text(spark, folder):
    """Each stored vector's text and metadata: the document with its number. Only labelled
    documents have a title."""
    labels = labelled_ids(spark, folder).withColumn("labelled", F.lit(True))
    documents = table(spark, folder, "documents").join(labels, "doc_id", "left")
    return documents.select(
        F.col("doc_id").alias("vec_id"),
        F.col("text").alias("document"),
        metadata_json(F.when(F.col("labelled"), F.col("source"))).alias("cmetadata"),
    )


def _hits(spark, folder, k):
    hits = topk_batch(table(spark, folder, "embeddings"), _queries(spark, folder), k)
    return search_hits(hits, _rows_with_text(spark, folder), ["vec_id"])


_HITS = f"""
    SELECT query_id, rank, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN source ELSE 'Unknown' END AS title,
           text AS content, distance
    FROM (SELECT query_id, {_RANK}, vec_id, round(d, 6) + 0.0::DOUBLE AS distance FROM ({_RANKED})
          QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d NULLS LAST, vec_id) <= 3)
    JOIN documents ON doc_id = vec_id"""


@query("search_hits", _HITS)
def search_hits_query(spark, folder):
    return _rounded(_hits(spark, folder, 3))


_CONTEXT = f"""
    SELECT query_id, string_agg('From ' || title || ':' || chr(10) || content, chr(10) || chr(10) ORDER BY rank) AS context
    FROM ({_HITS}) GROUP BY query_id"""


@query("rag_context", _CONTEXT)
def rag_context(spark, folder):
    return assemble_context(_hits(spark, folder, 3)).select("query_id", "context")


def prompt_sql(context: str, question: str) -> str:
    """The prompt text of operators.prompts as SQL."""
    # Fixed value: the prompt text, line breaks and indents included.
    return f"""'
        Based on the following research findings, answer the student''s question:

        Research Context:
        ' || {context} || '

        Researcher''s Question: ' || {question} || '

        Answer: Provide a comprehensive answer based on the findings above.
        '"""


@query(
    "rag_prompt",
    f"""SELECT query_id, question, {prompt_sql("coalesce(context, '')", "question")} AS prompt
        FROM (SELECT conv_id AS query_id, arg_min(text, turn) AS question FROM conversations
              WHERE role = 'user' GROUP BY conv_id)
        LEFT JOIN ({_CONTEXT}) USING (query_id)""",
)
def rag_prompt(spark, folder):
    user = table(spark, folder, "conversations").filter(F.col("role") == "user")
    questions = user.groupBy(F.col("conv_id").alias("query_id")).agg(
        F.min_by("text", "turn").alias("question")
    )
    return assemble_prompts(_hits(spark, folder, 3), questions).drop("hits")


def _named(spark, folder):
    named = _collections(spark, folder).filter(F.col("name") == "EUROPE")
    rows = collection_rows(_stored(spark, folder), named)
    return rows.select("collection_id", "name", "vec_id")


@query(
    "collection_rows",
    """SELECT vec_id, label AS collection_id, r_name AS name FROM embeddings
       JOIN region ON r_regionkey = label""",
)
def collection_rows_query(spark, folder):
    rows = collection_rows(_stored(spark, folder), _collections(spark, folder))
    return rows.select("vec_id", "collection_id", "name")


@query(
    "collection_counts",
    "SELECT label AS collection_id, count(*) AS n_rows FROM embeddings GROUP BY label",
)
def collection_counts_query(spark, folder):
    return collection_counts(_stored(spark, folder), "collection_id")


@query(
    "first_collection",
    """SELECT label AS collection_id, r_name AS name, vec_id FROM embeddings
       JOIN region ON r_regionkey = label WHERE r_name = 'EUROPE' ORDER BY vec_id LIMIT 1""",
)
def first_collection(spark, folder):
    """The first row of a collection looked up by name."""
    return _named(spark, folder).orderBy("vec_id").limit(1)


@query(
    "collection_size",
    """SELECT label AS collection_id, r_name AS name, count(*) AS n_rows FROM embeddings
       JOIN region ON r_regionkey = label WHERE r_name = 'EUROPE' GROUP BY ALL""",
)
def collection_size(spark, folder):
    """One number: the rows of a collection looked up by name."""
    return _named(spark, folder).groupBy("collection_id", "name").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "orphan_rows",
    """SELECT vec_id, label AS collection_id FROM embeddings
       WHERE label NOT IN (SELECT r_regionkey FROM region)""",
)
def orphan_rows_query(spark, folder):
    orphans = orphan_rows(_stored(spark, folder), _collections(spark, folder))
    return orphans.select("vec_id", "collection_id")


@query(
    "cascade_delete",
    """SELECT vec_id, label AS collection_id FROM embeddings
       WHERE label NOT IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')""",
)
def cascade_delete_query(spark, folder):
    doomed = _collections(spark, folder).filter(F.col("name") == "ASIA")
    left = cascade_delete(_stored(spark, folder), doomed)
    return left.select("vec_id", "collection_id")


@query(
    "key_uniqueness",
    """SELECT text_hash AS uuid, count(*) AS n_rows FROM (SELECT sha256(text) AS text_hash FROM documents)
       GROUP BY text_hash HAVING count(*) > 1""",
)
def key_uniqueness(spark, folder):
    """Keys that break a primary key; a hash of the text is one for all but exact copies."""
    rows = table(spark, folder, "documents").select(F.sha2("text", 256).alias("uuid"))
    return duplicate_keys(rows)
