"""Queries over single texts, keys, pages and ledgers."""

from pyspark.sql import functions as F

from quireworks.functions import keys
from quireworks.functions.text import (
    clean_text,
    collapse_whitespace,
    has_nul,
    has_visible_text,
    remove_nul,
    strip_nonprintable,
    strip_whitespace,
)
from quireworks.operators.batching import assign_batches
from quireworks.operators.ledger import new_files, new_titles, with_titles
from quireworks.operators.summaries import file_counts, load_totals, null_byte_titles
from quireworks.plans.ingest import publication_title
from quireworks.registry.core import (
    document_path,
    documents,
    file_pages,
    labelled_ids,
    noisy,
    pages,
    query,
    table,
)
from quireworks.registry.sql import (
    FILE_PAGES,
    NO_BREAK_SPACES,
    NOISY,
    NON_PRINTABLE,
    clean,
    collapse,
    strip,
)
from quireworks.sources.files import document_concat, page_list, page_rows


@query(
    "clean_text",
    f"SELECT doc_id, {clean('text')} AS cleaned, {clean(NOISY)} AS cleaned_noisy FROM documents",
)
def clean_text_query(spark, folder):
    text = F.col("text")
    return documents(spark, folder).select(
        "doc_id", clean_text(text).alias("cleaned"), clean_text(noisy(text)).alias("cleaned_noisy")
    )


@query("whitespace_collapse", f"SELECT doc_id, {collapse('text')} AS collapsed FROM documents")
def whitespace_collapse(spark, folder):
    text = F.col("text")
    return documents(spark, folder).select(
        "doc_id", collapse_whitespace(text).alias("collapsed")
    )


@query(
    "strip_nonprintable",
    f"""SELECT doc_id, regexp_replace({NOISY}, '{NON_PRINTABLE}|{NO_BREAK_SPACES}', '', 'g') AS printable
        FROM documents""",
)
def strip_nonprintable_query(spark, folder):
    text = noisy(F.col("text"))
    return documents(spark, folder).select(
        "doc_id", strip_nonprintable(text).alias("printable")
    )


@query("remove_nul", f"SELECT doc_id, replace({NOISY}, chr(0), '') AS without_nul FROM documents")
def remove_nul_query(spark, folder):
    return documents(spark, folder).select(
        "doc_id", remove_nul(noisy(F.col("text"))).alias("without_nul")
    )


@query("content_hash", "SELECT doc_id, sha256(text) AS content_hash FROM documents")
def content_hash_query(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", keys.content_hash(F.col("text")).alias("content_hash")
    )


@query(
    "title_content_hash",
    f"""SELECT doc_id, sha256(lower({strip("source")}) || '::' || lower({strip("text")}))
               AS title_content_hash
        FROM documents""",
)
def title_content_hash_query(spark, folder):
    return documents(spark, folder).select(
        "doc_id",
        keys.title_content_hash(F.col("source"), F.col("text")).alias("title_content_hash"),
    )


# Pages whose title is missing: the labels decide, as an outer join leaves the rest null.
_TITLED = """
    SELECT CASE WHEN l.doc_id IS NOT NULL THEN d.source END AS title,
           d.doc_id AS page_no, d.text AS content
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def _titled(spark, folder):
    labels = labelled_ids(spark, folder).withColumn("labelled", F.lit(True))
    return table(spark, folder, "documents").join(labels, "doc_id", "left").select(
        F.when(F.col("labelled"), F.col("source")).alias("title"),
        F.col("doc_id").alias("page_no"),
        F.col("text").alias("content"),
    )


@query(
    "default_title",
    f"""SELECT page_no, coalesce(title, '') AS title, 'Untitled' AS title_without_column
        FROM ({_TITLED})""",
)
def default_title(spark, folder):
    """A null title is an empty one; only a missing title column has the default."""
    titled = _titled(spark, folder)
    return titled.select(
        "page_no",
        publication_title(titled).alias("title"),
        publication_title(titled.drop("title")).alias("title_without_column"),
    )


@query(
    "untitled_title",
    f"SELECT page_no, coalesce(title, 'untitled_' || sha256(content)) AS title FROM ({_TITLED})",
)
def untitled_title(spark, folder):
    return with_titles(_titled(spark, folder)).select("page_no", "title")


@query(
    "metadata_json",
    """SELECT doc_id, json_object('title', source, 'content_hash', sha256(text))::VARCHAR AS cmetadata,
              sha256(text) AS content_hash, source AS title
       FROM documents""",
)
def metadata_json_query(spark, folder):
    made = table(spark, folder, "documents").select(
        "doc_id",
        keys.metadata_json(F.col("source"), keys.content_hash(F.col("text"))).alias("cmetadata"),
    )
    metadata = F.col("cmetadata")
    return made.select(
        "doc_id",
        "cmetadata",
        keys.metadata_field(metadata, "content_hash").alias("content_hash"),
        keys.hit_title(metadata).alias("title"),
    )


@query("hash_prefix", "SELECT doc_id, substr(sha256(text), 1, 8) || '...' AS prefix FROM documents")
def hash_prefix_query(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", keys.hash_prefix(keys.content_hash(F.col("text"))).alias("prefix")
    )


# Every kind of blank: pages of toxic documents hold nothing visible, others get blank edges.
_BLANKED = """
    SELECT d.source AS title, d.doc_id AS page_no,
           CASE WHEN l.toxic = 1 THEN chr(160) || chr(10) || ' '
                WHEN l.quality = 0 THEN chr(8232) || ' ' || d.text || chr(9)
                ELSE d.text END AS content
    FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality
                                FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id"""


def _blanked(spark, folder):
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min("quality").alias("quality")
    )
    text = F.col("text")
    edged = F.concat(F.lit("\u2028 "), text, F.lit("\t"))
    return table(spark, folder, "documents").join(labels, "doc_id", "left").select(
        F.col("source").alias("title"),
        F.col("doc_id").alias("page_no"),
        F.when(F.col("toxic") == 1, F.lit("\u00a0\n "))
        .when(F.col("quality") == 0, edged)
        .otherwise(text)
        .alias("content"),
    )


@query(
    "page_rows",
    f"""SELECT title, page_no, content FROM (
            SELECT title, page_no, {strip("content")} AS content FROM ({_BLANKED}))
        WHERE content <> ''""",
)
def page_rows_query(spark, folder):
    return page_rows(_blanked(spark, folder))


@query(
    "page_list", f"SELECT content FROM ({_BLANKED}) WHERE {strip('content')} <> ''"
)
def page_list_query(spark, folder):
    return page_list(_blanked(spark, folder))


@query(
    "skip_empty",
    f"""SELECT title, page_no, content FROM (
            SELECT title, page_no, {clean("content")} AS content FROM ({_BLANKED}))
        WHERE content <> ''""",
)
def skip_empty(spark, folder):
    kept = _blanked(spark, folder).filter(has_visible_text(F.col("content")))
    return kept.withColumn("content", clean_text(F.col("content")))


@query(
    "load_totals",
    f"""SELECT count(*) AS n_loaded, count(*) FILTER ({strip("content")} <> '') AS n_after_strip
        FROM ({_BLANKED})""",
)
def load_totals_query(spark, folder):
    return load_totals(_blanked(spark, folder))


@query(
    "null_byte_report",
    f"SELECT source AS title, doc_id AS page_no FROM documents WHERE contains({NOISY}, chr(0))",
)
def null_byte_report(spark, folder):
    noisy_pages = pages(spark, folder).withColumn("content", noisy(F.col("content")))
    return null_byte_titles(noisy_pages, has_nul(F.col("content")))


@query(
    "document_concat",
    f"""SELECT 's3://library/' || d.source || '/' || d.doc_id || '.pdf' AS source, d.lang AS title,
               string_agg(p.content, '' ORDER BY p.page_no) AS content
        FROM ({FILE_PAGES}) p JOIN documents d ON p.title = d.doc_id || '.pdf' GROUP BY ALL""",
)
def document_concat_query(spark, folder):
    """Files of four base names, one for each language, in folders of their own."""
    named = table(spark, folder, "documents").select(
        document_path().alias("source"), F.concat("lang", F.lit(".pdf")).alias("named")
    )
    same = file_pages(spark, folder).join(named, "source").withColumn("title", F.col("named"))
    return document_concat(same.drop("named"))


@query(
    "path_parts",
    """SELECT doc_id, 'library' AS bucket, source || '/' || doc_id || '.pdf' AS key,
              doc_id || '.pdf' AS file_name, doc_id::VARCHAR AS stem, true AS is_pdf, false AS is_txt
       FROM documents""",
)
def path_parts(spark, folder):
    path = document_path()
    return table(spark, folder, "documents").select(
        "doc_id",
        keys.path_bucket(path).alias("bucket"),
        keys.path_key(path).alias("key"),
        keys.path_name(path).alias("file_name"),
        keys.path_stem(path).alias("stem"),
        keys.has_suffix(path, ".PDF").alias("is_pdf"),
        keys.has_suffix(path, ".txt", case_sensitive=True).alias("is_txt"),
    )


def _listing(spark, folder):
    return table(spark, folder, "documents").select(document_path().alias("path"))


def _file_ledger(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.join(labelled_ids(spark, folder), "doc_id", "left_semi").select(
        document_path().alias("path")
    )


_PATHS = "SELECT 's3://library/' || source || '/' || doc_id || '.pdf' AS path, doc_id FROM documents"


@query(
    "new_files", f"SELECT path FROM ({_PATHS}) WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
)
def new_files_query(spark, folder):
    return new_files(_listing(spark, folder), _file_ledger(spark, folder))


@query(
    "file_counts",
    f"""SELECT count(*) AS n_found,
               count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) AS n_processed,
               count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) AS n_new
        FROM ({_PATHS})""",
)
def file_counts_query(spark, folder):
    return file_counts(_listing(spark, folder), _file_ledger(spark, folder))


@query(
    "batch_plan",
    f"""SELECT path, (row_number() OVER (ORDER BY path) - 1) // 50 + 1 AS batch_no
        FROM ({_PATHS}) WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def batch_plan(spark, folder):
    fresh = new_files(_listing(spark, folder), _file_ledger(spark, folder))
    return assign_batches(fresh, ["path"], per_batch=50)


@query(
    "new_titles",
    f"""SELECT title, page_no, content FROM ({FILE_PAGES})
        WHERE title NOT IN (SELECT doc_id || '.pdf' FROM labels)""",
)
def new_titles_query(spark, folder):
    seen = labelled_ids(spark, folder).select(F.concat("doc_id", F.lit(".pdf")).alias("title"))
    fresh = new_titles(file_pages(spark, folder), seen)
    return fresh.select("title", F.col("page_no").cast("long").alias("page_no"), "content")
