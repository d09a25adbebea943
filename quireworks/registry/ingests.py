"""Queries that run whole ingests into a store in the scratch folder and return its rows."""

from pyspark.sql import functions as F

from quireworks.functions.keys import metadata_json
from quireworks.operators.embedding import hashed_words
from quireworks.plans.answer import answer_prompts
from quireworks.plans.ingest import (
    ingest_directory,
    ingest_files_in_batches,
    ingest_new_titles,
    insert_publications,
    store_documents,
)
from quireworks.registry.chunks import _LABELLED, _SUMMARY, _labelled
from quireworks.registry.core import file_pages, labelled_ids, pages, query, table
from quireworks.registry.sql import FILE_PAGES, PAGES, chunks
from quireworks.registry.vectors import distance_sql, prompt_sql
from quireworks.session import scratch_dir
from quireworks.sources.files import (
    TXT_GLOB,
    decode_pages,
    list_files,
    page_rows,
    read_files,
    text_files,
    utf8_pages,
)
from quireworks.sources.listing import write_files
from quireworks.sources.store import CollectionStore, Ledger
from quireworks.streaming.ingest import (
    file_stream,
    ingest_file_stream,
    ingest_page_stream,
    ingest_pages_by_state,
    page_stream,
)

COLLECTION = "papers"
MODEL = hashed_words()


def _store(spark):
    return CollectionStore(spark, scratch_dir(spark, "store"))


def _ingest_twice(spark, folder):
    """The labelled documents first, then all of them."""
    store = _store(spark)
    everything = pages(spark, folder)
    before = _labelled(everything, spark, folder)
    results = [
        insert_publications(before, store, COLLECTION, MODEL, "1"),
        insert_publications(everything, store, COLLECTION, MODEL, "2"),
    ]
    return store, results


_FIRST = f"""first AS (
    SELECT * FROM chunks WHERE {_LABELLED}
    QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY title, page_no, chunk_idx) = 1)"""


@query(
    "ingest_dedupe",
    f"""WITH RECURSIVE {chunks(PAGES)}, {_SUMMARY}, {_FIRST}
        SELECT sha256('papers' || chr(1) || content_hash) AS uuid, content AS document,
               json_object('title', title, 'content_hash', content_hash)::VARCHAR AS cmetadata,
               content_hash, batch_id
        FROM (SELECT title, content, content_hash, '1' AS batch_id FROM first UNION ALL
              SELECT title, content, content_hash, '2' FROM marked WHERE fresh)""",
)
def ingest_dedupe(spark, folder):
    store, _ = _ingest_twice(spark, folder)
    return store.rows(COLLECTION).select("uuid", "document", "cmetadata", "content_hash", "batch_id")


@query(
    "ingest_result",
    f"""WITH RECURSIVE {chunks(PAGES)}, {_SUMMARY}, {_FIRST}, total AS (
            SELECT '1' AS batch_id, (SELECT count(*) FROM first) AS new_chunks,
                   (SELECT count(*) FROM chunks WHERE {_LABELLED}) AS total_chunks
            UNION ALL
            SELECT '2', (SELECT count(*) FROM marked WHERE fresh), (SELECT count(*) FROM chunks))
        SELECT batch_id, new_chunks, total_chunks - new_chunks AS skipped_chunks, total_chunks FROM total""",
)
def ingest_result(spark, folder):
    _, results = _ingest_twice(spark, folder)
    rows = [(r.batch_id, r.new_chunks, r.skipped_chunks, r.total_chunks) for r in results]
    return spark.createDataFrame(
        rows, "batch_id string, new_chunks bigint, skipped_chunks bigint, total_chunks bigint"
    )


@query(
    "ingest_append",
    f"""WITH RECURSIVE {chunks(PAGES)}
        SELECT content AS document, json_object('title', title)::VARCHAR AS cmetadata FROM chunks""",
)
def ingest_append(spark, folder):
    store = _store(spark)
    insert_publications(pages(spark, folder), store, COLLECTION, MODEL, dedupe=False)
    return store.rows(COLLECTION).select("document", "cmetadata")


@query(
    "ingest_append_repeats",
    f"""WITH RECURSIVE {chunks(PAGES)}
        SELECT content AS document, 2 * count(*) AS n_rows, 2 * count(*) AS n_keys FROM chunks GROUP BY content""",
)
def ingest_append_repeats(spark, folder):
    """Every document twice in one batch: rows of their own, each under its own key."""
    store = _store(spark)
    everything = pages(spark, folder)
    insert_publications(everything.unionAll(everything), store, COLLECTION, MODEL, dedupe=False)
    # Counted by digests of the texts: a count of distinct keys by text would shuffle every
    # row's text twice, this way one copy from each task goes over once.
    digest = F.coalesce(F.unhex(F.sha2("document", 256)), F.lit(b"")).alias("digest")
    rows = store.rows(COLLECTION).select(digest, "document", "uuid")
    counts = F.count(F.lit(1)).alias("n_rows"), F.count_distinct("uuid").alias("n_keys")
    texts = rows.groupBy("digest").agg(F.any_value("document").alias("document"))
    return texts.join(rows.groupBy("digest").agg(*counts), "digest").drop("digest")


@query(
    "ingest_embeddings",
    f"""WITH RECURSIVE {chunks(PAGES)}, {_SUMMARY}, {_FIRST}, word AS (
            SELECT content_hash, unnest(string_split(content, ' ')) AS w
            FROM (SELECT content_hash, content FROM first UNION ALL
                  SELECT content_hash, content FROM marked WHERE fresh)
        ), bucket AS (
            SELECT content_hash, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS dim, count(*) AS n
            FROM word WHERE w <> '' GROUP BY ALL)
        SELECT content_hash, dim,
               round((n / sqrt(sum(n * n) OVER (PARTITION BY content_hash)))::FLOAT::DOUBLE, 6) AS weight
        FROM bucket""",
)
def ingest_embeddings(spark, folder):
    """The stored vectors of two batches, as their entries that are not zero."""
    store, _ = _ingest_twice(spark, folder)
    entries = store.rows(COLLECTION).select("content_hash", F.posexplode("embedding").alias("dim", "value"))
    weight = F.round(F.col("value").cast("double"), 6).alias("weight")
    return entries.filter("value > 0").select("content_hash", F.col("dim").cast("long").alias("dim"), weight)


@query(
    "ingest_compacted",
    f"""WITH RECURSIVE {chunks(PAGES)}, {_SUMMARY}, {_FIRST}
        SELECT sha256('papers' || chr(1) || content_hash) AS uuid, content AS document, content_hash
        FROM (SELECT content, content_hash FROM first UNION ALL
              SELECT content, content_hash FROM marked WHERE fresh)""",
)
def ingest_compacted(spark, folder):
    store, _ = _ingest_twice(spark, folder)
    store.compact(COLLECTION, 2)
    return store.rows(COLLECTION).select("uuid", "document", "content_hash")


def _benchmark_documents(spark, folder):
    item = F.concat(F.lit("item-"), "item_id")
    return table(spark, folder, "benchmark").select(
        item.alias("custom_id"), F.col("text").alias("document"), metadata_json(item).alias("cmetadata")
    )


@query(
    "store_documents",
    """SELECT sha256('papers' || chr(1) || custom_id) AS uuid, custom_id, text AS document,
              json_object('title', custom_id)::VARCHAR AS cmetadata
       FROM (SELECT 'item-' || item_id AS custom_id, text FROM benchmark)""",
)
def store_documents_query(spark, folder):
    store = _store(spark)
    store_documents(_benchmark_documents(spark, folder), store, COLLECTION, MODEL)
    return store.rows(COLLECTION).select("uuid", "custom_id", "document", "cmetadata")


@query(
    "drop_collection",
    "SELECT 'kept' AS name, count(*) AS n_rows FROM benchmark",
)
def drop_collection(spark, folder):
    """Two collections, one dropped with its rows: what is left, by name."""
    store = _store(spark)
    documents = _benchmark_documents(spark, folder)
    for name in ("kept", "dropped"):
        store_documents(documents, store, name, MODEL)
    store.drop_collection("dropped")
    names = store.collections().select("name", F.col("uuid").alias("collection_id"))
    joined = store.rows().join(names, "collection_id", "left")
    return joined.groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "title_ledger_ingest",
    f"""WITH RECURSIVE {chunks(f"SELECT title, page_no, content FROM ({FILE_PAGES}) WHERE title NOT IN (SELECT doc_id || '.pdf' FROM labels)")}
        SELECT content AS document, json_object('title', title)::VARCHAR AS cmetadata FROM chunks""",
)
def title_ledger_ingest(spark, folder):
    """Pages of titles the ledger lacks; the second run finds nothing new."""
    store = _store(spark)
    ledger = Ledger(spark, scratch_dir(spark, "ledger"), key="title")
    ledger.commit(labelled_ids(spark, folder).select(F.concat("doc_id", F.lit(".pdf")).alias("title")))
    for _ in range(2):
        ingest_new_titles(file_pages(spark, folder), ledger, store, COLLECTION, MODEL)
    return store.rows(COLLECTION).select("document", "cmetadata")


def _written_files(documents, spark):
    """Documents as files on the shared file system, one ``.txt`` each below a folder that
    names the source and the document."""
    root = scratch_dir(spark, "files")
    _write_files(documents, root)
    return root


def _write_files(documents, root):
    path = F.concat(F.lit(f"{root}/source="), "source", F.lit("/doc_id="), "doc_id", F.lit("/text.txt"))
    write_files(documents.select(path.alias("path"), F.concat("text", F.lit("\n")).alias("content")))


def _from_path(path: str):
    return [
        F.regexp_extract(path, r"source=([^/]*)/", 1).alias("source"),
        F.regexp_extract(path, r"doc_id=([^/]*)/", 1).cast("long").alias("doc_id"),
    ]


@query("text_files", "SELECT source, doc_id, text || chr(10) AS content, true AS has_title FROM documents")
def text_files_query(spark, folder):
    root = _written_files(table(spark, folder, "documents"), spark)
    files = text_files(spark, root, recursive=True)
    has_title = F.endswith("source", F.concat("title", F.lit(".txt")))
    return files.select(*_from_path("source"), "content", has_title.alias("has_title"))


@query("file_listing", "SELECT source, doc_id, strlen(text) + 1 AS length FROM documents")
def file_listing(spark, folder):
    root = _written_files(table(spark, folder, "documents"), spark)
    return list_files(spark, root, TXT_GLOB).select(*_from_path("path"), "length")


@query(
    "decoded_pages",
    f"SELECT source, doc_id, page_no, content FROM ("
    "SELECT source, doc_id, unnest(range(len(string_split(text, chr(10))))) AS page_no,"
    " unnest(string_split(text, chr(10))) AS content FROM documents) WHERE trim(content) <> ''",
)
def decoded_pages(spark, folder):
    """Files to pages: here every line of a text file is one page."""
    root = _written_files(table(spark, folder, "documents"), spark)
    decoded = page_rows(decode_pages(read_files(spark, [root], TXT_GLOB), utf8_pages("\n")))
    return decoded.select(*_from_path("source"), "page_no", "content")


_ALL_CHUNKS = f"""WITH RECURSIVE {chunks(PAGES)}
    SELECT DISTINCT content_hash, content AS document FROM chunks"""


@query("directory_ingest", _ALL_CHUNKS)
def directory_ingest(spark, folder):
    store = _store(spark)
    root = _written_files(table(spark, folder, "documents"), spark)
    ingest_directory(spark, root, utf8_pages(), store, COLLECTION, MODEL, glob=TXT_GLOB)
    return store.rows(COLLECTION).select("content_hash", "document")


def _two_deliveries(spark, folder):
    """The labelled documents, then the others, as they come into a folder."""
    documents = table(spark, folder, "documents")
    ids = labelled_ids(spark, folder)
    return documents.join(ids, "doc_id", "left_semi"), documents.join(ids, "doc_id", "left_anti")


def _ingest_by_ledger(spark, folder, files_per_batch):
    """Files in batches against a path ledger; the second run takes the new files only."""
    store = _store(spark)
    ledger = Ledger(spark, scratch_dir(spark, "ledger"))
    root = scratch_dir(spark, "files")
    for delivery in _two_deliveries(spark, folder):
        _write_files(delivery, root)
        ingest_files_in_batches(
            spark, root, utf8_pages(), ledger, store, COLLECTION, MODEL, files_per_batch, glob=TXT_GLOB
        )
    return store.rows(COLLECTION).select("content_hash", "document")


@query("ingest_batches", _ALL_CHUNKS)
def ingest_batches(spark, folder):
    return _ingest_by_ledger(spark, folder, 400)


@query("ingest_files_singly", _ALL_CHUNKS)
def ingest_files_singly(spark, folder):
    return _ingest_by_ledger(spark, folder, 1)


@query("ingest_stream", _ALL_CHUNKS)
def ingest_stream(spark, folder):
    """Page files in two deliveries; the second run resumes from the checkpoint."""
    store = _store(spark)
    root, checkpoint = scratch_dir(spark, "pages"), scratch_dir(spark, "offsets")
    for delivery in _two_deliveries(spark, folder):
        files = delivery.select(
            F.col("source").alias("title"), F.col("doc_id").alias("page_no"), F.col("text").alias("content")
        )
        files.write.mode("append").parquet(root)
        stream = page_stream(spark, root, files_per_trigger=4)
        ingest_page_stream(stream, store, COLLECTION, MODEL, checkpoint).awaitTermination()
    return store.rows(COLLECTION).select("content_hash", "document")


@query("ingest_two_streams", _ALL_CHUNKS)
def ingest_two_streams(spark, folder):
    """Two deliveries in folders of their own, each by a stream with its own checkpoint."""
    store = _store(spark)
    for delivery in _two_deliveries(spark, folder):
        root, checkpoint = scratch_dir(spark, "pages"), scratch_dir(spark, "offsets")
        delivery.select(
            F.col("source").alias("title"), F.col("doc_id").alias("page_no"), F.col("text").alias("content")
        ).write.parquet(root)
        stream = page_stream(spark, root, files_per_trigger=100)
        ingest_page_stream(stream, store, COLLECTION, MODEL, checkpoint).awaitTermination()
    return store.rows(COLLECTION).select("content_hash", "document")


@query(
    "odd_file_names",
    """SELECT doc_id, 'a[1] {x} *? ' || doc_id || '.txt' AS file_name,
              CASE WHEN doc_id % 3 = 0 THEN '' ELSE coalesce(text, '') END AS content
       FROM documents""",
)
def odd_file_names(spark, folder):
    """Files with pattern characters in their names, every third one empty."""
    root = scratch_dir(spark, "files")
    path = F.concat(F.lit(f"{root}/a[1] {{x}} *? "), "doc_id", F.lit(".txt"))
    content = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.coalesce("text", F.lit("")))
    write_files(table(spark, folder, "documents").select(path.alias("path"), content.alias("content")))
    files = read_files(spark, [root], TXT_GLOB)
    name = F.substring_index("path", "/", -1)
    doc_id = F.regexp_extract(name, r"(\d+)\.txt$", 1).cast("long")
    return files.select(doc_id.alias("doc_id"), name.alias("file_name"), F.col("content").cast("string").alias("content"))


@query(
    "file_stream_report",
    """SELECT source, doc_id, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE strlen(text) + 1 END AS length,
              1::BIGINT AS n_pages, (doc_id % 3 = 0)::BIGINT AS n_blank
       FROM documents""",
)
def file_stream_report(spark, folder):
    """A stream of files, every third one without bytes: what it reports of each."""
    store, report = _store(spark), scratch_dir(spark, "report")
    documents = table(spark, folder, "documents")
    root = _written_files(documents.filter("doc_id % 3 <> 0"), spark)
    empty = F.concat(F.lit(f"{root}/source="), "source", F.lit("/doc_id="), "doc_id", F.lit("/text.txt"))
    write_files(documents.filter("doc_id % 3 = 0").select(empty.alias("path"), F.lit("").alias("content")))
    stream = file_stream(spark, root, files_per_trigger=2000, glob=TXT_GLOB)
    ingest_file_stream(
        stream, utf8_pages(), store, COLLECTION, MODEL, scratch_dir(spark, "offsets"), report=report
    ).awaitTermination()
    found = spark.read.parquet(report)
    return found.select(*_from_path("source"), "length", "n_pages", "n_blank")


@query("ingest_stream_state", _ALL_CHUNKS)
def ingest_stream_state(spark, folder):
    """The same by the stream's own state of known hashes; the second run resumes it."""
    store = _store(spark)
    root, checkpoint = scratch_dir(spark, "pages"), scratch_dir(spark, "offsets")
    for delivery in _two_deliveries(spark, folder):
        files = delivery.select(
            F.col("source").alias("title"), F.col("doc_id").alias("page_no"), F.col("text").alias("content")
        )
        files.write.mode("append").parquet(root)
        stream = page_stream(spark, root, files_per_trigger=100)
        ingest_pages_by_state(stream, store, COLLECTION, MODEL, checkpoint).awaitTermination()
    return store.rows(COLLECTION).select("content_hash", "document")


@query("ingest_file_stream", _ALL_CHUNKS)
def ingest_file_stream_query(spark, folder):
    store = _store(spark)
    root = _written_files(table(spark, folder, "documents"), spark)
    stream = file_stream(spark, root, files_per_trigger=500, glob=TXT_GLOB)
    checkpoint = scratch_dir(spark, "offsets")
    ingest_file_stream(
        stream, utf8_pages(), store, COLLECTION, MODEL, checkpoint
    ).awaitTermination()
    return store.rows(COLLECTION).select("content_hash", "document")


_ITEMS = "SELECT 'item-' || item_id AS title, 0 AS page_no, text AS content FROM benchmark"


@query(
    "answer_prompts",
    f"""WITH RECURSIVE {chunks(_ITEMS)}, stored AS (
            SELECT * FROM chunks
            QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY title, page_no, chunk_idx) = 1
        ), asked AS (
            SELECT conv_id || '-' || turn AS query_id, text AS question FROM conversations WHERE role = 'user'
        ), bucket AS (
            SELECT id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS dim, count(*) AS n
            FROM (SELECT 's' || content_hash AS id, unnest(string_split(content, ' ')) AS w FROM stored UNION ALL
                  SELECT 'q' || query_id, unnest(string_split(question, ' ')) FROM asked)
            WHERE w <> '' GROUP BY ALL
        ), vector AS (
            SELECT id, list(coalesce(n, 0) / norm ORDER BY dim)::FLOAT[] AS v
            FROM (SELECT id, sqrt(sum(n * n)) AS norm FROM bucket GROUP BY id)
            CROSS JOIN (SELECT unnest(range(64)) AS dim) LEFT JOIN bucket USING (id, dim)
            GROUP BY id
        ), ranked AS (
            SELECT query_id, title, content,
                   row_number() OVER (PARTITION BY query_id
                                      ORDER BY d NULLS LAST, sha256('papers' || chr(1) || content_hash)) AS rank
            FROM (SELECT a.query_id, s.title, s.content, s.content_hash, {distance_sql("vs.v", "vq.v")} AS d
                  FROM asked a JOIN vector vq ON vq.id = 'q' || a.query_id
                  CROSS JOIN stored s JOIN vector vs ON vs.id = 's' || s.content_hash)
        ), context AS (
            SELECT query_id, string_agg('From ' || title || ':' || chr(10) || content, chr(10) || chr(10) ORDER BY rank) AS context,
                   count(*) AS n_hits, string_agg(title, '|' ORDER BY rank) AS cited
            FROM ranked WHERE rank <= 3 GROUP BY query_id
        )
        SELECT query_id, question, {prompt_sql("coalesce(context, '')", "question")} AS prompt, n_hits, cited
        FROM asked LEFT JOIN context USING (query_id)""",
)
def answer_prompts_query(spark, folder):
    """Ingest, embed, search and assemble: the benchmark items answer every user turn."""
    store = _store(spark)
    items = table(spark, folder, "benchmark").select(
        F.concat(F.lit("item-"), "item_id").alias("title"), F.col("text").alias("content")
    )
    insert_publications(items, store, COLLECTION, MODEL)
    user = table(spark, folder, "conversations").filter(F.col("role") == "user")
    questions = user.select(
        F.concat_ws("-", "conv_id", "turn").alias("query_id"), F.col("text").alias("question")
    )
    cited = F.array_join(F.transform("hits", lambda hit: hit["title"]), "|").alias("cited")
    return answer_prompts(store, COLLECTION, questions, MODEL).select(
        "query_id", "question", "prompt", F.size("hits").cast("long").alias("n_hits"), cited
    )
