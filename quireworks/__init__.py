"""Text ingestion and vector retrieval as PySpark jobs."""

import sys

from pyspark import cloudpickle

# Functions used inside tasks travel with the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from quireworks.operators.embedding import hashed_words, sentence_transformer  # noqa: E402
from quireworks.plans.answer import answer_prompts, search_batch, search_collection  # noqa: E402
from quireworks.plans.ingest import (  # noqa: E402
    IngestResult,
    ingest_directory,
    ingest_files_in_batches,
    ingest_new_titles,
    insert_publications,
    store_documents,
)
from quireworks.session import build_session  # noqa: E402
from quireworks.sources.files import pdf_pages, text_files, utf8_pages  # noqa: E402
from quireworks.sources.store import CollectionStore, Ledger  # noqa: E402

__all__ = [
    "CollectionStore",
    "IngestResult",
    "Ledger",
    "answer_prompts",
    "build_session",
    "hashed_words",
    "ingest_directory",
    "ingest_files_in_batches",
    "ingest_new_titles",
    "insert_publications",
    "pdf_pages",
    "search_batch",
    "search_collection",
    "sentence_transformer",
    "store_documents",
    "text_files",
    "utf8_pages",
]
