"""Search in a collection and the prompts made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireworks.operators.embedding import Model, embed_documents
from quireworks.operators.prompts import ANSWER_K, assemble_prompts
from quireworks.operators.search import TOP_K, search_hits, topk, topk_batch
from quireworks.session import ensure_checkpoint_dir
from quireworks.sources.store import CollectionStore

# The partition columns travel with a hit: its text is then looked up in its own batch.
_LOCATION = ("collection_id", "batch_id")


def _with_texts(rows: DataFrame, hits: DataFrame, n_hits: int) -> DataFrame:
    """Fetch the texts of hits.

    The hits are checkpointed and the second scan gets their batch ids as a partition
    filter, so it opens only those batches, however many hits there are. The driver lists
    the collection's batches for any scan of it, so their names have room there. (Left to
    dynamic pruning, the filter is dropped when the planner does not find the same broadcast
    again.)
    """
    ensure_checkpoint_dir(hits.sparkSession)
    hits = hits.checkpoint()
    named = [r.batch_id for r in hits.select("batch_id").distinct().collect()]
    rows = rows.filter(F.col("batch_id").isin(named) if named else F.lit(False))
    return search_hits(hits, rows, [*_LOCATION, "uuid"], n_hits)


def search_collection(
    store: CollectionStore, collection: str, query: str, model: Model, k: int = TOP_K
) -> DataFrame:
    """The k stored chunks nearest to one query text: rank, title, content, distance."""
    rows = store.rows(collection)
    hits = topk(rows, model()([query])[0], k, id_col="uuid", keep=_LOCATION)
    return _with_texts(rows, hits, k)


def search_batch(
    store: CollectionStore, collection: str, questions: DataFrame, model: Model, k: int = TOP_K
) -> DataFrame:
    """The same for a table of questions (query_id, question)."""
    rows = store.rows(collection)
    vectors = embed_documents(questions, model, text="question").select("query_id", "embedding")
    hits = topk_batch(rows, vectors, k, id_col="uuid", keep=_LOCATION)
    return _with_texts(rows, hits, k * questions.count())


def answer_prompts(
    store: CollectionStore, collection: str, questions: DataFrame, model: Model, k: int = ANSWER_K
) -> DataFrame:
    """One prompt per question, ready for a language model, and what it cites: query_id,
    question, prompt, hits (an array of rank, title, content, distance)."""
    hits = search_batch(store, collection, questions, model, k)
    return assemble_prompts(hits, questions, k)
