"""Embedding a text column with a model that each Python worker loads once."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireworks.session import made_once

# Fixed value: the model the texts are meant for.
MODEL_NAME = "sentence-transformers/all-MiniLM-L6-v2"
HASHED_DIMENSION = 64
MAX_CACHED_WORDS = 1 << 18
MAX_LOADED = 4  # models that a worker keeps

# A model is a function that, called in the worker, loads what it needs and returns a
# function from a list of texts to a (texts, dimension) array.
Model = Callable[[], Callable[[list[str]], np.ndarray]]


def sentence_transformer(name: str = MODEL_NAME, device: str | None = None) -> Model:
    """The real model; needs the sentence-transformers package on the executors."""

    def load():
        from sentence_transformers import SentenceTransformer

        return SentenceTransformer(name, device=device).encode

    return load


def hashed_words(dimension: int = HASHED_DIMENSION) -> Model:
    """A stand-in for tests and for runs without the model: counts of hashed words,
    scaled to length 1. It says which texts share words, not what they mean."""

    def load():
        class Buckets(dict):
            def __missing__(self, word: str) -> int:
                number = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dimension
                if len(self) < MAX_CACHED_WORDS:
                    self[word] = number
                return number

        buckets = Buckets({"": dimension})  # no word: a column that is cut off

        def embed(texts: list[str]) -> np.ndarray:
            """All words of the batch at once: one look-up each, one count over (text, bucket)."""
            split = [text.split(" ") for text in texts]
            row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, split), np.int64, len(texts)))
            number = np.fromiter(map(buckets.__getitem__, chain.from_iterable(split)), np.int64, len(row))
            width = dimension + 1
            counts = np.bincount(row * width + number, minlength=len(texts) * width).reshape(len(texts), width)[:, :dimension]
            norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            return counts / np.where(norms == 0, 1, norms)

        return embed

    return load


def embed_column(text: Column, model: Model, batch_size: int = 256) -> Column:
    """Array of floats per text; rows reach the model in batches of ``batch_size``.

    Marked non-deterministic, which keeps the optimizer from copying the call into a filter
    on its result (also the one it infers for an explode) and running the model twice.
    """

    return _predictor(model, batch_size)(text)


@made_once
def _predictor(model: Model, batch_size: int):
    """One function for all calls with a model: a worker that has loaded it for one micro-batch
    has it for the next. An Arrow UDF, as pyspark.ml takes a worker a second or two to import."""
    key = uuid.uuid4().hex

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        embed = loaded_model(key, model)
        for batch in batches:
            parts = [batch.slice(i, batch_size).to_pylist() for i in range(0, len(batch), batch_size)]
            yield pa.chunked_array(
                [_lists(embed([t or "" for t in part]), len(part)) for part in parts], pa.list_(pa.float32())
            ).combine_chunks()

    return predict.asNondeterministic()


_loaded: dict[str, Callable[[list[str]], np.ndarray]] = {}  # of a worker


def loaded_model(key: str, model: Model) -> Callable[[list[str]], np.ndarray]:
    """The model, loaded once by a worker, which keeps the last few."""
    if key not in _loaded:
        while len(_loaded) >= MAX_LOADED:
            del _loaded[next(iter(_loaded))]
        _loaded[key] = model()
    return _loaded[key]


def _lists(vectors: np.ndarray, n: int) -> pa.Array:
    """Rows of an (n, dimension) array as lists."""
    vectors = np.asarray(vectors, dtype=np.float32)
    if vectors.ndim != 2 or len(vectors) != n:
        raise ValueError(f"a model gave an array of shape {vectors.shape} for {n} texts")
    offsets = np.arange(n + 1, dtype=np.int32) * vectors.shape[1]
    return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(vectors).ravel())


def embed_documents(
    df: DataFrame,
    model: Model,
    text: str = "document",
    vector: str = "embedding",
    batch_size: int = 256,
) -> DataFrame:
    return df.withColumn(vector, embed_column(F.col(text), model, batch_size))
