"""Operator 10: a toxicity classifier regularised by counterfactuals.

Logistic regression over the presence of words and word beginnings. In every training
text identity terms are exchanged for other identity terms (a text without any gets one
added), and the squared change of the score is penalised, so that the mention of a group
does not count as toxic. The features are those of the training sample that tell the
classes apart best; they are counted on the executors, and only a bounded table of
features and a bounded sample of their presence reach the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quireworks.llm.common import as_bytes, cut, spread_table, table
from quireworks.llm.words import WordCache

TRAIN_ROWS = 20_000  # labelled documents that the model is fitted on, at most
FEATURES = 600  # features of a model, at most
PREFIXES = (4, 5, 6)
RIDGE = 0.05
SWAP_PENALTY = 1.0
THRESHOLD = 0.3
_SLICE = 2 << 20
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")

# Group mentions, by language, exchanged for one another within a line.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrants", "refugees", "foreigners", "natives", "locals"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("blind", "deaf", "disabled", "autistic", "old", "young"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus"),
    ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes"),
    ("immigrés", "réfugiés", "étrangers"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "budistas"),
    ("inmigrantes", "refugiados", "extranjeros"),
)
_NEXT = {term: line[(i + 1) % len(line)] for line in IDENTITY_TERMS for i, term in enumerate(line)}
_ADDED = [line[0] for line in IDENTITY_TERMS]


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    weights: np.ndarray
    bias: float


def normal(word: bytes) -> str:
    return _EDGES.sub("", word.decode("utf-8", "replace").lower())


def features(word: str) -> list[str]:
    """The word itself and its beginnings, marked by their length."""
    return [f"={word}", *(f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n)] if word else []


def _word_features(words: list[bytes]) -> Iterator[tuple[str, ...]]:
    return (tuple(features(normal(word))) for word in words)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_sample(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(toxic, text) of at most ``most`` labelled documents that are not held out.

    Those with the smallest hashes of their ids; labels of a repeated id count as toxic
    if one of them does. Documents that repeat an id are all taken.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    # The broadcast is bounded by ``most`` rows of two numbers.
    return docs.select("doc_id", as_bytes("text").alias("text")).join(F.broadcast(known), "doc_id")


def select_features(sample: DataFrame, most: int = FEATURES) -> list[str]:
    """The features whose presence differs most between the classes (chi-squared)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(_word_features, 100_000)
        for batch in batches:
            for part in cut(batch, 0, _SLICE):
                toxic, clean = Counter(), Counter()
                for text, label in zip(*(c.to_pylist() for c in part.columns)):
                    words = set(text.split())
                    known = cache.ready(words)
                    found = {name for word in words for name in known[word]}
                    (toxic if label else clean).update(found)
                names = list(toxic.keys() | clean.keys())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.string()),
                        pa.array([toxic[x] for x in names], pa.int64()),
                        pa.array([clean[x] for x in names], pa.int64()),
                    ],
                    names=["name", "toxic", "clean"],
                )

    counted = sample.select("text", "toxic").mapInArrow(count, "name string, toxic long, clean long")
    totals = sample.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    t, c = float(totals["t"] or 0), float(totals["n"] - (totals["t"] or 0))
    if not t or not c:
        return []
    with_, without = F.col("toxic") + F.col("clean"), F.lit(t + c) - F.col("toxic") - F.col("clean")
    cross = F.col("toxic") * F.lit(c) - F.col("clean") * F.lit(t)
    chi = cross * cross * F.lit(t + c) / (F.lit(t * c) * with_ * F.greatest(without, F.lit(1.0)))
    best = (
        counted.groupBy("name")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(with_ >= 2)
        .select("name", chi.alias("chi"))
        .filter("chi > 3.84")
        .orderBy(F.desc("chi"), "name")
        .limit(most)
    )
    return [row["name"] for row in best.collect()]


def presence(sample: DataFrame, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the sampled texts and of their counterfactuals, and the labels."""
    index = {name: i for i, name in enumerate(names)}

    def found(words: set[str]) -> list[int]:
        return sorted({index[name] for word in words for name in features(word) if name in index})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in cut(whole, 0, _SLICE)):
            rows = []
            for text, label in zip(*(c.to_pylist() for c in batch.columns)):
                words = set(map(normal, set(text.split())))
                mentioned = words & _NEXT.keys()
                other = (words - mentioned) | {_NEXT[x] for x in mentioned}
                if not mentioned:
                    other.add(_ADDED[len(text) % len(_ADDED)])
                rows.append((found(words), found(other), int(label)))
            columns = list(zip(*rows))
            kinds = [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["here", "there", "toxic"]
            )

    rows = (
        sample.select("text", "toxic")
        .mapInArrow(run, "here array<int>, there array<int>, toxic int")
        .groupBy("here", "there", "toxic")
        .count()
        .collect()
    )
    rows.sort(key=lambda r: (r["here"], r["there"], r["toxic"]))
    x, other = np.zeros((2, len(rows), len(names)))
    for i, row in enumerate(rows):
        x[i, row["here"]] = 1
        other[i, row["there"]] = 1
    return x, other, np.array([[r["toxic"] for r in rows], [r["count"] for r in rows]], float)


def fit(
    x: np.ndarray, other: np.ndarray, y: np.ndarray, counts: np.ndarray,
    ridge: float = RIDGE, penalty: float = SWAP_PENALTY,
) -> tuple[np.ndarray, float]:
    """Newton's method for logistic loss + penalty * (score change by swap)^2 + ridge."""
    ones = np.ones((len(x), 1))
    x, change = np.hstack([x, ones]), np.hstack([x - other, 0 * ones])
    fixed = penalty * (change * counts[:, None]).T @ change + ridge * np.eye(x.shape[1])
    w = np.zeros(x.shape[1])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(counts @ (np.logaddexp(0, z) - y * z) + v @ fixed @ v / 2)

    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (counts * (p - y)) + fixed @ w
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + fixed
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-4:
            size /= 2
        w -= size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train(
    docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most: int = FEATURES
) -> Model:
    """Fit on a bounded sample of labelled documents; without both classes, a constant score."""
    sample = training_sample(docs, labels, rows).checkpoint()
    names = select_features(sample, most)
    names += sorted({name for term in _NEXT for name in features(term)} - set(names))
    x, other, (y, counts) = presence(sample, names)
    if not len(x) or y.min() == y.max():
        share = (y @ counts + 1) / (counts.sum() + 2) if len(x) else 0.0
        return Model((), np.zeros(0), float(np.log(max(share, 1e-6) / (1 - share))))
    weights, bias = fit(x, other, y, counts)
    return Model(tuple(names), weights, bias)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``score`` (0 to 1) to documents by their whole ``text``; other columns stay.

    Null and empty texts have no features and get the score of the bias. A column of the
    name ``score`` is replaced.
    """
    kept = docs.drop("score")
    at, names_out = kept.columns.index("text"), [*kept.columns, "score"]
    weights = {name: float(w) for name, w in zip(model.names, model.weights) if abs(w) > 1e-9}
    bias = model.bias

    def wanted(words: list[bytes]) -> Iterator[tuple[str, ...] | None]:
        for word in words:
            yield tuple(x for x in features(normal(word)) if x in weights) or None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(wanted, 100_000)
        for batch in batches:
            for part in cut(batch, at, _SLICE):
                scores = []
                for text in part.column(at).cast(pa.binary()):
                    words = set((text.as_py() or b"").split())
                    known = cache.ready(words)
                    names = set().union(*filter(None, map(known.__getitem__, words)))
                    z = bias + sum(weights[x] for x in sorted(names))
                    scores.append(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=names_out)

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField("score", DoubleType())]))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of all documents."""
    model = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    docs = spread_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
