"""Operator 13: k-means whose vectors find their centroid by Orchard's search.

Every centroid has a list of the others, nearest first. A vector starts at some centroid
and goes through its list; when a centroid is closer, it goes on with that one's list, and
centroids it has met are not measured again. It stops at the first entry strictly farther
from its centroid than twice its own distance: by the triangle inequality neither that
one nor any later one is closer or as close. Squared distances are whole numbers, so that
ties are exact.

A round is one job: each task assigns its vectors and sums them up for each centroid,
and the sums (centroids x components) are added by an aggregation. Nothing is written
between the rounds, and only the centroids reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireworks.llm.common import map_batches, table
from quireworks.llm.whole_vectors import finite, floored, matrix, short_enough

WIDTH = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1


@dataclass(frozen=True)
class Orchard:
    """Centroids with, for each, the others in order of their squared distance."""

    centroids: np.ndarray
    between: np.ndarray
    others: np.ndarray

    @staticmethod
    def of(centroids: np.ndarray) -> Orchard:
        between = np.stack([((centroids - c) ** 2).sum(1) for c in centroids])
        ranked = between.copy()
        np.fill_diagonal(ranked, -1)
        return Orchard(centroids, between, np.argsort(ranked, axis=1, kind="stable")[:, 1:])

    def assign(self, vectors: np.ndarray, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each vector, ties to the smaller number, and the squared distance.

        All vectors take a step of their own search at a time.
        """
        n, k = len(vectors), len(self.centroids)
        at = np.zeros(n, np.int64) if start is None else start.astype(np.int64)
        distance = ((vectors - self.centroids[at]) ** 2).sum(1)
        place = np.zeros(n, np.int64)
        met = np.zeros((n, k), bool)
        met[np.arange(n), at] = True
        going = np.arange(n) if k > 1 else np.arange(0)
        while len(going):
            here = at[going]
            other = self.others[here, place[going]]
            # between > 4 * distance, without the product, which may not fit in 64 bits
            near = (self.between[here, other] - 1) // 4 < distance[going]
            going, other = going[near], other[near]
            fresh = ~met[going, other]
            place[going] += 1
            rows, tried = going[fresh], other[fresh]
            met[rows, tried] = True
            found = ((vectors[rows] - self.centroids[tried]) ** 2).sum(1)
            closer = (found < distance[rows]) | ((found == distance[rows]) & (tried < at[rows]))
            rows = rows[closer]
            at[rows], distance[rows], place[rows] = tried[closer], found[closer], 0
            going = going[place[going] < k - 1]
        return at, distance


def kept_vectors(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of the vectors of the width, their components floored to whole numbers."""
    good = finite(F.col("embedding")) & (F.size("embedding") == width) & short_enough(F.col("embedding"), scale)
    return vectors.filter(good).select("vec_id", floored(F.col("embedding"), scale).alias("v"))


def first_centroids(kept: DataFrame, count: int, seed: int = SEED) -> np.ndarray:
    """Of the vectors with the smallest hashes of seed and id, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.filter("vec_id IS NOT NULL").select(name.alias("h"), "v").orderBy("h", "v").limit(count).collect()
    return np.array([row["v"] for row in rows], np.int64)


def _totals(kept: DataFrame, orchard: Orchard) -> tuple[dict[int, int], dict[int, list[int]], dict[int, int]]:
    """Vectors, component sums and summed distances of each centroid that has any."""
    k, width = orchard.centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, distances = np.zeros((k, width), np.int64), np.zeros(k, np.int64), [0] * k
        for batch in batches:
            vectors = matrix(batch.column(0), width)
            at, distance = orchard.assign(vectors)
            for c in np.unique(at):
                own = at == c
                sums[c] += vectors[own].sum(0)
                counts[c] += own.sum()
                distances[c] += sum(distance[own].tolist())
            held = np.flatnonzero(counts)
            if len(held) and np.abs(sums).max() < 1 << 60 and max(distances) < 1 << 60:
                continue
            yield from flush(sums, counts, distances)
            sums[:], counts[:], distances = 0, 0, [0] * k
        yield from flush(sums, counts, distances)

    def flush(sums: np.ndarray, counts: np.ndarray, distances: list[int]) -> Iterator[pa.RecordBatch]:
        held = np.flatnonzero(counts)
        if len(held):
            parts = [[c, int(counts[c]), sums[c].tolist(), str(distances[c])] for c in held.tolist()]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.string()]
            columns = [pa.array(x, t) for x, t in zip(zip(*parts), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "sums", "distances"])

    parts = kept.select("v").mapInArrow(run, "cluster int, n long, sums array<long>, distances string")
    exact = "decimal(38,0)"
    values = F.concat(
        F.array(F.col("n").cast(exact), F.col("distances").cast(exact)), F.transform("sums", lambda x: x.cast(exact))
    )
    rows = parts.select("cluster", F.posexplode(values).alias("i", "x")).groupBy("cluster", "i").agg(F.sum("x").alias("x")).collect()
    found: dict[int, dict[int, int]] = {}
    for row in rows:
        found.setdefault(row["cluster"], {})[row["i"]] = int(row["x"])
    return (
        {c: x[0] for c, x in found.items()},
        {c: [x[i + 2] for i in range(width)] for c, x in found.items()},
        {c: x[1] for c, x in found.items()},
    )


def cluster_vectors(
    vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, np.ndarray, dict[int, int]]:
    """((vec_id, cluster, distance) of each vector, the centroids, their summed distances).

    ``vectors`` has (vec_id, embedding); other columns are ignored. Vectors of another
    width, null ones and those with null or not finite components take no part; nor do
    those so long (a floored component of some 2**27) that squared distances aren't longs.
    Rows that repeat an id or a vector each count, and each is returned. A row without id
    is assigned and counted, but no first centroid. With fewer than ``count`` vectors each
    is a centroid; equal centroids leave all vectors to the one of the smallest number,
    and a centroid without vectors stays where it is. Without vectors there are no rows.
    """
    kept = kept_vectors(vectors, width, scale)
    centroids = first_centroids(kept, count, seed)
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema), np.zeros((0, width), np.int64), {}
    for _ in range(rounds):
        counts, sums, _ = _totals(kept, Orchard.of(centroids))
        centroids = np.array(
            [[x // counts[c] for x in sums[c]] if c in counts else centroids[c].tolist() for c in range(len(centroids))], np.int64
        )
    orchard = Orchard.of(centroids)
    return map_batches(kept, _assigner(orchard, width), schema), centroids, _totals(kept, orchard)[2]


def _assigner(orchard: Orchard, width: int) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, distance = orchard.assign(matrix(batch.column(1), width))
        columns = [batch.column(0).cast(pa.int64()), pa.array(at, pa.int32()), pa.array(distance, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return run


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of all kept vectors."""
    assigned, centroids, inertia = cluster_vectors(table(spark, sf_dir, "embeddings"))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per = [(c, inertia.get(c, 0), sum(inertia.values()), digest) for c, digest in enumerate(digests)]
    # One row per centroid; sums beyond a long are null.
    per = [(c, *(x if x < 1 << 63 else None for x in sums), digest) for c, *sums, digest in per]
    about = spark.createDataFrame(per, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


_DISTANCE = f"list_sum(list_transform(range(1, {WIDTH + 1}), lambda i: (r.v[i] - c.v[i]) * (r.v[i] - c.v[i])))"


def _round(i: int) -> str:
    """Assignment to the centroids c{i} and the centroids that follow from it."""
    return f"""
a{i} AS (
  SELECT r.n, min({{'d': {_DISTANCE}, 'c': c.c}}) AS best FROM r, c{i} c GROUP BY r.n),
s{i} AS (
  SELECT a.best.c AS c, u.i, sum(r.v[u.i])::HUGEINT AS total, count(*)::HUGEINT AS n
  FROM a{i} a JOIN r USING (n), range(1, {WIDTH + 1}) AS u(i) GROUP BY ALL),
m{i} AS (
  SELECT c, list((total - ((total % n) + n) % n) // n ORDER BY i) AS v FROM s{i} GROUP BY c),
c{i + 1} AS (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (c)),"""


OP13_SQL = f"""
WITH r AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::HUGEINT) AS v
  FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
    SELECT sha256('{SEED}:' || vec_id) AS h, v FROM r WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {CENTROIDS})),
{"".join(map(_round, range(ROUNDS)))}
final AS (
  SELECT r.n, min({{'d': {_DISTANCE}, 'c': c.c}}) AS best FROM r, c{ROUNDS} c GROUP BY r.n),
placed AS (
  SELECT r.vec_id, f.best.c::INTEGER AS cluster, f.best.d::BIGINT AS distance FROM final f JOIN r USING (n))
SELECT p.vec_id, p.cluster, p.distance,
  (sum(p.distance) OVER (PARTITION BY p.cluster))::BIGINT AS cluster_inertia,
  (sum(p.distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM placed p JOIN c{ROUNDS} c ON c.c = p.cluster"""
