import hashlib

import numpy as np

from quireworks.llm import centroids

KIND = "vec_id long, embedding array<float>, label int, cluster int, v double, distance string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 0.5, "x") for i, v in rows], KIND)


def plain(rows, count, rounds, width, scale):
    """Each vector against each centroid, in whole numbers."""
    kept = [
        (i, [int(np.floor(float(np.float32(x)) * scale)) for x in v]) for i, v in rows
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)
    ]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    middle = [v for _, v in named[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for k in range(len(middle)):
            own = [v for (_, v), a in zip(kept, at) if a == k]
            if own:
                middle[k] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i is None, i or 0, *nearest(v)) for i, v in kept)), middle


def run(spark, rows, count=5, rounds=3, width=4, scale=8):
    found, middle, inertia = centroids.cluster_vectors(frame(spark, rows), count, rounds, width, scale)
    got = sorted((r.vec_id is None, r.vec_id or 0, r.distance, r.cluster) for r in found.collect())
    return got, middle.tolist(), inertia


def test_orchard_equals_all_distances():
    rng = np.random.default_rng(3)
    for k in (1, 2, 7, 40):
        middle = rng.integers(-4, 5, (k, 3))
        middle[k // 2] = middle[0]
        vectors = rng.integers(-5, 6, (2000, 3))
        every = ((vectors[:, None] - middle[None]) ** 2).sum(2)
        orchard = centroids.Orchard.of(middle)
        for start in (None, rng.integers(0, k, 2000)):
            at, distance = orchard.assign(vectors, start)
            assert (at == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_orchard_measures_few_centroids_where_vectors_lie_close():
    rng = np.random.default_rng(4)
    middle = rng.integers(-10_000, 10_000, (50, 8))
    near = np.repeat(np.arange(50), 20)
    vectors = middle[near] + rng.integers(-20, 21, (1000, 8))
    measured = 0

    class Counted(np.ndarray):
        def __getitem__(self, key):
            nonlocal measured
            measured += len(key) if isinstance(key, np.ndarray) and key.ndim == 1 else 0
            return np.asarray(super().__getitem__(key))

    orchard = centroids.Orchard.of(middle)
    counted = centroids.Orchard(middle.view(Counted), orchard.between, orchard.others)
    at, _ = counted.assign(vectors, near)
    assert (at == near).all() and measured == 1000  # the start only: every list ends at its first entry


def test_rounds_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).round(1).tolist()) for i in range(300)]
    rows += [(7, rows[7][1]), (8, [9.0, 9.0, 9.0, 9.0]), (None, [0.5, 0.5, 0.5, 0.5]), (400, None), (401, []),
             (402, [1.0] * 5), (403, [1.0, None, 0.0, 0.0]), (404, [float("nan")] * 4), (405, [float("-inf")] * 4),
             (406, [0.0] * 4)]
    got, middle, inertia = run(spark, rows)
    wanted, wanted_middle = plain(rows, 5, 3, 4, 8)
    assert got == wanted and middle == wanted_middle
    assert sum(inertia.values()) == sum(r[2] for r in wanted)


def test_few_equal_or_no_vectors(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0]), (2, [1.0, 2.0, 3.0, 4.0]), (3, [-1.0, 0.0, 0.0, 0.0])]
    got, middle, _ = run(spark, rows)
    wanted, wanted_middle = plain(rows, 5, 3, 4, 8)
    assert got == wanted and middle == wanted_middle
    assert run(spark, [])[0] == [] and run(spark, [(None, [1.0] * 4), (1, None)])[0] == []


def test_long_vectors_are_exact_and_longer_ones_take_no_part(spark):
    rows = [(i, [float(i) * 1e6, -1e6, 3.0, 0.0]) for i in range(8)] + [(9, [3e38, 0.0, 0.0, 0.0])]
    got, middle, _ = run(spark, rows, 2)
    wanted, wanted_middle = plain(rows[:8], 2, 3, 4, 8)
    assert got == wanted and middle == wanted_middle
