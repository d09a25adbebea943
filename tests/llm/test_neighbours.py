import math
import random

import numpy as np
from pyspark.sql import functions as F

from quireworks.llm import neighbours


def exact(rows, k=5):
    good = [
        (i, np.array(v, float)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 4
    ]
    out = []
    for q, x in good:
        if q % 50 == 0:
            near = sorted(
                ((-(x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y)), i) for i, y in good if i != q)
            )
            out += [(q, r, i, -s) for r, (s, i) in enumerate(near[:k], 1)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0.5, 1) for i, v in rows], "vec_id long, embedding array<float>, score double, part int")


def test_few_rows_are_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, 0.5, 1.0, 2.0]) for _ in range(4)]) for i in range(120)]
    rows += [(150, None), (200, [0.0] * 4), (250, [1.0, None, 0.0, 0.0]), (300, [float("nan"), 1.0, 1.0, 1.0]),
             (350, [float("inf"), 1.0, 1.0, 1.0]), (400, []), (450, [1.0, 2.0]), (None, [1.0] * 4)]
    found = neighbours.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0).collect()
    wanted = exact(rows)
    scores = {(r.query_id, r["rank"]): r.score for r in found}
    assert len(found) == len(wanted)
    for q, rank, _, score in wanted:
        assert math.isclose(scores[q, rank], score, abs_tol=1e-12)
    for q in {r.query_id for r in found}:
        own = sorted((r["rank"], -r.score, r.vec_id) for r in found if r.query_id == q)
        assert [x[1:] for x in own] == sorted(x[1:] for x in own)


def test_ties_go_to_smaller_ids_among_many_equal_rows(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(3000)] + [(i, [float(i % 7 + 1), 1.0, -1.0, 0.0]) for i in range(3000, 4500)]
    found = neighbours.nearest_neighbours(frame(spark, rows), F.col("vec_id") == 50).collect()
    assert [(r["rank"], r.vec_id) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0])]
    found = neighbours.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in found] == [(0, 1, 1, 0.0)]
    assert neighbours.nearest_neighbours(frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []


def test_partitions_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 16)) * 4
    unit = neighbours.unit_rows(np.concatenate([c + rng.normal(size=(100, 16)) for c in centres]))
    graph = neighbours.neighbour_graph(unit)
    label = neighbours.balanced_partition(unit, graph, 8)
    assert np.bincount(label, minlength=8).max() <= 111
    assert (label[graph] != label[:, None]).mean() < 0.25


def test_recall(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    vectors = np.stack(table.embedding.values).astype(float)
    ids = table.vec_id.to_numpy()
    wanted = {(q, i) for q, i, _ in neighbours.exact_neighbours(vectors, ids, np.flatnonzero(ids % 50 == 0))}
    found = {(r.query_id, r.vec_id) for r in neighbours.op8_neighbours(spark, folder).collect()}
    assert len(found) == len(wanted) and len(found & wanted) / len(wanted) >= 0.9


def test_repeated_rows_ids_and_widths(spark):
    """A repeated query, repeated candidates, several vectors under one id, vectors of two widths."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(1, 60)]
    wide = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(100, 130)]
    many = [*rows, rows[49], rows[49], *[rows[10]] * 5, (11, [0.1, 0.2, 0.3, 0.4]), (50, rows[30][1]), *wide]
    found = neighbours.nearest_neighbours(frame(spark, many), F.col("vec_id") % 50 == 0).collect()

    def wanted(query, own):
        asked = [np.float32(v).astype(float) for i, v in own if i == query]
        best = {}
        for i, v in own:
            y = np.float32(v).astype(float)
            for x in asked:
                if i != query:
                    best[i] = max(best.get(i, -2), x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)))
        return sorted((-s, i) for i, s in best.items())[:5]

    for query, own in ((50, [r for r in many if len(r[1]) == 4]), (100, wide)):
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == query)
        assert [x[:2] for x in got] == [(n, i) for n, (_, i) in enumerate(wanted(query, own), 1)]
        assert all(math.isclose(g[2], -w[0], abs_tol=1e-12) for g, w in zip(got, wanted(query, own)))
    assert {r.query_id for r in found} == {50, 100}


def test_partitions_that_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PER_SMALL", 150)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 8)) * 3
    rows = [(i, (centres[i % 30] + rng.normal(size=8)).tolist()) for i in range(3000)]
    kind = "vec_id long, embedding array<float>"
    found = neighbours.nearest_neighbours(spark.createDataFrame(rows, kind), F.col("vec_id") % 50 == 0).collect()
    vectors, ids = np.array([np.float32(v) for _, v in rows]).astype(float), np.arange(3000)
    exact_ = {(q, i) for q, i, _ in neighbours.exact_neighbours(vectors, ids, np.flatnonzero(ids % 50 == 0))}
    got = {(r.query_id, r.vec_id) for r in found}
    assert len(got) == len(exact_) and len(got & exact_) / len(exact_) >= 0.9


def test_no_vector_is_copied(spark):
    """What is shuffled holds every vector once, whatever the number of queries."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    for every in (50, 1):
        met = neighbours.nearest_neighbours(df, F.col("vec_id") % every == 0)
        plan = met._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate explode") == 2  # of the queries, over parts and blocks
