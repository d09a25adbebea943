import numpy as np
import pytest
from pyspark.sql import functions as F

from quireworks.llm import negatives


def frame(spark, rows):
    kind = "vec_id long, embedding array<float>, label int, block int, score double, kind string"
    return spark.createDataFrame([(i, v, label, 3, 0.5, "x") for i, v, label in rows], kind)


def plain(rows, every=10, scale=4, positives=2, count=3, least=50, most=95):
    """All products in whole numbers, then plain sorting."""
    kept = sorted({
        (i, label, tuple(int(np.floor(float(np.float32(x)) * scale)) for x in v)) for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)
    })
    out = []
    for i, label, v in kept:
        if i % every:
            continue
        near = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in kept if len(w) == len(v))
        for s, j, _ in [x for x in near if x[2] == label and x[1] != i][:positives]:
            found = [(t, k) for t, k, other in near if other != label and least * -s <= 100 * -t <= most * -s]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(found[:count], 1)]
    return sorted(out)


def run(spark, rows, block_rows=64, chunk_rows=3, every=10):
    found = negatives.hard_negatives(
        frame(spark, rows), F.col("vec_id") % every == 0, F.col("label"), 4, 2, 3, block_rows=block_rows, chunk_rows=chunk_rows
    )
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(row[n] for n in names) for row in found.collect())


@pytest.mark.parametrize("width", [1, 8, 13])
@pytest.mark.parametrize("size", [1, 300, 1 << 40])
def test_products_are_exact(width, size):
    rng = np.random.default_rng(width)
    anchors, rows = (rng.integers(-size, size + 1, (n, width)) for n in (5, 1500))
    rows[0], rows[1] = -size, 0
    found = negatives.scores(negatives.subset_tables(anchors), negatives.bit_planes(rows))
    wanted = rows.astype(object) @ anchors.T.astype(object)
    assert ((wanted - found) % 2**64 == 0).all()


def test_subsets():
    tables = negatives.subset_tables(np.array([[1, 2, 4, 8, 16, 32, 64, 128, 7]]))
    assert (tables[0, :, 0] == np.arange(256)).all() and tables[1, 1, 0] == 7 and tables[1, 2, 0] == 0


def test_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=5).round(1).tolist(), int(rng.integers(3))) for i in range(400)]
    rows += rows[20:25] + rows[20:21] * 50  # repeated rows count once
    rows += [(20, rows[21][1], 0), (20, rows[22][1], 1), (30, rows[30][1], 2), (31, rows[30][1], rows[30][2])]
    rows += [(500, None, 1), (510, [], 1), (511, [], 1), (512, [], 2), (520, [1.0, None, 0.0, 0.0, 0.0], 1),
             (530, [float("nan")] * 5, 1), (540, [1.0] * 5, None), (None, [1.0] * 5, 1),
             (550, [1.0, 2.0], 1), (551, [1.0, 2.0], 1), (552, [0.5, 1.0], 2), (560, [0.0] * 5, 1)]
    wanted = plain(rows)
    assert len(wanted) > 200
    assert run(spark, rows) == wanted
    assert run(spark, rows, 10_000, 256) == wanted


def test_long_vectors(spark):
    rows = [(i, [float(i + 1) * 1e5, float(i % 5) * -1e5, 1.0], i % 2) for i in range(40)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, [*rows, (50, [3e38, 0.0, 0.0], 0)]) == plain(rows)


def test_one_label_or_no_rows(spark):
    assert run(spark, [(i, [1.0, 2.0], 1) for i in range(30)]) == []
    assert run(spark, []) == []
