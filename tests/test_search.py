import math

import pytest
from pyspark.sql import functions as F

from quireworks.functions.vectors import cosine_distance
from quireworks.operators import search
from quireworks.operators.prompts import assemble_context, assemble_prompts
from quireworks.operators.search import topk, topk_batch


def vectors(spark, rows, parts=3):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(parts)


def ask(spark, rows):
    return spark.createDataFrame(rows, "query_id string, embedding array<float>")


def brute_force(rows, queries, k):
    out = []
    for query_id, q in queries:
        scored = []
        for vec_id, v in rows:
            if v is None:
                continue
            norm = math.sqrt(sum(x * x for x in v)) * math.sqrt(sum(x * x for x in q))
            d = None
            if norm:
                d = round(1 - sum(a * b for a, b in zip(v, q)) / norm, 12) + 0.0
            scored.append((d is None, d or 0.0, vec_id, d))
        for rank, (_, _, vec_id, d) in enumerate(sorted(scored)[:k], 1):
            out.append((query_id, rank, vec_id, d))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "distance").collect())


ROWS = [(i, [float((i * 7) % 5 - 2), float((i * 3) % 4 - 1), float(i % 3)]) for i in range(60)]
ROWS += [(100, [0.0, 0.0, 0.0]), (101, None)]
QUERIES = [("a", [1.0, 0.0, 0.0]), ("b", [1.0, 1.0, 2.0]), ("z", [0.0, 0.0, 0.0])]


@pytest.mark.parametrize("k", [1, 5, 61, 100])
def test_equals_brute_force(spark, k):
    """Many ties, a zero vector, a null vector, a zero query, k above the row count."""
    got = result(topk_batch(vectors(spark, ROWS), ask(spark, QUERIES), k))
    assert got == brute_force(ROWS, QUERIES, k)


def test_waves_give_the_same_without_a_shuffle_of_vectors(spark):
    got = topk_batch(vectors(spark, ROWS), ask(spark, QUERIES), 7, max_query_bytes=64)
    assert result(got) == brute_force(ROWS, QUERIES, 7)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("MapInArrow") > 1
    assert all("embedding" not in line for line in text.splitlines() if "Exchange" in line)


@pytest.mark.parametrize("sizes", [(1, 1), (200, 24), (1 << 20, 1 << 20)])
def test_blocks_give_the_same_and_queries_pass_no_driver(spark, monkeypatch, sizes):
    collected = []
    real = type(spark.range(1)).toArrow
    monkeypatch.setattr(type(spark.range(1)), "toArrow", lambda df: collected.append(df) or real(df))
    df = vectors(spark, ROWS).withColumn("tag", F.concat(F.lit("t"), "vec_id"))
    for k in (1, 7, 100):
        got = topk_batch(df, ask(spark, QUERIES), k, keep=["tag"], max_query_bytes=8, max_waves=2,
                         block_bytes=sizes[0], query_block_bytes=sizes[1])
        assert result(got) == brute_force(ROWS, QUERIES, k)
        assert all(r.tag == f"t{r.vec_id}" for r in got.collect())
    assert not collected
    assert topk_batch(vectors(spark, []), ask(spark, QUERIES), 3, max_query_bytes=1, max_waves=0).count() == 0
    assert topk_batch(vectors(spark, ROWS), ask(spark, []), 3, max_waves=0).count() == 0


def test_held_shortlists_are_sent_on(spark, monkeypatch):
    monkeypatch.setattr(search, "_HELD_ROWS", 3)
    got = topk_batch(vectors(spark, ROWS), ask(spark, QUERIES), 7, max_waves=0, block_bytes=100, query_block_bytes=24)
    assert result(got) == brute_force(ROWS, QUERIES, 7)


def test_small_score_steps_and_batches(spark, monkeypatch):
    monkeypatch.setattr(search, "_SCORES_PER_STEP", 10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        got = result(topk_batch(vectors(spark, ROWS, 2), ask(spark, QUERIES), 6))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_force(ROWS, QUERIES, 6)


def test_a_third_of_all_vectors_are_copies(spark):
    rows = [(i, [1.0, 2.0]) for i in range(500)]
    rows += [(i, [math.cos(i), math.sin(i)]) for i in range(500, 1500)]
    queries = [("q", [1.0, 2.0]), ("r", [-1.0, 0.5])]
    got = result(topk_batch(vectors(spark, rows), ask(spark, queries), 4))
    assert [r[2] for r in got if r[0] == "q"] == [0, 1, 2, 3]
    assert [r[2] for r in got] == [r[2] for r in brute_force([(i, [float(F32(x)) for x in v]) for i, v in rows], queries, 4)]


def F32(x):
    import numpy as np

    return np.float32(x)


def test_single_query_equals_column_expression(spark):
    df = vectors(spark, ROWS)
    query = [1.0, 1.0, 2.0]
    got = [(r.vec_id, r.distance) for r in topk(df, query, 9).orderBy("rank").collect()]
    literal = F.array(*[F.lit(x) for x in query])
    distance = F.round(cosine_distance(F.col("embedding"), literal), 12)
    scored = df.filter("embedding is not null").select("vec_id", distance.alias("d"))
    want = scored.orderBy(F.col("d").asc_nulls_last(), "vec_id").limit(9).collect()
    assert [g[0] for g in got] == [w.vec_id for w in want]
    assert all(g[1] == pytest.approx(w.d, abs=1e-11) for g, w in zip(got, want))


def test_other_length_is_an_error(spark):
    with pytest.raises(Exception, match="length"):
        topk(vectors(spark, ROWS), [1.0, 2.0], 3).collect()


def test_no_vectors_and_no_queries(spark):
    assert topk_batch(vectors(spark, []), ask(spark, QUERIES), 3).count() == 0
    assert topk_batch(vectors(spark, ROWS), ask(spark, []), 3).count() == 0


def test_kept_columns(spark):
    df = vectors(spark, ROWS).withColumn("tag", F.concat(F.lit("t"), "vec_id"))
    rows = topk_batch(df, ask(spark, QUERIES), 3, keep=["tag"]).collect()
    assert rows and all(r.tag == f"t{r.vec_id}" for r in rows)


def test_prompt(spark):
    hits = spark.createDataFrame(
        [("q", 2, "B", "two"), ("q", 1, "A", "one"), ("q", 3, "C", "three"), ("q", 4, "D", "four")],
        "query_id string, rank int, title string, content string",
    )
    asked = spark.createDataFrame([("q", "why?"), ("none", "what?")], "query_id string, question string")
    assert assemble_context(hits).first().context == "From A:\none\n\nFrom B:\ntwo\n\nFrom C:\nthree"
    prompts = {r.query_id: r.prompt for r in assemble_prompts(hits, asked).collect()}
    assert prompts["q"] == (
        "\n        Based on the following research findings, answer the student's question:\n"
        "\n        Research Context:\n        From A:\none\n\nFrom B:\ntwo\n\nFrom C:\nthree\n"
        "\n        Researcher's Question: why?\n"
        "\n        Answer: Provide a comprehensive answer based on the findings above.\n        "
    )
    assert "Research Context:\n        \n" in prompts["none"]
