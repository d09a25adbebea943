from collections import defaultdict

from quireworks.llm import mixing
from tests.llm.conftest import MESSY


def levels(sizes, weights, share=1.5, most=2.0):
    """Water filling, step by step."""
    total, capped = share * sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        rest = {s: w for s, w in weights.items() if s not in capped}
        targets = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        over = {s: most * sizes[s] for s in rest if targets[s] > most * sizes[s] + 1e-9}
        if not over:
            return {**targets, **capped}
        capped.update(over)


def test_targets_and_copies(documents):
    rows = [(i, "w " * (i % 7 + 1), None, "abcdef"[min(i % 11, 5)]) for i in range(400)]
    found = mixing.mix_sources(documents(rows)).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 2
    weights = dict(zip(sorted(sizes), [5, 2, 1, 5, 2, 1]))
    expected = levels(sizes, weights)
    for r in found:
        assert abs(r.target - expected[r.source]) < 1e-6
        assert r.source_size == sizes[r.source]
    for source, words in taken.items():
        assert abs(words - expected[source]) <= 14  # two of the largest documents


def test_messy_rows(messy):
    found = mixing.mix_sources(messy)
    assert found.count() == len(MESSY)
    by = {(r.doc_id, r.source): r for r in found.collect()}
    assert by[1, "a"].size == by[3, "a"].size == 0 and by[1, "a"].target == 0.0
    assert by[4, None].source_size == 3
    repeated = mixing.repeat_documents(messy)
    assert repeated.columns == messy.columns
    counts = {(r.doc_id, r.text): r["count"] for r in repeated.groupBy("doc_id", "text").count().collect()}
    wanted = defaultdict(int)
    texts = {row[0]: row[1] for row in MESSY}
    for r in found.collect():
        wanted[r.doc_id, texts[r.doc_id]] += r.copies
    assert counts == {k: v for k, v in wanted.items() if v}


def test_reruns_agree_whatever_the_partitions(messy):
    once = sorted(mixing.mix_sources(messy).collect(), key=str)
    again = sorted(mixing.mix_sources(messy.repartition(5)).collect(), key=str)
    assert once == again


def test_no_rows(none):
    assert mixing.mix_sources(none).collect() == []
    assert mixing.repeat_documents(none).collect() == []


def test_native(spark, small):
    plan = mixing.op4_mixing(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_source_for_every_document(spark):
    """Nothing goes by one task or broadcast with the sources: 100,000 of them, sizes 1 to 50."""
    docs = spark.range(100_000).selectExpr(
        "id AS doc_id", "concat('s', lpad(id, 6, '0')) AS source", "repeat('w ', cast(1 + (id * 7919) % 50 AS int)) AS text"
    )
    targets = mixing.source_targets(docs.selectExpr("source", "size(split(trim(text), ' ')) AS size"))
    found = {r.source: (r.target, r.first) for r in targets.collect()}
    sizes = [1 + (i * 7919) % 50 for i in range(100_000)]
    weights = [(5, 2, 1)[i % 3] for i in range(100_000)]
    order = sorted(range(100_000), key=lambda i: (sizes[i] / weights[i], i))
    room, left = 1.5 * sum(sizes), sum(weights)
    for place, i in enumerate(order):
        if weights[i] * room / left < 2 * sizes[i]:
            break
        room, left = room - 2 * sizes[i], left - weights[i]
    capped = set(order[:place])
    for i in range(0, 100_000, 37):
        wanted = 2.0 * sizes[i] if i in capped else weights[i] * room / left
        assert abs(found[f"s{i:06d}"][0] - wanted) < 1e-6 and found[f"s{i:06d}"][1] == i
    mixed = mixing.mix_sources(docs)
    assert mixed.count() == 100_000
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan.split("Join")[1]
