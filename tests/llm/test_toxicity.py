import zlib

import numpy as np
from pyspark.sql import functions as F

from quireworks.llm import toxicity
from tests.llm.conftest import MESSY


def test_held_out_by_crc(spark):
    rows = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_held_out_labels_do_not_matter(spark, documents):
    rows = [(i, f"plain text number{i % 9} with {'idiot words' if i % 5 == 0 else 'kind words'}") for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    one, other = (toxicity.train(documents(rows), x) for x in (labels, turned))
    assert one.names == other.names and np.allclose(one.weights, other.weights)
    scored = toxicity.score_texts(documents(rows), one).collect()
    assert all((r.score >= 0.3) == (r.doc_id % 5 == 0) for r in scored)


def test_swap_penalty_frees_group_mentions(spark, documents):
    """In the sample a group is mentioned in toxic texts mostly; the penalty takes that away."""
    rows, toxic = [], []
    for i in range(300):
        bad = i % 3 == 0
        group = "immigrants" if bad and i % 2 else ""
        rows.append((i, f"some words about w{i % 17} {group} {'scum' if bad and i % 4 else ''} and more w{i % 5}"))
        toxic.append((i, int(bad)))
    labels = spark.createDataFrame(toxic, "doc_id long, toxic int")
    docs = documents(rows)
    sample = toxicity.training_sample(docs, labels).checkpoint()
    names = toxicity.select_features(sample)
    names += sorted({n for term in toxicity._NEXT for n in toxicity.features(term)} - set(names))
    x, other, (y, counts) = toxicity.presence(sample, names)

    def change(weights):  # of a text's score, where it names others instead
        own, others = (set(toxicity.features(term)) for term in ("immigrants", "refugees"))
        value = dict(zip(names, weights))
        return sum(value[x] for x in own - others) - sum(value[x] for x in others - own)

    free, _ = toxicity.fit(x, other, y, counts, penalty=0.0)
    held, _ = toxicity.fit(x, other, y, counts, penalty=10.0)
    assert change(free) > 1 and abs(change(held)) < 0.5 * change(free)
    assert held[names.index("=scum")] > 1


def test_messy_rows(spark, messy, none):
    labels = spark.createDataFrame(
        [(5, 1, 0), (6, 1, 1), (7, 0, 1), (8, 1, 0), (9, 1, 0), (1, 0, 0), (None, 1, 1), (10, None, None), (77, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    model = toxicity.train(messy, labels)
    scored = toxicity.score_texts(messy, model)
    assert scored.columns == [c for c in messy.columns if c != "score"] + ["score"]
    rows = scored.collect()
    assert len(rows) == len(MESSY) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.score_texts(none, model).collect() == []
    assert toxicity.train(none, labels).names == () == toxicity.train(messy, labels.limit(0)).names


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.op10_toxicity(spark, folder).filter("held_out").join(labels, "doc_id").collect()
    bad, good = [r.predicted for r in rows if r.toxic], [r.predicted for r in rows if not r.toxic]
    assert np.mean(bad) > 0.85 and np.mean(good) < 0.02


def test_selection_fit_and_scores_equal_a_plain_version(spark, documents):
    """Counts, chi-squared, the gradient and the scores by dictionaries and loops."""
    rng = np.random.default_rng(11)
    words = [f"Word{i}," for i in range(60)] + ["Women", "gay!", "(idiots)", "scum", "ÜBEL", "“trash”"]
    rows, marks = [], {}
    for i in range(400):
        bad = i % 3 == 0
        own = list(rng.choice(words[:61], rng.integers(0, 15))) + (list(rng.choice(words[61:], 2)) if bad and i % 4 else [])
        rows.append((i, " ".join(own) if i % 50 else None))
        marks[i] = int(bad)
    labels = spark.createDataFrame(list(marks.items()), "doc_id long, toxic int")
    docs = documents(rows)

    def features(text):
        found = set()
        for word in set((text or "").encode().split()):
            found |= set(toxicity.features(toxicity.normal(word)))
        return found

    known = [(features(t), marks[i]) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    n = len(known)
    t = sum(y for _, y in known)
    chi = {}
    for name in set().union(*(f for f, _ in known)):
        a, b = (sum(name in f for f, y in known if y == label) for label in (1, 0))
        cross = a * (n - t) - b * t
        value = cross * cross * n / (t * (n - t) * (a + b) * max(n - a - b, 1))
        if a + b >= 2 and value > 3.84:
            chi[name] = value
    best = sorted(chi, key=lambda x: (-chi[x], x))[:20]
    sample = toxicity.training_sample(docs, labels).checkpoint()
    selected = toxicity.select_features(sample, 20)
    assert sorted(selected) == sorted(best) and np.allclose([chi[x] for x in selected], [chi[x] for x in best])

    model = toxicity.train(docs, labels, most=20)
    value = dict(zip(model.names, model.weights))
    x, other, (y, counts) = toxicity.presence(sample, list(model.names))
    assert counts.sum() == n and y @ counts == t
    w = np.append(model.weights, model.bias)
    ones = np.ones((len(x), 1))
    full, change = np.hstack([x, ones]), np.hstack([x - other, 0 * ones])
    gradient = toxicity.RIDGE * w
    for row, moved, label, count in zip(full, change, y, counts):
        gradient += count * ((1 / (1 + np.exp(-row @ w)) - label) * row + toxicity.SWAP_PENALTY * (moved @ w) * moved)
    assert np.abs(gradient).max() < 1e-4
    for r in toxicity.score_texts(docs, model).collect():
        z = model.bias + sum(value.get(f, 0.0) for f in features(r.text))
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9
