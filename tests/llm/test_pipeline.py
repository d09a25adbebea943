import numpy as np

import corpus_pipeline
from quireworks.llm import near_dups, toxicity
from tests.llm.conftest import MESSY
from tests.llm.test_packing import check, tokenizer, whole  # noqa: F401


def test_stages(spark, small, tmp_path, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        path = str(tmp_path / name)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
        if name == "near_duplicates":
            found = near_dups.near_duplicates(before, 5, 80).collect()
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in found if r.kept)
            assert 0 < docs.count() < before.count()
    toxic = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").filter("toxic = 1").collect()}
    assert len(toxic & {r.doc_id for r in kept["toxicity"].collect()}) <= 2
    masked = [r.text for r in kept["personal_data"].collect()]
    assert any("[PHONE]" in text for text in masked) and not any("@" in text for text in masked)
    words = {r.source: 0 for r in kept["personal_data"].collect()}
    for r in kept["mixing"].collect():
        words[r.source] += len(r.text.encode().split())
    total = sum(len(t.encode().split()) for t in masked)
    assert abs(sum(words.values()) - 1.5 * total) < 0.1 * total
    check(docs.collect(), [(r.doc_id, whole(tokenizer, r.text)) for r in kept["mixing"].collect()])


def test_messy_and_no_rows(spark, messy, none, small, tmp_path):
    for label, rows in (("messy", messy), ("none", none)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, small).write.parquet(str(tmp_path / label / name))
            docs = spark.read.parquet(str(tmp_path / label / name))
        assert (docs.count() > 0) == (label == "messy")


def test_near_duplicates_keep_one_row_each(spark, documents, messy, small):
    def kept(docs):
        out = corpus_pipeline.drop_near_duplicates(spark, docs, small)
        assert out.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    assert kept(messy) == sorted({row[:2] for row in MESSY if row[0] != 8}, key=str)
    one = " ".join(f"one{i}" for i in range(40))
    near = one.replace("one39", "end")
    other = " ".join(f"other{i}" for i in range(40))
    rows = [(1, one), (5, one), (5, other), (5, near), (7, other), (7, other), (8, ""), (8, ""), (8, None), (None, near)]
    rows += [(9, "alone here it stands so"), (None, "no id at all but words")] * 30 + [(5, other)] * 30
    wanted = [(1, one), (5, other), (8, ""), (8, None), (9, "alone here it stands so"), (None, "no id at all but words")]
    assert kept(documents(rows)) == sorted(wanted, key=str)


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and np.isclose(toxicity.THRESHOLD, 0.3)
