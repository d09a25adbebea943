import pytest
from pyspark.sql import functions as F

from quireworks.operators.dedupe import (
    drop_known,
    first_seen,
    hash_sample,
    keep_known,
    known_hashes,
)
from quireworks.operators.embedding import hashed_words
from quireworks.operators.summaries import duplicate_keys, file_counts, ingest_summary, load_totals
from quireworks.plans.answer import answer_prompts, search_batch, search_collection
from quireworks.plans.ingest import (
    hashed_chunks,
    ingest_directory,
    ingest_files_in_batches,
    ingest_new_titles,
    insert_publications,
    new_chunks,
    store_documents,
)
from quireworks.registry.core import pages
from quireworks.sources.files import (
    document_concat,
    list_files,
    page_list,
    page_rows,
    read_files,
    text_files,
    utf8_pages,
)
from quireworks.sources.store import Ledger

MODEL = hashed_words(16)


def pubs(spark, rows):
    return spark.createDataFrame(rows, "title string, page_no long, content string")


def documents(store, name="c"):
    return sorted(r.document for r in store.rows(name).select("document").collect())


def test_repeats_in_batch_across_batches_and_collections(spark, store):
    first = pubs(spark, [("A", 0, "same"), ("B", 0, "same"), ("B", 1, "other"), ("C", 0, " ")])
    result = insert_publications(first, store, "c", MODEL)
    assert (result.new_chunks, result.skipped_chunks, result.total_chunks) == (2, 1, 3)
    row = store.rows("c").filter("document = 'same'").first()
    assert '"title":"A"' in row.cmetadata and len(row.embedding) == 16
    again = insert_publications(pubs(spark, [("D", 0, "same"), ("D", 1, "new")]), store, "c", MODEL)
    assert (again.new_chunks, again.skipped_chunks) == (1, 1)
    elsewhere = insert_publications(first, store, "other", MODEL)
    assert elsewhere.new_chunks == 2
    assert documents(store) == ["new", "other", "same"]
    assert duplicate_keys(store.rows()).isEmpty()
    assert store.collections().count() == 2 and store.count("c") == 3


def test_nothing_new(spark, store):
    assert insert_publications(pubs(spark, [("A", 0, "")]), store, "c", MODEL).total_chunks == 0
    insert_publications(pubs(spark, [("A", 0, "x")]), store, "c", MODEL)
    assert insert_publications(pubs(spark, [("A", 0, "x")]), store, "c", MODEL).new_chunks == 0
    assert documents(store) == ["x"]


def test_same_batch_id_replaces(spark, store):
    data = pubs(spark, [("A", 0, "x"), ("A", 1, "y")])
    one = insert_publications(data, store, "c", MODEL, batch_id="b")
    two = insert_publications(data, store, "c", MODEL, batch_id="b")
    assert one == two and documents(store) == ["x", "y"]


def test_append_without_dedupe(spark, store):
    data = pubs(spark, [("A", 0, "x"), ("B", 0, "x")])
    for expected in (2, 4):
        result = insert_publications(data, store, "c", MODEL, dedupe=False)
        assert result.new_chunks == 2 and store.count("c") == expected
    assert store.hashes("c").isEmpty()
    assert {r[0] for r in store.rows("c").select("cmetadata").collect()} == {
        '{"title":"A"}',
        '{"title":"B"}',
    }


def test_missing_title_column_and_null_title(spark, store):
    insert_publications(spark.createDataFrame([("x",)], "content string"), store, "c", MODEL)
    insert_publications(pubs(spark, [(None, 0, "y")]), store, "c", MODEL)
    got = {r.document: r.cmetadata for r in store.rows("c").collect()}
    assert '"title":"Untitled"' in got["x"] and '"title":""' in got["y"]


def test_broadcast_and_shuffle_lookup_agree(spark, small):
    chunks = hashed_chunks(pages(spark, small)).cache()
    stored = chunks.filter("page_no % 3 = 0").select("content_hash").distinct()
    n = chunks.count()
    a = new_chunks(chunks, stored, n, max_broadcast=n)
    b = new_chunks(chunks, stored, n, max_broadcast=1)
    assert a.count() == b.count() > 0
    assert a.select(*b.columns).exceptAll(b).isEmpty()
    known = known_hashes(chunks, stored)
    assert known.exceptAll(stored).isEmpty() and stored.exceptAll(known).isEmpty()
    assert drop_known(chunks, known).count() + keep_known(chunks, known).count() == n
    chunks.unpersist()


def test_a_third_of_all_chunks_are_copies(spark):
    n = 3000
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    chunks = spark.range(n).select(
        F.concat(F.lit("t"), F.col("id") % 7).alias("title"), F.col("id").alias("page_no"),
        F.lit(0).alias("chunk_idx"), F.sha2(hot.cast("string"), 256).alias("content_hash"),
    )
    first = first_seen(chunks)
    assert first.count() == 2001
    assert first.filter(F.col("content_hash") == F.sha2(F.lit("0"), 256)).first().page_no == 0
    known = chunks.filter("page_no = 0").select("content_hash")
    assert drop_known(chunks, known).count() == 2000
    assert keep_known(chunks, known).count() == 1000
    summary = ingest_summary(chunks, known, by=()).first()
    assert (summary.new_chunks, summary.skipped_chunks, summary.total_chunks) == (2000, 1000, 3000)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ingest_does_not_depend_on_batches(spark, small, tmp_path):
    from quireworks.sources.store import CollectionStore

    everything = pages(spark, small)
    whole, parts = (CollectionStore(spark, str(tmp_path / n)) for n in ("whole", "parts"))
    insert_publications(everything, whole, "c", MODEL)
    for i in range(3):
        insert_publications(everything.filter(F.col("page_no") % 3 == i), parts, "c", MODEL)
    a, b = (s.rows("c").select("uuid", "document", "content_hash") for s in (whole, parts))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_drop_collection(spark, store):
    for name in ("c", "d"):
        insert_publications(pubs(spark, [("A", 0, "x")]), store, name, MODEL)
    store.drop_collection("c")
    assert [r.name for r in store.collections().collect()] == ["d"]
    assert store.rows("c").isEmpty() and store.count("d") == 1


def test_store_documents_keeps_equal_texts(spark, store):
    docs = spark.createDataFrame(
        [("1", "x", "{}"), ("2", "x", "{}")], "custom_id string, document string, cmetadata string"
    )
    assert store_documents(docs, store, "c", MODEL).new_chunks == 2
    assert duplicate_keys(store.rows("c")).isEmpty()


def write(folder, **files):
    for name, text in files.items():
        path = folder / name.replace("__", "/").replace("_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def strict_pages():
    decode = utf8_pages()

    def pages_or_error(data):
        if data.startswith(b"broken"):
            raise ValueError("no page tree")
        return decode(data)

    return pages_or_error


def test_listing_and_text_files(spark, tmp_path):
    write(tmp_path, sub__c_PDF="x", a_pdf="y", b_txt=" keep \n", n_TXT="no", a_b_txt="2")
    listed = {r.path.rsplit("/", 1)[-1]: r.length for r in list_files(spark, str(tmp_path)).collect()}
    assert listed == {"c.PDF": 1, "a.pdf": 1}
    texts = {r.title: r.content for r in text_files(spark, str(tmp_path)).collect()}
    assert texts == {"b": " keep \n", "a.b": "2"}
    (tmp_path / "1 + 1 = 100%.txt").write_text("s")
    assert "1 + 1 = 100%" in {r.title for r in text_files(spark, str(tmp_path)).collect()}


def test_pages(spark):
    df = pubs(spark, [("a.pdf.pdf", 1, " two "), ("a.pdf.pdf", 0, "one"), ("b.pdf", 0, "\u00a0"),
                      ("A.PDF", 0, None)])
    assert sorted(r.content for r in page_rows(df).collect()) == ["one", "two"]
    assert sorted(r.content for r in page_list(df).collect()) == [" two ", "one"]
    assert load_totals(df).first() == (4, 2)


def test_document_concat_is_by_file_and_whole(spark):
    rows = [("x/r.pdf", "r.pdf", 1, "two"), ("x/r.pdf", "r.pdf", 0, "one"), ("y/r.pdf", "r.pdf", 0, "three"),
            ("a.pdf.pdf", "a.pdf.pdf", None, None)]
    rows += [("long.PDF", "long.PDF", i, f"{i},") for i in range(10_001)]
    df = spark.createDataFrame(rows, "source string, title string, page_no long, content string")
    failed = spark.createDataFrame([("f.pdf", "f.pdf", 0, None, "broken")], df.schema.add("error", "string"))
    df = df.drop("error").withColumn("error", F.lit(None).cast("string")).unionByName(failed)
    got = {(r.source, r.title): r.content for r in document_concat(df).collect()}
    assert got.pop(("long.PDF", "long.PDF")) == "".join(f"{i}," for i in range(10_001))
    assert got == {("x/r.pdf", "r"): "onetwo", ("y/r.pdf", "r"): "three", ("a.pdf.pdf", "a"): ""}


def test_files_of_odd_names_and_no_bytes_are_there(spark, store, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    names = ["a[1].txt", "{b}*.txt", "c?.txt", "d \\.txt", "e.txt"]
    for name in names:
        (folder / name).write_text("" if name == "e.txt" else name)
    listed = list_files(spark, str(folder), "*.txt").collect()
    assert {r.file_name: r.length for r in listed} == {n: 0 if n == "e.txt" else len(n) for n in names}
    for row in listed:
        found = read_files(spark, [row.path], "*.txt").collect()
        assert [bytes(r.content).decode() for r in found] == ["" if row.file_name == "e.txt" else row.file_name]
    texts = text_files(spark, str(folder)).collect()
    assert {r.content for r in texts} == {"", *names[:-1]} and len(texts) == 5
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    for expected in (5, 0):
        ingest_files_in_batches(
            spark, str(folder), utf8_pages(), ledger, store, "c", MODEL, 2, glob="*.txt"
        )
        assert ledger.read().count() == 5 and store.count("c") == 4


def test_failed_files_are_counted(spark, store, tmp_path):
    write(tmp_path / "in", a_pdf="one", bad_pdf="broken")
    result = ingest_directory(
        spark, str(tmp_path / "in"), strict_pages(), store, "c", MODEL, failures=str(tmp_path / "failed")
    )
    assert (result.new_chunks, result.failed_files) == (1, 1)
    failed = spark.read.parquet(str(tmp_path / "failed")).collect()
    assert len(failed) == 1 and failed[0].source.endswith("bad.pdf")


def test_equal_pages_without_dedupe_have_their_own_keys(spark, store):
    same = pubs(spark, [("A", 0, "same"), ("A", 0, "same"), ("A", 0, "same")])
    insert_publications(same, store, "c", MODEL, dedupe=False)
    assert store.rows("c").select("uuid").distinct().count() == 3
    assert search_collection(store, "c", "same", MODEL, k=2).count() == 2


def test_title_ingest_after_a_crash_replaces_its_rows(spark, store, tmp_path):
    class Crash(Ledger):
        def commit(self, done):
            raise RuntimeError("crash")

    pages_ = pubs(spark, [("A", 0, "one"), ("B", 0, "two")])
    with pytest.raises(RuntimeError, match="crash"):
        ingest_new_titles(pages_, Crash(spark, str(tmp_path / "t"), "title"), store, "c", MODEL)
    ledger = Ledger(spark, str(tmp_path / "t"), "title")
    ingest_new_titles(pages_, ledger, store, "c", MODEL)
    assert documents(store) == ["one", "two"] and ledger.read().count() == 2


def test_no_new_chunk_writes_nothing(spark, store):
    insert_publications(pubs(spark, [("A", 0, " ")]), store, "c", MODEL)
    assert store.collections().isEmpty() and store.rows().isEmpty()
    insert_publications(pubs(spark, [("A", 0, "x")]), store, "c", MODEL, "1")
    insert_publications(pubs(spark, [("B", 0, "x")]), store, "c", MODEL, "2")
    assert [r.batch_id for r in store.rows("c").select("batch_id").distinct().collect()] == ["1"]


def test_vectors_of_another_length_are_refused(spark, store):
    insert_publications(pubs(spark, [("A", 0, "x")]), store, "c", MODEL)
    with pytest.raises(ValueError, match="lengths"):
        insert_publications(pubs(spark, [("B", 0, "y")]), store, "c", hashed_words(8))
    assert documents(store) == ["x"] and store.dimension("c") == 16
    assert search_collection(store, "c", "x", MODEL, k=2).count() == 1


def test_compaction_keeps_all_rows_and_one_collection_is_listed(spark, store):
    for i in range(3):
        insert_publications(pubs(spark, [("A", i, f"text {i}")]), store, "c", MODEL)
    insert_publications(pubs(spark, [("A", 0, "elsewhere")]), store, "other", MODEL)
    assert len(store.rows("c").inputFiles()) >= 3
    assert all(store.collection_id("c") in name for name in store.rows("c").inputFiles())
    before = sorted(map(str, store.rows("c").drop("batch_id").collect()))
    store.compact("c", 1)
    assert sorted(map(str, store.rows("c").drop("batch_id").collect())) == before
    assert len(store.rows("c").inputFiles()) == 1 and documents(store, "other") == ["elsewhere"]


def test_scratch_is_empty_after_an_ingest(spark, store, tmp_path, monkeypatch):
    from quireworks.plans import ingest

    monkeypatch.setattr(ingest, "scratch_dir", lambda spark, purpose: str(tmp_path / "scratch" / purpose))
    insert_publications(pubs(spark, [("A", 0, "x")]), store, "c", MODEL)
    with pytest.raises(ValueError):
        insert_publications(pubs(spark, [("B", 0, "y")]), store, "c", hashed_words(8))
    assert list((tmp_path / "scratch").iterdir()) == []


def test_directory(spark, store, tmp_path):
    write(tmp_path / "in", a_pdf="one\ftwo\f \f", sub__a_pdf="three", bad_pdf="broken")
    result = ingest_directory(spark, str(tmp_path / "in"), strict_pages(), store, "c", MODEL)
    assert result.new_chunks == 3 and documents(store) == ["one", "three", "two"]


@pytest.mark.parametrize("per_batch", [1, 2, 50])
def test_files_in_batches(spark, store, tmp_path, per_batch):
    """Same names in two folders, a failing file, a second run with one more file."""
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    write(tmp_path / "in", a_pdf="one", sub__a_pdf="two\fone", bad_pdf="broken")
    args = (spark, str(tmp_path / "in"), strict_pages(), ledger, store, "c", MODEL, per_batch)
    results = ingest_files_in_batches(*args)
    assert len(results) == -(-3 // per_batch)
    assert sum(r.new_chunks for r in results) == 2 and sum(r.skipped_chunks for r in results) == 1
    assert sorted(r.path.rsplit("/in/")[1] for r in ledger.read().collect()) == ["a.pdf", "sub/a.pdf"]
    write(tmp_path / "in", bad_pdf="repaired", c_pdf="one")
    results = ingest_files_in_batches(*args)
    assert documents(store) == ["one", "repaired", "two"] and ledger.read().count() == 4
    assert ingest_files_in_batches(*args) == []
    listed = list_files(spark, str(tmp_path / "in"))
    assert file_counts(listed, ledger.read()).first() == (4, 4, 0)


def test_title_ledger(spark, store, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"), key="title")
    data = pubs(spark, [("A", 0, "x"), ("A", 1, "x"), (None, 0, "y")])
    assert ingest_new_titles(data, ledger, store, "c", MODEL).new_chunks == 3
    assert ingest_new_titles(data, ledger, store, "c", MODEL).new_chunks == 0
    assert ledger.read().count() == 2 and store.count("c") == 3


def test_json_ledger_is_taken_over(spark, tmp_path):
    (tmp_path / "done.json").write_text('[\n  "s3://b/a.pdf",\n  "x \\u00e9.pdf"\n]')
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.read().isEmpty()
    ledger.import_json(str(tmp_path / "done.json"))
    assert sorted(r.path for r in ledger.read().collect()) == ["s3://b/a.pdf", "x é.pdf"]


def test_search_and_prompts(spark, store):
    data = pubs(spark, [("Cats", 0, "cats purr and sleep"), ("Dogs", 0, "dogs bark and run"),
                        ("Fish", 0, "fish swim"), ("Birds", 0, "birds sing")])
    insert_publications(data, store, "c", MODEL)
    insert_publications(pubs(spark, [("Else", 0, "cats purr and sleep")]), store, "d", MODEL)
    hits = search_collection(store, "c", "cats purr", MODEL, 2).orderBy("rank").collect()
    assert [h.title for h in hits][0] == "Cats" and len(hits) == 2
    asked = spark.createDataFrame([("1", "dogs bark"), ("2", "fish swim")], "query_id string, question string")
    best = search_batch(store, "c", asked, MODEL, 1).collect()
    assert {(h.query_id, h.title) for h in best} == {("1", "Dogs"), ("2", "Fish")}
    prompts = {r.query_id: r.prompt for r in answer_prompts(store, "c", asked, MODEL).collect()}
    assert prompts["1"].count("From ") == 3 and "From Dogs:\ndogs bark and run" in prompts["1"]


def test_hash_sample_is_stable(spark):
    df = spark.createDataFrame([("b",), ("a",), ("",), (None,), ("a",)], "content_hash string")
    assert [r[0] for r in hash_sample(df).collect()] == ["a", "b"]


def counted(store, name="c"):
    return sorted(r.document for r in store.rows(name).select("document").collect())


def test_broken_off_compaction_loses_nothing(spark, store, monkeypatch):
    """Broken off before and after the rename, with a batch between."""
    from quireworks.sources import store as module

    for i in range(2):
        insert_publications(pubs(spark, [("A", i, f"text {i}")]), store, "c", MODEL, f"b{i}")
    real = module.move_path

    def crash_at(wanted):
        def move(spark, source, target):
            if wanted in target:
                raise RuntimeError("crash")
            return real(spark, source, target)

        return move

    for i, wanted in enumerate(("generation=1", "hashes"), 2):
        with monkeypatch.context() as patch:
            patch.setattr(module, "move_path", crash_at(wanted))
            with pytest.raises(RuntimeError, match="crash"):
                store.compact("c", 1)
        insert_publications(pubs(spark, [("A", i, f"text {i}"), ("A", 9, "text 0")]), store, "c", MODEL, f"b{i}")
        assert documents(store) == [f"text {k}" for k in range(i + 1)]
    store.compact("c", 1)
    assert documents(store) == [f"text {k}" for k in range(4)]
    insert_publications(pubs(spark, [("B", 0, "text 3"), ("B", 1, "new")]), store, "c", MODEL)
    assert documents(store) == ["new", *(f"text {k}" for k in range(4))]


def test_batch_published_while_a_compaction_copies_is_kept(spark, store, monkeypatch):
    from quireworks.sources import store as module

    insert_publications(pubs(spark, [("A", 0, "one")]), store, "c", MODEL, "b0")
    begun = store.rows("c")
    real, done = module.CollectionStore._write_hashes, []

    def between(self, rows, path):
        real(self, rows, path)
        if not done:
            done.append(True)
            insert_publications(pubs(spark, [("B", 0, "two")]), CollectionStore(spark, store.root), "c", MODEL, "b1")

    from quireworks.sources.store import CollectionStore

    monkeypatch.setattr(module.CollectionStore, "_write_hashes", between)
    store.compact("c", 1)
    assert done and documents(store) == ["one", "two"]
    assert [r.document for r in begun.collect()] == ["one"]  # a reader that began before
    again = insert_publications(pubs(spark, [("A", 0, "one")]), store, "c", MODEL, "b0")
    assert again.new_chunks == 0 and documents(store) == ["one", "two"]


def test_refused_batch_leaves_the_old_one(spark, store):
    insert_publications(pubs(spark, [("A", 0, "x"), ("A", 1, "y")]), store, "c", MODEL, "b")
    insert_publications(pubs(spark, [("B", 0, "z")]), store, "c", MODEL, "other")
    with pytest.raises(ValueError, match="lengths"):
        insert_publications(pubs(spark, [("A", 0, "new")]), store, "c", hashed_words(8), "b")
    assert documents(store) == ["x", "y", "z"]
    insert_publications(pubs(spark, [("A", 0, "new")]), store, "c", MODEL, "b")
    assert documents(store) == ["new", "z"]
    with pytest.raises(ValueError, match="batch id"):
        insert_publications(pubs(spark, [("A", 0, "q")]), store, "c", MODEL, "a/b")


def test_title_ingest_after_a_crash_with_one_more_title(spark, store, tmp_path):
    class Crash(Ledger):
        def commit(self, done):
            raise RuntimeError("crash")

    rows = [("A", 0, "one"), ("B", 0, "two")]
    with pytest.raises(RuntimeError, match="crash"):
        ingest_new_titles(pubs(spark, rows), Crash(spark, str(tmp_path / "t"), "title"), store, "c", MODEL)
    ledger = Ledger(spark, str(tmp_path / "t"), "title")
    result = ingest_new_titles(pubs(spark, [*rows, ("C", 0, "three")]), ledger, store, "c", MODEL)
    assert result.new_chunks == 1 and documents(store) == ["one", "three", "two"]
    assert sorted(r.title for r in ledger.read().collect()) == ["A", "B", "C"]
    store.compact("c", 1)
    assert sorted(r.key for r in store.keys("c", "title").collect()) == ["A", "B", "C"]


def test_hashes_are_found_with_and_without_their_buckets(spark, store, tmp_path):
    from quireworks.sources.store import CollectionStore

    insert_publications(pubs(spark, [("A", i, f"text {i}") for i in range(30)]), store, "c", MODEL, "1")
    insert_publications(pubs(spark, [("B", i, f"more {i}") for i in range(30)]), store, "c", MODEL, "2")
    asked = spark.createDataFrame(
        [(f"text {i}",) for i in range(5)] + [("more 3",), ("more 3",), ("none",)], "content string"
    ).select(F.sha2("content", 256).alias("content_hash"))

    def known(store, without=None):
        with store.known_hashes(asked, "c", without) as found:
            return found.count()

    assert known(store) == 6 and known(store, "2") == 5 and known(store, "1") == 1
    assert known(CollectionStore(spark, store.root, hash_buckets=3)) == 6  # no such buckets: from the rows
    assert not any(t.name.startswith("quireworks_") for t in spark.catalog.listTables())


def test_compacted_files_are_bounded_by_bytes(spark, store):
    """One task sorts and writes a file: a large collection gets more than are asked for."""
    from quireworks.session import folder_bytes

    rows = [("A", i, " ".join(f"w{i * 997 * j % 10_007}" for j in range(120))) for i in range(400)]
    insert_publications(pubs(spark, rows).repartition(4), store, "c", MODEL, "1")
    before = sorted(map(str, store.rows("c").drop("batch_id").collect()))
    size = folder_bytes(spark, f"{store.root}/embeddings")
    store.compact("c", 2, file_bytes=size // 5)
    files = spark.read.parquet(*store.rows("c").inputFiles())
    assert len(store.rows("c").inputFiles()) >= 5
    shares = files.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in shares) < 200
    assert sorted(map(str, store.rows("c").drop("batch_id").collect())) == before


def test_hashes_of_many_small_batches_are_in_one_file_each(spark, tmp_path):
    from quireworks.session import list_names
    from quireworks.sources.store import CollectionStore

    store = CollectionStore(spark, str(tmp_path / "store"), hash_buckets=2)
    for i in range(4):
        texts = [(f"t{i}", j, f"text {i} {j}") for j in range(10)] + [("same", 0, "same")]
        result = insert_publications(pubs(spark, texts), store, "c", MODEL, f"b{i}")
        assert result.new_chunks == (10 if i else 11)
    key = store.collection_id("c")
    assert [list_names(spark, store._hash_folder(key, 0, n)) for n in (2, 1)] == [
        ["batch_id=b0", "batch_id=b1"], ["batch_id=b2", "batch_id=b3"]
    ]
    again = [("x", 0, "text 3 1"), ("x", 1, "text 2 1"), ("x", 2, "text 0 1"), ("x", 3, "new")]
    assert insert_publications(pubs(spark, again), store, "c", MODEL, "b3").new_chunks == 2
    assert insert_publications(pubs(spark, again), store, "c", MODEL, "b4").new_chunks == 0
    asked = spark.createDataFrame([("text 0 1",), ("text 2 1",), ("text 3 2",)], "content string")
    asked = asked.select(F.sha2("content", 256).alias("content_hash"))
    for n in (None, 3):
        with store.known_hashes(asked, "c", n_chunks=n) as found:
            assert found.count() == 2
        with store.known_hashes(asked, "c", "b2", n_chunks=n) as found:
            assert found.count() == 1


def test_ledger_is_settled_once_for_all_waves(spark, store, tmp_path, monkeypatch):
    """Each settling reads all published keys, so one for each wave grows with their square."""
    write(tmp_path / "in", a_pdf="one", b_pdf="two", c_pdf="three")
    real, calls = Ledger.settle, []
    monkeypatch.setattr(Ledger, "settle", lambda self, *args: (calls.append(1), real(self, *args)))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    for _ in range(2):
        ingest_files_in_batches(
            spark, str(tmp_path / "in"), strict_pages(), ledger, store, "c", MODEL, 1, wave_files=1
        )
    assert len(calls) == 2 and ledger.read().count() == 3 and documents(store) == ["one", "three", "two"]


def test_small_sets_of_files_go_to_few_tasks(spark, tmp_path):
    from quireworks.sources.listing import with_contents

    paths = spark.createDataFrame([(str(tmp_path / f"{i}.txt"),) for i in range(10)], "path string")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        tasks = [with_contents(paths, n).rdd.getNumPartitions() for n in (None, 10, 4000, 1_000_000)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert tasks == [64, spark.sparkContext.defaultParallelism, 16, 64]


def test_pages_of_large_and_small_files_keep_their_columns(spark, store, tmp_path):
    from quireworks.sources.files import decode_pages

    texts = {f"{i}": "\f".join(f"{i} {j} " + "x" * (700_000 if i % 3 else 1) for j in range(i)) for i in range(9)}
    files = spark.createDataFrame([(n, t.encode(), int(n)) for n, t in texts.items()], "path string, content binary, batch_no long")
    got = decode_pages(files.coalesce(1), utf8_pages()).collect()
    found = sorted((r.batch_no, r.source, r.page_no, r.content) for r in got)
    assert found == sorted((int(n), n, k, p) for n, t in texts.items() for k, p in enumerate(t.split("\f")))


def test_repeated_documents_are_counted_by_digest(spark, small):
    """Texts are shuffled once, and no exchange goes by them."""
    from quireworks.registry.ingests import ingest_append_repeats

    rows = ingest_append_repeats(spark, small)
    assert "hashpartitioning(document" not in rows._jdf.queryExecution().toString()
    assert rows.columns == ["document", "n_rows", "n_keys"]


def test_waves_grow_so_that_their_number_does_not_follow_the_files(spark, store, tmp_path):
    from itertools import groupby

    write(tmp_path / "in", bad_pdf="broken", **{f"f{i:02d}_pdf": f"text {i // 2}" for i in range(59)})
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    found = ingest_files_in_batches(
        spark, str(tmp_path / "in"), strict_pages(), ledger, store, "c", MODEL, 1, wave_files=40
    )
    waves = [[*group] for _, group in groupby(found, lambda r: r.batch_id.rpartition(".")[0])]
    assert [len(w) for w in waves] == [4, 8, 16, 32]
    assert [int(r.batch_id.rpartition(".")[2]) for r in found] == [*range(1, 61)] == [*range(1, len(found) + 1)]
    assert found[-1] == found[59] == found[58:][1] and found[0].failed_files == 1
    assert sum(r.new_chunks for r in found) == 30 and sum(r.skipped_chunks for r in found) == 29
    assert documents(store) == sorted(f"text {i}" for i in range(30)) and ledger.read().count() == 59


def test_pages_without_chunks_are_kept_once(spark):
    from quireworks.plans.ingest import chunked_pages, chunks_of_pages, page_chunks

    rows = [
        ("a", "A ", 0, " one. " + "two " * 400, None), ("a", "A ", 1, " \u200b ", None), ("b", "B", None, None, None),
        ("c", None, 0, None, "broken"), ("d", "D", 0, "\u00a0\n", None), ("e", "E", 2, "\u00a0three\n", None),
    ]
    pages_ = spark.createDataFrame(rows, "source string, title string, page_no long, content string, error string")
    staged = page_chunks(pages_).cache()
    found = chunked_pages(staged)
    assert sorted((r.source, r.page_no, r.blank) for r in found.filter("page_no IS NOT NULL").collect()) == [
        ("a", 0, False), ("a", 1, False), ("c", 0, True), ("d", 0, True), ("e", 2, False)
    ]
    assert found.count() == 6
    want = hashed_chunks(page_rows(pages_.filter("error IS NULL")))
    got = chunks_of_pages(staged)
    assert got.columns == want.columns and want.count() > 2
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    staged.unpersist()


def test_workers_load_a_model_once_and_without_pyspark_ml(spark, tmp_path):
    import subprocess
    import sys

    import numpy as np

    from quireworks.operators.embedding import embed_documents

    loads = str(tmp_path / "loads")

    def model():
        import os

        with open(loads, "a") as file:
            file.write(f"{os.getpid()}\n")
        return lambda texts: np.array([[len(t), 1] for t in texts]).reshape(-1, 2)

    rows = spark.createDataFrame([("abc",), (None,), ("",)], "document string").coalesce(1)
    for _ in range(4):
        got = embed_documents(rows, model, batch_size=2).collect()
        assert [(r.document, r.embedding) for r in got] == [("abc", [3, 1]), (None, [0, 1]), ("", [0, 1])]
    pids = open(loads).read().split()
    assert len(pids) == len(set(pids))
    imported = "import sys, quireworks.operators.embedding; sys.exit('pyspark.ml' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", imported]).returncode == 0
