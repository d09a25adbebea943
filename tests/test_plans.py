"""What the physical plans must and must not hold."""

from pyspark.sql import functions as F

from quireworks.operators.batching import assign_batches, with_global_index
from quireworks.operators.embedding import hashed_words
from quireworks.plans.ingest import hashed_chunks, insert_publications, new_chunks
from quireworks.registry.core import pages

MODEL = hashed_words(8)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunking_shuffles_nothing_and_cleans_once(spark, small):
    """A small input is spread over the cores first, one of many splits is not."""
    assert plan(hashed_chunks(pages(spark, small))).count("Exchange RoundRobin") == 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1kb")
    try:
        text = plan(hashed_chunks(pages(spark, small)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "Exchange" not in text
    assert text.count("translate(") == 2  # title and content


def test_store_lookup_reads_one_partition_and_one_column(spark, small, store):
    for name in ("c", "d"):
        insert_publications(pages(spark, small), store, name, MODEL)
    text = plan(store.hashes("c"))
    assert "ReadSchema: struct<content_hash:string>" in text
    listed = store.hashes("c").inputFiles()
    assert listed and all(f"collection_id={store.collection_id('c')}" in name for name in listed)
    assert "PushedFilters: [IsNotNull(content_hash)]" in text


def test_small_batch_scans_the_store_without_shuffling_it(spark, small, store):
    insert_publications(pages(spark, small), store, "c", MODEL)
    chunks = hashed_chunks(pages(spark, small))
    stored = store.hashes("c")
    small_plan = plan(new_chunks(chunks, stored, n_chunks=10))
    assert "BroadcastHashJoin [content_hash" in small_plan and "LeftSemi, BuildRight" in small_plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = plan(new_chunks(chunks, stored, n_chunks=10, max_broadcast=1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The texts are shuffled once: the window and the anti join share the partitioning.
    assert large.count("Exchange hashpartitioning(content_hash") == 2
    assert "Broadcast" not in large


def test_texts_of_hits_are_read_from_their_batches_only(spark, store):
    from quireworks.plans.answer import search_collection

    for batch, text in (("b1", "cats purr"), ("b2", "dogs bark")):
        df = spark.createDataFrame([(text,)], "content string")
        insert_publications(df, store, "c", MODEL, batch)
    hits = search_collection(store, "c", "cats purr", MODEL, 1)
    assert [r.content for r in hits.collect()] == ["cats purr"]
    logical = hits._jdf.queryExecution().optimizedPlan().toString()
    (scan,) = [line for line in logical.splitlines() if "Filter" in line and "isnotnull(uuid" in line
               and "rank" not in line and "= b1" in line][:1]
    assert "b2" not in logical and scan


def test_model_runs_once_per_text(spark, small):
    from quireworks.operators.embedding import embed_documents

    vectors = embed_documents(hashed_chunks(pages(spark, small)), MODEL, text="content")
    assert plan(vectors.filter("embedding is not null")).count("ArrowEvalPython [predict") == 1
    exploded = vectors.select("title", F.posexplode("embedding"))
    assert plan(exploded).count("ArrowEvalPython [predict") == 1


def test_global_index_counts_without_a_single_task(spark):
    df = spark.range(0, 5000, numPartitions=6).select(F.concat(F.lit("p"), F.hash("id")).alias("path"))
    got = with_global_index(df.distinct(), ["path"]).orderBy("idx").collect()
    assert [r.idx for r in got] == list(range(len(got)))
    assert [r.path for r in got] == sorted(r.path for r in got)
    batches = assign_batches(df.distinct(), ["path"], 7).groupBy("batch_no").count().collect()
    assert {r["count"] for r in batches if r.batch_no <= len(got) // 7} == {7}


def test_stored_hashes_are_not_shuffled_whatever_the_batch(spark, small, store):
    """Buckets of the store meet the batch's hashes; only the batch's are exchanged."""
    everything = pages(spark, small)
    insert_publications(everything, store, "c", MODEL, "1")
    insert_publications(everything.filter("page_no > 5"), store, "c", MODEL, "2")
    chunks = hashed_chunks(everything)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with store.known_hashes(chunks, "c") as known:
            lines = plan(known).splitlines()
            assert known.count() == chunks.select("content_hash").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (join,) = [i for i, line in enumerate(lines) if "ShuffledHashJoin" in line]
    (scan,) = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
    assert join < scan and not any("Exchange" in line for line in lines[join:scan])
    assert "Exchange hashpartitioning(hash" in "".join(lines[scan:])


def test_jobs_of_an_ingest_do_not_follow_the_batches(spark, store, tmp_path):
    """One wave decodes and writes all batches, whatever the number of files in each."""
    from quireworks.plans.ingest import ingest_files_in_batches
    from quireworks.sources.files import utf8_pages
    from quireworks.sources.store import Ledger

    (tmp_path / "in").mkdir()
    for i in range(40):
        (tmp_path / "in" / f"{i}.txt").write_text(f"text {i}")
    tracker, jobs = spark.sparkContext.statusTracker(), {}
    for per_batch in (1, 40):
        spark.sparkContext.setJobGroup(f"per-{per_batch}", "")
        ledger = Ledger(spark, str(tmp_path / f"ledger-{per_batch}"))
        found = ingest_files_in_batches(
            spark, str(tmp_path / "in"), utf8_pages(), ledger, store, f"c{per_batch}", MODEL, per_batch, glob="*.txt"
        )
        assert len(found) == 40 // per_batch and sum(r.new_chunks for r in found) == 40
        jobs[per_batch] = len(tracker.getJobIdsForGroup(f"per-{per_batch}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] == jobs[40] > 0


def test_listings_go_by_tasks(spark, tmp_path):
    from quireworks.sources.files import list_files

    for folder in ("a", "b/c", "d"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "x.pdf").write_text("x")
    (tmp_path / "top.pdf").write_text("")
    (tmp_path / "_hidden.pdf").write_text("no")
    listed = list_files(spark, str(tmp_path))
    text = listed._jdf.queryExecution().toString()
    assert "BatchScan" in text and "LocalRelation" not in text and ".pdf" not in text
    assert listed.rdd.getNumPartitions() == 4  # the folder itself and three below
    assert sorted((r.file_name, r.length) for r in listed.collect()) == [("top.pdf", 0), *[("x.pdf", 1)] * 3]
