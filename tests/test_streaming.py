import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quireworks.operators.embedding import hashed_words
from quireworks.plans.ingest import insert_publications
from quireworks.registry.core import pages
from quireworks.sources.store import CollectionStore
from quireworks.streaming.ingest import (
    file_stream,
    ingest_file_stream,
    ingest_page_stream,
    ingest_pages_by_state,
    page_stream,
)
from tests.test_ingest import strict_pages, write

MODEL = hashed_words(16)


def run_files(spark, store, tmp_path, **options):
    stream = file_stream(spark, str(tmp_path / "in"), options.pop("per_trigger", 1))
    query = ingest_file_stream(
        stream, strict_pages(), store, "c", MODEL, str(tmp_path / "offsets"), **options
    )
    query.awaitTermination()
    return query


def documents(store):
    return sorted(r.document for r in store.rows("c").select("document").collect())


@pytest.mark.parametrize("per_trigger", [1, 2, 50])
def test_growing_folder(spark, store, tmp_path, per_trigger):
    write(tmp_path / "in", a_pdf="one", sub__a_PDF="two\fone", skip_txt="no")
    run_files(spark, store, tmp_path, per_trigger=per_trigger)
    assert documents(store) == ["one", "two"]
    write(tmp_path / "in", b_pdf="three\ftwo")
    run_files(spark, store, tmp_path, per_trigger=per_trigger)
    run_files(spark, store, tmp_path, per_trigger=per_trigger)
    assert documents(store) == ["one", "three", "two"]


def test_failed_file_stops_the_stream_and_is_taken_again(spark, store, tmp_path):
    write(tmp_path / "in", bad_pdf="broken")
    with pytest.raises(StreamingQueryException, match="no page tree"):
        run_files(spark, store, tmp_path)
    write(tmp_path / "in", bad_pdf="repaired")
    run_files(spark, store, tmp_path)
    assert documents(store) == ["repaired"]


def test_failures_folder(spark, store, tmp_path):
    write(tmp_path / "in", bad_pdf="broken", a_pdf="one")
    run_files(spark, store, tmp_path, per_trigger=5, failures=str(tmp_path / "failed"))
    assert documents(store) == ["one"]
    failed = spark.read.parquet(str(tmp_path / "failed")).collect()
    assert len(failed) == 1 and "no page tree" in failed[0].error


def test_batch_that_runs_again_replaces_its_rows(spark, small, tmp_path):
    """A crash after the write and before the commit: same micro-batch, same rows."""
    store = CollectionStore(spark, str(tmp_path / "store"))
    data = pages(spark, small)
    first = insert_publications(data, store, "c", MODEL, "pages-000000000")
    again = insert_publications(data, store, "c", MODEL, "pages-000000000")
    assert first == again and store.count("c") == first.new_chunks


def test_stream_equals_batch(spark, small, tmp_path):
    streamed, whole = (CollectionStore(spark, str(tmp_path / n)) for n in ("s", "w"))
    everything = pages(spark, small)
    insert_publications(everything, whole, "c", MODEL)
    for half in (0, 1):
        part = everything.filter(F.col("page_no") % 2 == half)
        part.repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        stream = page_stream(spark, str(tmp_path / "in"), 2)
        ingest_page_stream(
            stream, streamed, "c", MODEL, str(tmp_path / "offsets")
        ).awaitTermination()
    a, b = (s.rows("c").select("uuid", "document") for s in (streamed, whole))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_two_streams_keep_each_others_rows(spark, store, tmp_path):
    for name in ("one", "two"):
        rows = spark.createDataFrame([(name, 0, f"text {name}")], "title string, page_no long, content string")
        rows.write.parquet(str(tmp_path / name))
        stream = page_stream(spark, str(tmp_path / name))
        ingest_page_stream(stream, store, "c", MODEL, str(tmp_path / f"offsets-{name}")).awaitTermination()
    assert documents(store) == ["text one", "text two"]


def test_empty_and_failed_files_are_reported(spark, store, tmp_path):
    write(tmp_path / "in", a_pdf="one\f \ftwo", empty_pdf="", bad_pdf="broken")
    report, failed = str(tmp_path / "report"), str(tmp_path / "failed")
    for _ in range(2):
        run_files(spark, store, tmp_path, report=report, failures=failed)
        rows = spark.read.parquet(report).collect()
        found = {r.source.rsplit("/", 1)[1]: (r.length, r.n_pages, r.n_blank, r.error) for r in rows}
        assert found == {"a.pdf": (9, 3, 1, None), "empty.pdf": (0, 1, 1, None), "bad.pdf": (6, 0, 0, "ValueError: no page tree")}
    assert documents(store) == ["one", "two"] and len(rows) == 3


def test_file_that_is_gone_is_an_error(spark, store, tmp_path):
    from quireworks.sources.files import decode_pages, utf8_pages
    from quireworks.sources.listing import with_contents

    (tmp_path / "a.txt").write_text("one")
    paths = [(str(tmp_path / name), 7) for name in ("a.txt", "gone.txt")]
    pages_ = decode_pages(with_contents(spark.createDataFrame(paths, "path string, batch_no long")), utf8_pages())
    rows = {r.title: r for r in pages_.collect()}
    assert rows["a.txt"].content == "one" and rows["a.txt"].error is None and rows["a.txt"].batch_no == 7
    assert rows["gone.txt"].content is None and "FileNotFoundError" in rows["gone.txt"].error


def test_state_equals_the_lookup(spark, small, tmp_path):
    """Two deliveries with a restart between; the second holds texts of the first."""
    stated, looked = (CollectionStore(spark, str(tmp_path / n)) for n in ("s", "l"))
    everything = pages(spark, small)
    for part in (everything.filter("page_no % 2 = 0"), everything):
        part.write.mode("append").parquet(str(tmp_path / "in"))
        for store, start, offsets in ((stated, ingest_pages_by_state, "a"), (looked, ingest_page_stream, "b")):
            stream = page_stream(spark, str(tmp_path / "in"), 2)
            start(stream, store, "c", MODEL, str(tmp_path / offsets)).awaitTermination()
    a, b = (s.rows("c").select("uuid", "document") for s in (stated, looked))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() > 0


def test_listing_serves_micro_batches_until_it_is_used_up(tmp_path):
    import os
    import time

    from quireworks.sources.listing import ListingStreamReader

    def add(name, at):
        (tmp_path / name).write_text(name)
        os.utime(tmp_path / name, (at, at))

    for i in range(6):
        add(f"{i}.txt", 1000 + i // 2)
    reader, listings = ListingStreamReader({"path": str(tmp_path), "files": "2"}), []
    real = reader._after
    reader._after = lambda start: (listings.append(start), real(start))[1]
    offset, taken = reader.initialOffset(), []
    for _ in range(3):
        rows, offset = reader.read(offset)
        taken += [r[0].rsplit("/", 1)[1] for r in rows]
    assert taken == [f"{i}.txt" for i in range(6)] and len(listings) == 1
    add("b.txt", time.time())  # as young as its listing: not kept beyond one micro-batch
    add("c.txt", time.time() + 60)
    add("a.txt", 2000)
    add("d.txt", time.time() + 60)
    rows, offset = reader.read(offset)
    assert [r[0].rsplit("/", 1)[1] for r in rows] == ["a.txt", "b.txt"] and len(listings) == 2
    add("b2.txt", time.time() + 30)
    rows, offset = reader.read(offset)
    assert [r[0].rsplit("/", 1)[1] for r in rows] == ["b2.txt", "c.txt"] and len(listings) == 3
    rows, offset = reader.read(offset)
    assert [r[0].rsplit("/", 1)[1] for r in rows] == ["d.txt"]
    # Another offset than the last one given is listed anew.
    rows, _ = reader.read(reader.initialOffset())
    assert [r[0].rsplit("/", 1)[1] for r in rows] == ["0.txt", "1.txt"]


def test_micro_batch_takes_few_jobs(spark, store, tmp_path):
    """What a micro-batch costs besides its files is paid for each of hundreds of them."""
    write(tmp_path / "in", **{f"f{i}_pdf": f"text {i}" for i in range(5)})
    query = run_files(spark, store, tmp_path, report=str(tmp_path / "report"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))
    assert documents(store) == [f"text {i}" for i in range(5)]
    assert 5 <= len(jobs) <= 5 * 12


def test_failing_report_stops_the_stream(spark, store, tmp_path):
    write(tmp_path / "in", a_pdf="one")
    (tmp_path / "taken").write_text("no folder")
    with pytest.raises(StreamingQueryException):
        run_files(spark, store, tmp_path, report=str(tmp_path / "taken"))
    run_files(spark, store, tmp_path, report=str(tmp_path / "report"))
    assert documents(store) == ["one"] and spark.read.parquet(str(tmp_path / "report")).count() == 1


def test_stream_listing_is_in_order_and_kept_as_columns(tmp_path):
    import os

    from quireworks.sources.listing import ListingStreamReader

    for i in range(40):
        (tmp_path / f"d{i % 4}").mkdir(exist_ok=True)
        name = tmp_path / f"d{i % 4}" / f"\u00e4{i}.txt"
        name.write_text("x" * i)
        os.utime(name, (1000 + i % 3, 1000 + i % 3))
    reader = ListingStreamReader({"path": str(tmp_path), "files": "7", "glob": "*.txt"})
    offset, taken = reader.initialOffset(), []
    for _ in range(6):
        start = offset
        rows, offset = reader.read(start)
        rows = list(rows)
        assert rows == list(reader.readBetweenOffsets(start, offset))
        taken += rows
    assert reader.kept.num_rows == 0 and reader.kept.column_names == ["modified", "path", "length"]
    assert [(r[2].timestamp(), r[0]) for r in taken] == sorted((r[2].timestamp(), r[0]) for r in taken)
    assert len({r[0] for r in taken}) == 40 and sum(r[1] for r in taken) == sum(range(40))
    assert reader.read(offset)[1] == offset
