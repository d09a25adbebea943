from collections import deque

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quireworks.operators.chunking import (
    SEPARATORS,
    char_windows,
    chunk_documents,
    recursive_chunks,
    split_text,
)


def pieces(text, separator):
    """Cut before each separator, found left to right without overlap."""
    if separator == "":
        return list(text)
    first, *rest = text.split(separator)
    return [p for p in [first] + [separator + r for r in rest] if p]


def brute_force(text, size, overlap, separators):
    """The rule as it is told: collect pieces, emit when full, keep the tail as overlap."""
    separator = next((s for s in separators if s == "" or s in text), separators[-1])
    finer = separators[separators.index(separator) + 1 :]
    out, run = [], []

    def merge():
        window, total = deque(), 0
        for piece in run:
            if total + len(piece) > size and window:
                out.append("".join(window).strip())
                while total > overlap or (total and total + len(piece) > size):
                    total -= len(window.popleft())
            window.append(piece)
            total += len(piece)
        out.append("".join(window).strip())
        run.clear()

    for piece in pieces(text, separator):
        if len(piece) < size:
            run.append(piece)
            continue
        if run:
            merge()
        out.extend(brute_force(piece, size, overlap, finer) if finer else [piece])
    if run:
        merge()
    return [c for c in out if c]


@settings(max_examples=400, deadline=None)
@given(
    st.text(alphabet="ab. \n", max_size=300),
    st.integers(2, 40),
    st.integers(0, 39),
    st.sampled_from([SEPARATORS, (". ", " ", ""), (" ", ""), ("\n\n", " "), ("",), ("x",)]),
)
def test_split_equals_brute_force(text, size, overlap, separators):
    overlap = min(overlap, size - 1)
    assert split_text(text, size, overlap, separators) == brute_force(text, size, overlap, list(separators))


def test_short_text_is_one_chunk():
    assert split_text("a" * 999) == ["a" * 999]
    assert split_text("a" * 1000) == ["a" * 1000]
    assert split_text("One. Two. Three") == ["One. Two. Three"]
    assert split_text("") == [] and split_text(None) == []


def test_windows_without_separators():
    assert [len(c) for c in split_text("a" * 1001)] == [1000, 201]
    assert [len(c) for c in split_text("a" * 1800)] == [1000, 1000]
    assert [len(c) for c in split_text("a" * 1801)] == [1000, 1000, 201]


def test_later_chunks_begin_with_the_separator_and_overlap():
    text = ". ".join(["s" * 98] * 30)
    chunks = split_text(text)
    assert all(len(c) <= 1000 for c in chunks)
    assert all(c.startswith(". ") for c in chunks[1:])
    assert chunks[0][-200:] == chunks[1][:200]


def test_no_overlap_after_a_long_last_piece():
    first, second = "a" * 500 + ". " + "b" * 400, ". " + "c" * 500
    assert split_text(first + second) == [first, second]


def test_long_piece_between_short_ones_starts_a_new_run():
    text = "short. " + "w " * 600 + ". short again"
    chunks = split_text(text)
    assert chunks[0] == "short" and chunks[-1] == ". short again"


def test_three_newlines():
    size3 = split_text("aa\n\n\nbb", 4, 0)
    assert size3 == brute_force("aa\n\n\nbb", 4, 0, list(SEPARATORS))


def test_column_and_windows_equal_python(spark):
    texts = ["x" * n for n in (0, 1, 999, 1000, 1001, 1800, 1801, 2600, 2601)]
    texts += ["é\U0001f600" * 1300, ("word " * 500).strip(), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select(
        recursive_chunks(F.col("t")).alias("c"), char_windows(F.col("t")).alias("w")
    ).collect()
    for text, row in zip(texts, got):
        assert row.c == split_text(text)
        windows = split_text(text, separators=("",))
        assert row.w == windows


def test_windows_of_other_sizes(spark):
    df = spark.createDataFrame([("abcdefghij" * 7,)], "t string")
    for size, overlap in ((10, 0), (10, 3), (10, 7), (9, 8), (200, 5)):
        row = df.select(char_windows(F.col("t"), size, overlap).alias("w")).first()
        assert row.w == split_text("abcdefghij" * 7, size, overlap, ("",)), (size, overlap)


def test_chunk_documents_drops_empty_and_numbers_from_zero(spark):
    df = spark.createDataFrame(
        [("A", 0, "\u200b \0"), ("A", 1, "w " * 900), ("B", 0, None)],
        "title string, page_no int, content string",
    )
    got = chunk_documents(df).orderBy("chunk_idx").collect()
    assert [r.chunk_id for r in got] == ["A_0", "A_1"]
    assert {r.page_no for r in got} == {1}


def test_raw_text_is_cut_at_newlines(spark):
    text = "p" * 600 + "\n\n" + "q" * 600
    df = spark.createDataFrame([("A", text)], "title string, content string")
    got = [r.content for r in chunk_documents(df, clean_first=False).collect()]
    assert got == ["p" * 600, "q" * 600]
    cleaned = [len(r.content) for r in chunk_documents(df).collect()]
    assert cleaned == [600, 600]


def test_result_does_not_depend_on_partitions(spark, small):
    from quireworks.plans.ingest import hashed_chunks
    from quireworks.registry.core import pages

    one = hashed_chunks(pages(spark, small).coalesce(1))
    many = hashed_chunks(pages(spark, small).repartition(13))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_a_batch_is_cut_in_slices_bounded_by_bytes():
    import pyarrow as pa

    from quireworks.operators.chunking import text_slices

    texts = pa.array(["a" * 40, None, "", "b" * 300, "ü" * 60, "c" * 30, "d", None])
    for most in (1, 100, 10_000):
        parts = list(text_slices(texts, most))
        assert pa.concat_arrays(parts).equals(texts)
        for part in parts:  # without its last row a slice is below the bound
            assert sum(len((t or "").encode()) for t in part.to_pylist()[:-1]) <= most
    assert len(list(text_slices(texts, 100))) == 3 and list(text_slices(texts.slice(0, 0), 1)) == []
