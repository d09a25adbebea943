import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quireworks.functions import keys
from quireworks.functions.text import (
    clean_text,
    collapse_whitespace,
    has_nul,
    has_visible_text,
    is_blank,
    reclean_text,
    strip_whitespace,
)


def expected(text):
    """The definition, one step at a time."""
    text = (text or "").replace("\0", "")
    text = re.sub(r"\s+", " ", text)
    return "".join(filter(str.isprintable, text)).strip()


CASES = [
    None,
    "",
    " \t\n ",
    "\u00a0\u2028\u3000",
    "\u200b\ufeff\x07",
    "a \0 b",
    "a \u200b b",
    "a\u0085b\u00a0\u00a0c",
    "\u2028x\u2029y\u202f",
    "\ufeffBOM",
    "smile \U0001f600  end",
    "\x1c\x1d\x1e\x1f edges \x1f",
    "line\r\n\r\nline",
    "nul\0inside",
    "soft\u00adhyphen",
    "\ue000private",
]


def rows(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


def test_clean_text_cases(spark):
    got = rows(spark, CASES).select("i", clean_text(F.col("t")).alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == [expected(t) for t in CASES]


def test_second_cleaning_collapses_what_the_first_left(spark):
    once = clean_text(F.col("t"))
    row = rows(spark, ["a \u200b b"]).select(once.alias("a"), clean_text(once).alias("b")).first()
    assert row == ("a  b", "a b")


def test_every_code_point(spark):
    """Against Python's tables; newer Unicode versions than the JVM's may differ there."""
    points = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, f"a<{chr(c)}>b") for c in points], "c int, t string")
    got = df.select("c", clean_text(F.col("t")).alias("x")).collect()
    wrong = [r.c for r in got if r.x != expected(f"a<{chr(r.c)}>b")]
    import unicodedata

    assert all(unicodedata.category(chr(c)) not in ("Cc", "Cf", "Co", "Zs", "Zl", "Zp") for c in wrong)
    assert len(wrong) < 100


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab. \t\n\0\u200b\u00a0\u2028é", max_size=40), min_size=20, max_size=60))
def test_clean_text_property(spark, texts):
    once = clean_text(F.col("t"))
    got = rows(spark, texts).select(
        "i", once.alias("c"), reclean_text(once).alias("r"), clean_text(once).alias("rr"),
        has_visible_text(F.col("t")).alias("v"),
        strip_whitespace(F.col("t")).alias("s"), is_blank(F.col("t")).alias("b"),
        collapse_whitespace(F.col("t")).alias("w"),
    ).orderBy("i").collect()
    for text, row in zip(texts, got):
        assert row.c == expected(text)
        assert row.r == row.rr
        assert row.v == (row.c != "")
        assert row.s == text.strip()
        assert row.b == (text.strip() == "")
        assert row.w == re.sub(r"\s+", " ", text)


def test_nul_report(spark):
    got = rows(spark, ["a\0b", "ab", None]).select(has_nul(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [True, False, False]


def test_path_parts(spark):
    paths = ["s3://b/x/a.b.txt", "s3a://b/.txt", "/tmp/A.PDF", "s3://b", "x/noext", "d.ir/file."]
    p = F.col("t")
    got = rows(spark, paths).orderBy("i").select(
        keys.path_bucket(p).alias("b"), keys.path_key(p).alias("k"), keys.path_name(p).alias("n"),
        keys.path_stem(p).alias("s"), keys.has_suffix(p, ".pdf").alias("pdf"),
    ).collect()
    assert [tuple(r) for r in got[:2]] == [
        ("b", "x/a.b.txt", "a.b.txt", "a.b", False),
        ("b", ".txt", ".txt", ".txt", False),
    ]
    assert (got[2].s, got[2].pdf) == ("A", True)
    assert (got[3].b, got[3].k) == ("b", "")
    assert (got[4].s, got[5].s) == ("noext", "file")


def test_titles_and_metadata(spark):
    df = spark.createDataFrame([(None, "x"), ("T", "x")], "title string, content string")
    made = keys.title_or_content_id(F.col("title"), F.col("content"))
    got = [r[0] for r in df.select(made).collect()]
    assert got[0].startswith("untitled_2d711642b726b044") and got[1] == "T"
    bare = keys.hit_title(keys.metadata_json(F.col("title")))
    assert [r[0] for r in df.select(bare).collect()] == ["Unknown", "T"]
    pair = keys.title_content_hash(F.lit(" A "), F.lit("\u00a0B\n"))
    assert df.select(pair == F.sha2(F.lit("a::b"), 256)).first()[0]
