import pytest
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


@pytest.fixture(scope="session", autouse=True)
def checkpoints(spark, tmp_path_factory):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


# Extra columns whose names the operators use themselves.
CLASHING = ["score", "size", "kept", "n", "key", "doc", "text_", "copies", "rank", "turn", "_row"]
FIELDS = [
    StructField("doc_id", LongType()),
    StructField("text", StringType()),
    StructField("lang", StringType()),
    StructField("source", StringType()),
    StructField("n_chars", LongType()),
    *(StructField(name, DoubleType()) for name in CLASHING),
]
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
MESSY = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \n\t ", None, "a"),
    (4, "One two three.", "en", None),
    (5, "mail anna.b@example.org or call +1 (415) 555-0134 about 10.0.0.7 now", "en", "b"),
    (5, "mail anna.b@example.org or call +1 (415) 555-0134 about 10.0.0.7 now", "en", "b"),
    (6, LONG, "de", "hot"),
    (7, "the cat sat on the mat and the dog lay by the door of the old house", "fr", "hot"),
    (8, "the cat sat on the mat and the dog lay by the door of the old house", "fr", "hot"),
    (None, "a text without an id that is long enough to have some words in it", "en", "hot"),
    (9, "ünïcödé “quoted” 中文 🙂 text", "es", "hot"),
    (10, "x", "es", "hot"),
]


@pytest.fixture
def documents(spark):
    """Make documents of (doc_id, text[, lang, source]) with columns that clash."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            full.append((doc_id, text, lang, source, len(text or ""), *[0.5] * len(CLASHING)))
        return spark.createDataFrame(full, StructType(FIELDS))

    return make


@pytest.fixture
def messy(documents):
    return documents(MESSY)


@pytest.fixture
def none(documents):
    return documents([])
