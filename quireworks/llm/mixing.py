"""Operator 4: mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source expects ``target / source_size`` copies. With the documents
of the source in order of size, the expected copies are summed up, one random offset
per source is added, and a document is emitted once for each whole number that its
interval of the sum crosses. In order of size a source's taken words differ from its
target by about one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quireworks.llm.common import WORD, table, with_position, with_running_sums
from quireworks.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 20240229


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Target words per source: (source, n_docs, source_size, target, first).

    ``sizes`` has (source, size). Sources in code point order, null last, weigh
    ``weights`` in turn and share ``share`` of all words; no target exceeds ``most`` times
    its source, and the excess goes to the others by weight. With sources in order of
    size per weight those at their limit come first, so one running sum finds the level.
    ``first`` numbers the sources' documents: how many stand in the sources before.
    The running sums go by ranges of sources, so there may be as many as documents.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    by_name = F.col("source").asc_nulls_last()
    named = with_running_sums(per, [by_name], {"turn": None, "first": F.col("n_docs")})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("turn") % len(weights) + 1).cast("int"))
    weighed = named.withColumn("weight", weight.cast("long"))
    by_level = [F.col("source_size") / F.col("weight"), by_name]
    ranked = with_running_sums(
        weighed, by_level, {"at": None, "words_before": F.col("source_size"), "weight_before": F.col("weight")}
    )
    total = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    room = F.lit(share) * F.lit(total["words"]) - F.lit(most) * F.col("words_before")
    left = F.lit(total["weight"]) - F.col("weight_before")
    found = ranked.withColumn("room", room).withColumn("left", left)
    # The first source below its limit sets the level for all that follow.
    below = F.col("weight") * F.col("room") / F.col("left") < F.lit(most) * F.col("source_size")
    level = found.filter(below).agg(F.min(F.struct("at", "room", "left")).alias("level")).first()["level"]
    target = F.lit(most) * F.col("source_size")
    if level is not None:
        shared = F.col("weight") * F.lit(level["room"]) / F.lit(level["left"])
        target = F.when(F.col("at") < level["at"], target).otherwise(shared)
    return found.select("source", "n_docs", "source_size", target.alias("target"), "first")


def offset_of(source: Column, seed: int = SEED) -> Column:
    """A random number in [0, 1) of the seed and the source: the same in every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for documents (doc_id, source, text).

    Null text: size 0. Null source: a source of its own, the last. Empty table: no rows.
    Documents without words may get copies, which take no words. Repeated rows count as
    documents of their own. Other columns are ignored.
    """
    sizes = docs.select("doc_id", "source", _size(F.col("text")).alias("size")).checkpoint()
    return _with_copies(sizes, weights, share, most, seed).select(
        "doc_id", "source", "size", "source_size", "target", "copies"
    )


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _with_copies(
    rows: DataFrame, weights: tuple[int, ...], share: float, most: float, seed: int
) -> DataFrame:
    """Add the source's columns and copies to rows of (doc_id, source, size, ...).

    The order is by range of (source, size, doc_id), so a hot source spreads over tasks;
    in the join with the targets adaptive execution splits it.
    """
    order = [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col("doc_id").asc_nulls_last()]
    placed = with_position(rows, order, "idx")
    # One row per source; joined with null sources kept.
    targets = source_targets(placed, weights, share, most).withColumnRenamed("source", "_source")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    rate = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    rank = (F.col("idx") - F.col("first")).cast("double")
    offset = offset_of(F.col("source"), seed)
    crossed = F.floor((rank + 1) * rate + offset) - F.floor(rank * rate + offset)
    # Rounding may not push a document over the whole number above its rate.
    copies = F.least(crossed, F.ceil(rate)).cast("long")
    return joined.withColumn("copies", copies)


def repeat_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
) -> DataFrame:
    """The rows of the mix: each document as often as ``mix_sources`` takes it, all columns kept.

    Rows are numbered as they are written, and only (number, source, size, id) is ordered;
    the copies then join the rows by number. A row gives at most ``most`` rows, rounded up.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"))
    written, _ = materialize(numbered, "mixing-rows")
    sizes = written.select("row", "doc.doc_id", "doc.source", _size(F.col("doc.text")).alias("size"))
    mixed = _with_copies(sizes, weights, share, most, seed).filter("copies > 0").select("row", "copies")
    turns = F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    return written.join(mixed, "row").select("doc", F.explode(turns).alias("turn")).select("doc.*")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of all documents."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


OP4_SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS weight FROM per),
ranked AS (
  SELECT *, row_number() OVER w AS place, sum(source_size) OVER () AS words,
    {SHARE}::DOUBLE * (sum(source_size) OVER ())::DOUBLE
      - {MOST}::DOUBLE * coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS room,
    (sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS remain
  FROM weighed WINDOW w AS (ORDER BY source_size::DOUBLE / weight::DOUBLE, source NULLS LAST)),
level AS (
  SELECT place, room, remain FROM ranked
  WHERE weight::DOUBLE * room / remain < {MOST}::DOUBLE * source_size::DOUBLE ORDER BY place LIMIT 1),
targets AS (
  SELECT r.source, r.source_size,
    CASE WHEN l.place IS NULL OR r.place < l.place THEN {MOST}::DOUBLE * r.source_size::DOUBLE
      ELSE r.weight::DOUBLE * l.room / l.remain END AS target
  FROM ranked r LEFT JOIN level l ON true),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size = 0 THEN 0.0::DOUBLE ELSE t.target / t.source_size::DOUBLE END AS rate,
    (row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS LAST))::DOUBLE AS k,
    CAST('0x' || substr(md5('{SEED}:' || coalesce('s' || s.source, 'n')), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (least(floor(k * rate + u) - floor((k - 1) * rate + u), ceil(rate)))::BIGINT * size AS taken
FROM placed"""
