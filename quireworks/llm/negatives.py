"""Operator 11: hard negatives by Four-Russians scoring.

Components are whole numbers. For every eight components of an anchor, a table holds the
sums of all 256 subsets. A candidate is packed into bit planes: for each bit of its
components (two's complement) and each eight of them, one byte that says which have the
bit. A product is then a sum of table entries for each plane, shifted by the plane and
added up, exact in whole numbers.

Candidates lie in packed blocks of bounded size and anchors in chunks; a join on block
numbers brings each chunk to each block, so neither set passes the driver. Every pair is
scored; a block returns only what may be among an anchor's first rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quireworks.llm.common import table
from quireworks.llm.whole_vectors import finite, floored, matrix, short_enough
from quireworks.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LEAST, MOST = 50, 95  # percent of the positive's score
BLOCK_ROWS = 8192  # candidates of a block, about
CHUNK_ROWS = 256  # anchors of a chunk, at most
BLOCK_BYTES = 32 << 20  # whole numbers of a block, about
_STEP = 1024
_SMALL = 1 << 30


def subset_tables(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for eight components at a time, the sum of each subset of them."""
    n, width = anchors.shape
    groups = -(-width // 8)
    padded = np.zeros((n, groups * 8), anchors.dtype)
    padded[:, :width] = anchors
    out = np.zeros((groups, 256, n), anchors.dtype)
    for g in range(groups):
        for bit in range(8):
            out[g, 1 << bit : 2 << bit] = out[g, : 1 << bit] + padded[:, 8 * g + bit]
    return out


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) of bytes; the last plane is that of the sign."""
    most = int(max(rows.max(initial=0), -1 - rows.min(initial=0)))
    planes = most.bit_length() + 1
    out = [np.packbits((rows >> p) & 1, axis=1, bitorder="little").T for p in range(planes)]
    return np.ascontiguousarray(np.stack(out).astype(np.uint8))


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors): the products, by one look-up for each plane and group."""
    n, anchors = planes.shape[2], tables.shape[2]
    total = np.zeros((n, anchors), tables.dtype)
    for at in range(0, n, _STEP):
        part = total[at : at + _STEP]
        found = np.empty_like(part)
        for p in range(len(planes) - 1, -1, -1):
            part <<= 1
            for g in range(len(tables)):
                np.take(tables[g], planes[p, g, at : at + _STEP], axis=0, out=found, mode="clip")
                if p == len(planes) - 1:
                    part -= found
                else:
                    part += found
    return total


def whole_rows(vectors: DataFrame, label: Column, scale: int) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, equal ones once."""
    vector = F.col("embedding")
    good = F.col("vec_id").isNotNull() & label.isNotNull() & finite(vector) & short_enough(vector, scale)
    rows = vectors.filter(good).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), floored(vector, scale).alias("v")
    )
    return rows.dropDuplicates(["vec_id", "label", "v"])


_BLOCKS = "kind string, block long, width int, chunk long, ids binary, labels binary, data binary"


def packed(rows: DataFrame, is_anchor: Column, block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, int]:
    """Candidates packed in blocks (kind c) and anchors in chunks (kind a), written; the number of blocks.

    A block holds the rows of one hash; of each width there is a row, its candidates in
    order of label. Equal rows are merged before, so the hash spreads whatever is left.
    """
    rows, _ = materialize(rows.withColumn("anchor", F.coalesce(is_anchor, F.lit(False))), "negative-rows")
    about = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v").cast("long")).alias("numbers")).first()
    blocks = max(1, -(-about["n"] // block_rows), -(-8 * (about["numbers"] or 0) // BLOCK_BYTES))

    def pack(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        block = group["block"][0].as_py()
        widths = np.asarray(pa.compute.list_value_length(group["v"]))
        out = []
        for width in np.unique(widths):
            part = group.filter(pa.array(widths == width))
            label, ids = part["label"].to_numpy(), part["vec_id"].to_numpy()
            order = np.lexsort((ids, label))
            label, ids = label[order], ids[order]
            values = matrix(part["v"], int(width))[order]
            anchor = np.flatnonzero(part["anchor"].to_numpy(zero_copy_only=False)[order])
            planes = bit_planes(values)
            out.append(("c", block, int(width), None, ids.tobytes(), label.tobytes(), bytes([len(planes)]) + planes.tobytes()))
            for at in range(0, len(anchor), chunk_rows):
                own = anchor[at : at + chunk_rows]
                out.append(("a", block, int(width), (block << 24) + len(out), ids[own].tobytes(), label[own].tobytes(), values[own].tobytes()))
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        names = [x.split()[0] for x in _BLOCKS.split(", ")]
        return pa.table({name: pa.array(c, t) for name, c, t in zip(names, zip(*out), kinds)})

    block = F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)).cast("long")
    grouped = rows.withColumn("block", block).groupBy("block").applyInArrow(pack, _BLOCKS)
    return materialize(grouped, "negative-blocks")[0], blocks


def _longs(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py() or b"", np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(row, anchor ids, labels, tables, candidate ids, labels, planes) of each chunk and block."""
    kept: tuple = (None, None)
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            width = row["width"].as_py()
            ids, labels = _longs(row["ids"]), _longs(row["labels"])
            data = np.frombuffer(row["data"].as_py(), np.uint8)
            planes = data[1:].reshape(data[0], -(-width // 8), len(ids))
            anchor_ids, anchor_labels = _longs(row["anchor_ids"]), _longs(row["anchor_labels"])
            if kept[0] != row["chunk"].as_py():
                values = _longs(row["anchors"]).reshape(len(anchor_ids), width)
                small = width * int(np.abs(values).max(initial=0)) << len(planes) < _SMALL
                kept = row["chunk"].as_py(), (values, subset_tables(values.astype(np.int32)) if small else None)
            values, tables = kept[1]
            if tables is None or width * int(np.abs(values).max(initial=0)) << len(planes) >= _SMALL:
                tables = subset_tables(values)
            yield row, anchor_ids, anchor_labels, tables, ids, labels, planes


def _first_of_label(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The best rows of each anchor's own label, its own id left out."""
    for row, anchor_ids, anchor_labels, tables, ids, labels, planes in _pairs(batches):
        out: list[tuple] = []
        for label in np.unique(anchor_labels):
            lo, hi = np.searchsorted(labels, [label, label + 1])
            own = np.flatnonzero(anchor_labels == label)
            if lo == hi:
                continue
            found = scores(np.ascontiguousarray(tables[:, :, own]), planes[:, :, lo:hi])
            for column, i in enumerate(own):
                near, names = found[:, column], ids[lo:hi]
                others = names != anchor_ids[i]
                near, names = near[others], names[others]
                if len(near) > most:
                    good = near >= np.partition(near, len(near) - most)[len(near) - most]
                    near, names = near[good], names[good]
                for j in np.lexsort((names, -near.astype(np.int64)))[:most]:
                    out.append((row["chunk"].as_py(), int(i), int(names[j]), int(near[j])))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int32(), pa.int64(), pa.int64()])],
                names=["chunk", "i", "positive_id", "positive_score"],
            )


def _first_between(batches: Iterator[pa.RecordBatch], most: int, least: int, top: int) -> Iterator[pa.RecordBatch]:
    """For each anchor and positive, the best rows of other labels within the bounds."""
    names = ["chunk", "anchor_id", "i", "p", "positive_id", "positive_score", "negative_id", "negative_score"]
    for row, anchor_ids, anchor_labels, tables, ids, labels, planes in _pairs(batches):
        wanted: dict[int, list[tuple]] = {}
        for x in row["positives"].as_py():
            low, high = -((-least * x["positive_score"]) // 100), top * x["positive_score"] // 100
            if low <= high:
                wanted.setdefault(x["i"], []).append((x["p"], x["positive_id"], x["positive_score"], low, high))
        own = np.array(sorted(wanted), np.int64)
        if not len(own):
            continue
        found = scores(np.ascontiguousarray(tables[:, :, own]), planes)
        lowest = np.array([min(x[3] for x in wanted[i]) for i in own])
        highest = np.array([max(x[4] for x in wanted[i]) for i in own])
        hit = (found >= lowest) & (found <= highest)
        for column, i in enumerate(own):
            lo, hi = np.searchsorted(labels, [anchor_labels[i], anchor_labels[i] + 1])
            hit[lo:hi, column] = False
        out: list[tuple] = []
        for column, i in enumerate(own):
            at = np.flatnonzero(hit[:, column])
            down = -found[at, column].astype(np.int64)
            order = np.lexsort((ids[at], down))
            at, down = at[order], down[order]
            for p, positive_id, score, low, high in wanted[i]:
                begin, end = np.searchsorted(down, -high), np.searchsorted(down, -low, "right")
                for j in range(begin, min(end, begin + most)):
                    out.append(
                        (row["chunk"].as_py(), int(anchor_ids[i]), int(i), p, positive_id, score, int(ids[at[j]]), -int(down[j]))
                    )
        if out:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has (vec_id, embedding) and what ``is_anchor`` and ``label`` read; other
    columns are ignored. Rows with a null id, label or vector, with null or not finite
    components, or so long that products aren't longs, take no part. Vectors meet only those
    of their own width. Rows equal in id, label and whole numbers count once; rows that
    repeat an id otherwise are anchors and candidates each, but none is a positive of its
    own id. Without anchors, positives or negatives there are no rows.
    """
    rows = whole_rows(vectors, label, scale)
    blocks, count = packed(rows, is_anchor, block_rows, chunk_rows)
    candidates = blocks.filter("kind = 'c'").select("block", "width", "ids", "labels", "data")
    anchors = blocks.filter("kind = 'a'").select(
        "width", "chunk", F.col("ids").alias("anchor_ids"), F.col("labels").alias("anchor_labels"), F.col("data").alias("anchors")
    )

    def meet(chunks: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias("block")
        return chunks.select("*", every).join(candidates, ["block", "width"])

    near = meet(anchors).mapInArrow(
        lambda batches: _first_of_label(batches, positives), "chunk long, i int, positive_id long, positive_score long"
    )
    best = Window.partitionBy("chunk", "i").orderBy(F.desc("positive_score"), "positive_id")
    first = near.withColumn("p", F.row_number().over(best)).filter(F.col("p") <= positives)
    # At most ``positives`` for each of a chunk's anchors.
    listed = first.groupBy("chunk").agg(F.collect_list(F.struct("i", "p", "positive_id", "positive_score")).alias("positives"))
    listed, _ = materialize(listed, "negative-positives")
    between = meet(anchors.join(listed, "chunk")).mapInArrow(
        lambda batches: _first_between(batches, negatives, least, most),
        "chunk long, anchor_id long, i int, p int, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    order = Window.partitionBy("chunk", "i", "p").orderBy(F.desc("negative_score"), "negative_id")
    return (
        between.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The negatives of every row whose vec_id 50 divides; each label moves on where 7 does."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


OP11_SQL = f"""
WITH r AS MATERIALIZED (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
a AS (SELECT row_number() OVER () AS n, * FROM r WHERE vec_id % 50 = 0),
pairs AS (
  SELECT a.n, a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
    coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])), 0)::BIGINT AS score
  FROM a JOIN r c ON len(a.v) = len(c.v)),
positives AS (
  SELECT n, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS p
  FROM pairs WHERE same AND vec_id <> anchor_id QUALIFY p <= {POSITIVES})
SELECT p.anchor_id, p.positive_id, q.vec_id AS negative_id, p.positive_score, q.score AS negative_score,
  (row_number() OVER (PARTITION BY p.n, p.p ORDER BY q.score DESC, q.vec_id))::INTEGER AS rank
FROM positives p JOIN pairs q ON q.n = p.n AND NOT q.same
  AND {LEAST} * p.positive_score <= 100 * q.score AND 100 * q.score <= {MOST} * p.positive_score
QUALIFY rank <= {NEGATIVES}"""
