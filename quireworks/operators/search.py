"""Exact cosine top-k over a table of vectors.

Every vector is scored against every query inside a task, as a matrix product over
Arrow batches, and a task keeps k rows per query. What is shuffled is the shortlist
(tasks x queries x k rows), never the scored pairs.

Up to a stated number of bytes the queries are broadcast and the vectors are scanned where
they lie. A larger set of queries is cut into blocks, as are the vectors, and a join on
block numbers brings each block of queries to each block of vectors: the queries then
never pass the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quireworks.functions.keys import hit_title
from quireworks.functions.vectors import DISTANCE_DIGITS
from quireworks.session import delete_path, ensure_checkpoint_dir, materialize

# Fixed value: hits per query unless the caller says otherwise.
TOP_K = 5
# Query vectors are broadcast in waves of about so many bytes; each wave scans the vectors.
MAX_QUERY_BYTES = 64 << 20
# A set of queries of more waves than this is joined by blocks.
MAX_WAVES = 8
# Bytes of the vectors of a block, about: a pair of blocks is one row of an Arrow batch.
BLOCK_BYTES = 24 << 20
QUERY_BLOCK_BYTES = 4 << 20
# Rows of shortlists that a task holds before it sends them on.
_HELD_ROWS = 1_000_000
# A larger table is read by this many tasks, several splits each: every task sends k rows
# per query, so more tasks would mean a larger shuffle.
MAX_TASKS = 20_000
_SCORES_PER_STEP = 4 << 20  # doubles: 32 MB
# Hit lists up to this many rows are broadcast to fetch their texts.
MAX_BROADCAST_HITS = 200_000


def _unit_rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list<float> column as a matrix of rows of length 1; rows of zeros become NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors of different lengths in one table")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(len(column), -1 if len(column) else 0)
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    with np.errstate(invalid="ignore", divide="ignore"):
        return matrix / norms[:, None]


def _nearest(distances: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k smallest values per column; of equal values the upper rows."""
    if len(distances) <= k:
        return np.nonzero(np.ones(distances.shape, dtype=bool))
    kth = np.partition(distances, k - 1, axis=0)[k - 1]
    keep, ties = distances < kth, distances == kth
    missing = k - keep.sum(axis=0)
    crowded = np.nonzero(ties.sum(axis=0) > missing)[0]
    ties[:, crowded] &= np.cumsum(ties[:, crowded], axis=0) <= missing[crowded]
    return np.nonzero(keep | ties)


def _shortlist(block: pa.Table, queries: np.ndarray, k: int, bound: np.ndarray) -> pa.Table:
    """The rows of one block that can be among the k nearest of a query.

    ``bound`` has per query the distance of its k-th best row so far: after the first
    block nearly every pair fails one comparison with it. Columns of a block: id, vector,
    further ones to keep; the result has ``_q`` and ``distance`` for the vector.
    """
    id_col, vector_col = block.column_names[:2]
    order = pc.sort_indices(block[id_col])  # so that the smaller id wins a tie
    units = _unit_rows(block[vector_col])[order.to_numpy()]
    kept = block.drop_columns([vector_col]).take(order)
    if units.shape[1] != queries.shape[1]:
        raise ValueError(f"queries of length {queries.shape[1]}, vectors of {units.shape[1]}")
    least = 1.0 - bound - 10.0**-DISTANCE_DIGITS
    undefined = bool(np.isnan(units[:, 0]).any() or np.isnan(queries[:, 0]).any())
    step = max(1, _SCORES_PER_STEP // len(units))
    rows, cols, dist = [], [], []
    for at in range(0, len(queries), step):
        dots = units @ queries[at : at + step].T
        if undefined:
            dots[np.isnan(dots)] = -np.inf
        row, col = np.nonzero(dots >= least[at : at + step])
        if len(row) > 4 * k * dots.shape[1]:
            row, col = _nearest(np.round(1.0 - dots, DISTANCE_DIGITS), k)
        rows.append(row)
        cols.append(col + at)
        # Adding zero turns a negative zero into a plain one.
        dist.append(np.round(1.0 - dots[row, col], DISTANCE_DIGITS) + 0.0)
    picked = kept.take(pa.array(np.concatenate(rows)))
    picked = picked.append_column("_q", pa.array(np.concatenate(cols)))
    return picked.append_column("distance", pa.array(np.concatenate(dist)))


def _best(shortlist: pa.Table, k: int, bound: np.ndarray) -> pa.Table:
    """The k nearest rows per query of a shortlist; lowers ``bound`` where k are held."""
    keys = [(name, "ascending") for name in ("_q", "distance", shortlist.column_names[0])]
    ordered = shortlist.sort_by(keys)
    q, distance = ordered["_q"].to_numpy(), ordered["distance"].to_numpy()
    place = np.arange(len(q)) - np.searchsorted(q, q)
    last = place == k - 1
    bound[q[last]] = distance[last]
    return ordered.filter(pa.array(place < k))


def _emit(best: pa.Table, query_ids: pa.Array, names: Sequence[str]) -> pa.Table:
    """Query ids for positions, nulls for undefined distances, columns in output order."""
    distance = best["distance"].to_numpy()
    columns = {name: best[name] for name in best.column_names}
    columns["query_id"] = query_ids.take(best["_q"].combine_chunks())
    columns["distance"] = pa.array(distance, mask=np.isinf(distance))
    return pa.table({name: columns[name] for name in names})


def _scan(query_ids: pa.Array, queries: np.ndarray, k: int, names: Sequence[str]):
    """Partition function: stream the batches, hold k rows per query."""

    def nearest_in_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, held = queries.value if hasattr(queries, "value") else queries, None
        bound = np.full(len(units), np.inf)
        for batch in batches:
            if batch.num_rows == 0 or len(units) == 0:
                continue
            found = _shortlist(pa.Table.from_batches([batch]), units, k, bound)
            held = _best(found if held is None else pa.concat_tables([held, found]), k, bound)
        if held is not None:
            yield from _emit(held, query_ids, names).to_batches()

    return nearest_in_partition


def _scan_pairs(k: int, names: Sequence[str]):
    """Partition function over pairs of blocks (``queries`` and ``vectors``, arrays of structs).

    Shortlists of a block of queries are merged while the task holds them.
    """

    def nearest_in_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[pa.Array, np.ndarray, np.ndarray, pa.Table | None]] = {}
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for ids, _, _, best in held.values():
                if best is not None:
                    yield from _emit(best, ids, names).to_batches()
            held.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column("query_block")[i].as_py()
                if number not in held:
                    asked = pa.Table.from_struct_array(batch.column("queries")[i].values)
                    units = _unit_rows(asked.column(1))
                    held[number] = asked.column(0).combine_chunks(), units, np.full(len(units), np.inf), None
                ids, units, bound, best = held[number]
                block = pa.Table.from_struct_array(batch.column("vectors")[i].values)
                found = _shortlist(block, units, k, bound)
                merged = _best(found if best is None else pa.concat_tables([best, found]), k, bound)
                held[number] = ids, units, bound, merged
                rows += merged.num_rows - (best.num_rows if best is not None else 0)
                if rows > _HELD_ROWS:
                    yield from flush()
                    rows = 0
        yield from flush()

    return nearest_in_pairs


def _by_blocks(
    vectors: DataFrame, queries: DataFrame, query_bytes: int, k: int, schema: T.StructType, block_bytes: int, query_block_bytes: int
) -> DataFrame:
    """Shortlists of all pairs of blocks. Ids are unique, so their hashes give even blocks."""
    id_col, vector_col = vectors.columns[:2]
    vector_bytes = vectors.agg(F.sum(8 * F.size(vector_col).cast("long"))).first()[0] or 0
    n_blocks, n_query_blocks = max(1, -(-vector_bytes // block_bytes)), max(1, -(-query_bytes // query_block_bytes))
    blocks = (
        vectors.groupBy(F.pmod(F.xxhash64(id_col), F.lit(n_blocks)).alias("block"))
        .agg(F.collect_list(F.struct(*vectors.columns)).alias("vectors"))
    )
    query_blocks = (
        queries.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(n_query_blocks)).alias("query_block"))
        .agg(F.collect_list(F.struct(*queries.columns)).alias("queries"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    )
    pairs = blocks.hint("merge").join(query_blocks, "block").select("query_block", "queries", "vectors")
    return pairs.mapInArrow(_scan_pairs(k, schema.names), schema)


def _hit_schema(vectors: DataFrame, query_id_type: T.DataType) -> T.StructType:
    """query_id, the columns of ``vectors`` but the vector (its second), distance."""
    fields = vectors.schema.fields
    kept = [T.StructField(f.name, f.dataType) for f in [fields[0], *fields[2:]]]
    return T.StructType(
        [T.StructField("query_id", query_id_type), *kept, T.StructField("distance", T.DoubleType())]
    )


def topk_batch(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: Sequence[str] = (),
    query_id_col: str = "query_id",
    query_vector_col: str = "embedding",
    max_query_bytes: int = MAX_QUERY_BYTES,
    max_waves: int = MAX_WAVES,
    block_bytes: int = BLOCK_BYTES,
    query_block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """The k nearest vectors of every query: query_id, rank, id, ``keep``, distance.

    At most ``max_waves`` x ``max_query_bytes`` of query vectors pass the driver, whatever
    their number; a larger set is joined by blocks, and its shortlists are checkpointed.

    Distances are rounded to 12 digits and ties go to the smaller id, so the answer does
    not depend on the partitioning. A zero vector has no cosine: its distance is null and
    sorts last. Ids must be unique; null vectors take no part.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    vectors = vectors.select(id_col, vector_col, *keep).filter(F.col(vector_col).isNotNull())
    queries = queries.select(F.col(query_id_col).alias("query_id"), query_vector_col)
    queries = queries.filter(F.col(query_vector_col).isNotNull())
    schema = _hit_schema(vectors, queries.schema["query_id"].dataType)
    names = schema.names
    # Written once, so that a model that makes the vectors runs once for each query.
    staged, path = materialize(queries, "queries")
    spark = vectors.sparkSession
    found = None
    try:
        size = staged.agg(F.sum(8 * F.size(query_vector_col).cast("long"))).first()[0] or 0
        waves = max(1, -(-size // max_query_bytes))
        if waves > max_waves:
            ensure_checkpoint_dir(spark)
            found = _by_blocks(vectors, staged, size, k, schema, block_bytes, query_block_bytes).checkpoint()
            waves = 0
        wave_of = F.pmod(F.xxhash64("query_id"), F.lit(max(1, waves)))
        for wave in range(waves):
            held = (staged.filter(wave_of == wave) if waves > 1 else staged).toArrow()
            shared = spark.sparkContext.broadcast(_unit_rows(held.column(1)))
            scan = _scan(held.column(0).combine_chunks(), shared, k, names)
            hits = vectors.coalesce(MAX_TASKS).mapInArrow(scan, schema)
            found = hits if found is None else found.unionAll(hits)
    finally:
        delete_path(spark, path)
    nearest = Window.partitionBy("query_id").orderBy(F.col("distance").asc_nulls_last(), id_col)
    ranked = found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", id_col, *keep, "distance")


def topk(
    vectors: DataFrame,
    query: Sequence[float],
    k: int = TOP_K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The k nearest vectors of one query vector: rank, id, ``keep``, distance."""
    vectors = vectors.select(id_col, vector_col, *keep).filter(F.col(vector_col).isNotNull())
    schema = _hit_schema(vectors, T.LongType())
    names = schema.names
    units = _unit_rows(pa.array([list(query)], pa.list_(pa.float64())))
    scan = _scan(pa.array([0], pa.int64()), units, k, names)
    found = vectors.coalesce(MAX_TASKS).mapInArrow(scan, schema)
    nearest = [F.col("distance").asc_nulls_last(), F.col(id_col)]
    hits = found.orderBy(*nearest).limit(k)
    # One task ranks the k rows that are left.
    ranked = hits.withColumn("rank", F.row_number().over(Window.orderBy(*nearest)))
    return ranked.select("rank", id_col, *keep, "distance")


def search_hits(
    hits: DataFrame,
    rows: DataFrame,
    on: Sequence[str],
    n_hits: int | None = None,
) -> DataFrame:
    """Hits with the content and title of their rows (``document``, ``cmetadata``).

    The texts are fetched after the ranking, so that only vectors enter the search. A hit
    list of a known bound (``n_hits`` = queries x k) is broadcast, a longer one is joined
    as Catalyst sees fit.
    """
    if n_hits is not None and n_hits <= MAX_BROADCAST_HITS:
        hits = F.broadcast(hits)
    found = rows.select(*on, "document", "cmetadata").join(hits, list(on))
    return found.select(
        *[c for c in ("query_id", "rank") if c in hits.columns],
        hit_title(F.col("cmetadata")).alias("title"),
        F.col("document").alias("content"),
        "distance",
    )
