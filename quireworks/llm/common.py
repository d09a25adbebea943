"""What several operators share: reading, mapping Arrow batches, numbering rows."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quireworks.session import materialize, spread_over_cores

WORD = "[^\\x20\\x09-\\x0D]+"  # fixed by the contracts; bytes.split() cuts at the same six characters
_SLICE = 4 << 20
_FILES = 4
_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, position below


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for work on every character; a small one is dealt over the cores first."""
    return spread_over_cores(table(spark, sf_dir, name))


def as_bytes(text: str) -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def map_batches(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: StructType | str,
    text: str | None = None,
    most: int = _SLICE,
) -> DataFrame:
    """Apply a function to every Arrow batch; None gives no rows. With ``text`` a batch is cut
    into slices of about ``most`` bytes of that column first, which bounds a worker's memory."""
    at = None if text is None else df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in [batch] if at is None else cut(batch, at, most):
                if part.num_rows and (out := work(part)) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def cut(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose byte or text column holds about ``most`` bytes each, never less than a row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    start = before = 0
    while start < batch.num_rows:
        to = min(batch.num_rows, int(np.searchsorted(ends, before + most)) + 1)
        yield batch.slice(start, to - start)
        start, before = to, int(ends[to - 1])


def settled(df: DataFrame) -> DataFrame:
    """Checkpoint rows in a few files for each core at most, however many partitions made them:
    a step of a loop may be small, and its files are not."""
    return df.coalesce(_FILES * df.sparkSession.sparkContext.defaultParallelism).checkpoint()


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps: Spark deletes them with the plans' objects,
    which else wait for the driver to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def with_position(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 0-based position of each row in a global order; see ``with_running_sums``."""
    return with_running_sums(df, order, {name: None})


def with_running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column | None]) -> DataFrame:
    """Add, for each name, the sum of a whole-number column (None: the number) of all rows before
    in a global order.

    The rows are range-partitioned, sorted and written (a second evaluation could draw
    other bounds); each partition sums up its rows, and one row per partition is summed up
    over all: no task sees more than its share, whatever the keys. Equal rows stand next
    to each other in any order.
    """
    name = next(iter(sums))
    at, part = f"_{name}_at", f"_{name}_part"
    rows, _ = materialize(df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()), name)
    rows = rows.withColumn(part, F.shiftright(at, _POSITION_BITS))
    plain = {k: f"_{k}_sum" for k in sums}
    totals = rows.groupBy(part).agg(*(F.sum(F.lit(1) if x is None else x).alias(plain[k]) for k, x in sums.items()))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(x) for x in plain.values()))
    # One row per shuffle partition, so the broadcast has a fixed bound.
    joined = rows.join(F.broadcast(offsets), part)
    within = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    local = F.col(at).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    for k, x in sums.items():
        own = local if x is None else F.coalesce(F.sum(x).over(within), F.lit(0))
        joined = joined.withColumn(k, F.col(plain[k]) + own)
    return joined.drop(at, part, *plain.values())

