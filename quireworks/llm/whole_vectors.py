"""Vectors of whole numbers, which several operators score exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LONGEST = float(1 << 61)  # of a vector's product with itself: sums and differences of two stay below 2**63


def finite(vector: Column) -> Column:
    """Neither null nor holding a null or not finite component; never null itself."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def floored(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x, as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def short_enough(vector: Column, scale: int, longest: float = LONGEST) -> Column:
    """Whether products of the floored vector with others like it fit in a long."""
    squares = F.aggregate(
        vector, F.lit(0.0), lambda total, x: total + F.pow(F.abs(x.cast("double")) * F.lit(float(scale)) + 1, F.lit(2))
    )
    return squares < longest


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The rows of a list column without nulls as whole numbers."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)
