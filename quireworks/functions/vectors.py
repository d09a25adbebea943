"""Vector arithmetic as column expressions, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Distances are compared at this precision, so that equal vectors tie (and the id
# decides) whatever order a sum was taken in.
DISTANCE_DIGITS = 12


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cos(a, b); null where a vector is all zeros (the cosine is undefined there)."""
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * norm(b))
