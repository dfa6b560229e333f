"""Vector arithmetic on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zeros(dims: int) -> Column:
    return F.array_repeat(F.lit(0.0), dims)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; NULL if either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def cosine_plus_one(a: Column, b: Column) -> Column:
    """Cosine shifted to be non-negative, as rescoring needs it."""
    return cosine(a, b) + 1.0


def scaled_sum(a: Column, b: Column, scale: float) -> Column:
    """``scale * a + b``."""
    return F.zip_with(a, b, lambda x, y: F.lit(scale) * x + y)
