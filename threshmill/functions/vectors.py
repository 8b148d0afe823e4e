"""Vectors as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Zero where either vector is zero."""
    n = norm(a) * norm(b)
    return F.when(n == 0, 0.0).otherwise(dot(a, b) / n)


def unit(a: Column) -> Column:
    """Normed vector; a zero vector stays."""
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / F.when(n == 0, 1.0).otherwise(n))


def checked(a: Column, dimension: int) -> Column:
    """Whether a vector has the dimension and only finite numbers."""
    finite = F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce((F.size(a) == dimension) & finite, F.lit(False))
