"""Expressions on dense vectors in array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Added to norms, so that a zero vector divides.
EPSILON = 1e-8


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / ((norm(a) + EPSILON) * (norm(b) + EPSILON))


def distance(similarity: Column) -> Column:
    return F.lit(1.0) - similarity
