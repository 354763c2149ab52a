"""Vector expressions on ``array<float>`` columns, summed in DOUBLE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(vector: Sequence[float]) -> Column:
    """A query vector as a constant array."""
    return F.lit([float(x) for x in vector]).cast("array<double>")


def from_text(value: Column | str) -> Column:
    """``'[1.0,2.0]'`` to a vector; bad text is NULL."""
    return F.from_json(value, "array<float>")


def dot(a: Column, b: Column) -> Column:
    """Dot product; NULL where the lengths differ."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Dot product over both lengths; NULL for a zero vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def cosine_distance(a: Column, b: Column) -> Column:
    """0 for the same direction, 1 for orthogonal, 2 for opposite."""
    return 1 - cosine_similarity(a, b)


def unit(a: Column) -> Column:
    """The vector scaled to length 1, so that later searches need only the dot product."""
    length = F.sqrt(dot(a, a))
    return F.transform(a, lambda x: F.try_divide(x.cast("double"), length))
