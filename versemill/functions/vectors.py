"""Expressions on array<float> / array<double> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    squares = F.transform(a, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def squared_distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where either vector has no length."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length).otherwise(F.lit(0.0))


def interpolate(a: Column, b: Column, u: Column) -> Column:
    """a + u·(b − a), element by element."""
    return F.zip_with(
        a, b, lambda x, y: x.cast("double") + u * (y.cast("double") - x.cast("double"))
    )
