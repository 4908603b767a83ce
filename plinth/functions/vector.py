"""Vectors as arrays of numbers: similarity and contrast scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """SF-18; null for a zero vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def contrast(a: Column, b: Column) -> Column:
    """SF-17."""
    return F.try_divide(a - b, a + b + F.lit(1e-6))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
