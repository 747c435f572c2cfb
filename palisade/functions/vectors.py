"""Similarity of two vector columns, JVM-side: for pairs that already share a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(a: Column, b: Column, term) -> Column:
    products = F.zip_with(a, b, lambda x, y: term(x.cast("double"), y.cast("double")))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(a, b, lambda x, y: x * y)


def squared_l2(a: Column, b: Column) -> Column:
    return _total(a, b, lambda x, y: (x - y) * (x - y))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), norms))
