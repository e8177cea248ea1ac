"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_dense(a: Column, b: Column) -> Column:
    """Dot over norms; null when a norm is zero (the quotient is undefined)."""
    scale = norm(a) * norm(b)
    return F.when(scale != 0, dot(a, b) / scale)
