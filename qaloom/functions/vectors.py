"""Dense vector expressions over ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Dot product; null when either vector is missing or the lengths differ."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_normalise(a: Column) -> Column:
    """Unit-length vector; null for a zero vector."""
    norm = F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, F.transform(a, lambda x: x.cast("double") / norm))
