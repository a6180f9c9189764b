"""Vector arithmetic as column expressions, in double, summed left to right."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERY_EPSILON = 1e-10


def norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def _divided(vector: Column, divisor: Column) -> Column:
    # the repeated array evaluates the divisor once per row, not once per element
    return F.zip_with(
        vector, F.array_repeat(divisor, F.size(vector)), lambda x, d: x.cast("double") / d
    )


def unit_vector(vector: Column) -> Column:
    """vector / norm as ``array<float>``, the stored form; a zero vector stays zero."""
    n = norm(vector)
    return _divided(vector, F.when(n == 0, F.lit(1.0)).otherwise(n)).cast("array<float>")


def unit_query(vector: Column) -> Column:
    """vector / (norm + epsilon) in double, the query form; a zero vector stays zero."""
    return _divided(vector, norm(vector) + F.lit(QUERY_EPSILON))


def relevance(dot: Column) -> Column:
    """Map a cosine in [-1, 1] to a display score in [0, 1] with four decimals."""
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot / 2 + 0.5)), 4)
