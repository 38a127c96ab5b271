"""Vector arithmetic on array columns, for row-wise use.

Joins over many pairs belong in ``operators.similarity``, which works on blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once, so that a lambda below does not evaluate it per element."""
    return F.transform(F.array(value), body)[0]


def dot(left: Column, right: Column) -> Column:
    """Inner product of two arrays of doubles."""
    products = F.zip_with(left, right, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def normalize(vector: Column) -> Column:
    """Unit vector; a zero vector stays as it is."""
    return _let(
        l2_norm(vector),
        lambda norm: F.when(norm == 0, vector).otherwise(
            F.transform(vector, lambda x: x / norm)
        ),
    )


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    scale = l2_norm(left) * l2_norm(right)
    return _let(
        scale, lambda s: F.when(s == 0, F.lit(0.0)).otherwise(dot(left, right) / s)
    )


def has_dimension(dim: int, *vectors: Column) -> Column:
    """True when every vector is present and has ``dim`` elements."""
    checks = [F.coalesce(F.size(v) == dim, F.lit(False)) for v in vectors]
    return F.forall(F.array(*checks), lambda ok: ok)
