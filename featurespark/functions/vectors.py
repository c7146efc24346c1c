"""Array-column vector arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(v: Column) -> Column:
    """Unit vector as array<double>; a zero vector stays zero."""
    v = v.cast("array<double>")

    def scaled(norm: Column) -> Column:
        return F.when(norm == 0.0, v).otherwise(F.transform(v, lambda x: x / norm))

    # As the element of an array the norm is computed once a row, not once a component.
    return F.transform(F.array(l2_norm(v)), scaled)[0]
