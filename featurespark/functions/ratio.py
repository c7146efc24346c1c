"""Ratio columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_TYPE = "decimal(4,3)"


def ratio_3(hits: Column, at_bats: Column) -> Column:
    """hits / at_bats as DECIMAL(4,3), rounded half up in integer arithmetic.

    0 where at_bats = 0; NULL where at_bats is NULL or negative.
    """
    h, n = hits.cast("bigint"), at_bats.cast("bigint")
    thousandths = F.floor(F.try_divide((h * 2000 + n).cast("decimal(38,0)"), n * 2))
    value = (thousandths.cast("decimal(10,0)") * F.lit(Decimal("0.001"))).cast(RATIO_TYPE)
    return F.when(at_bats > 0, value).when(at_bats == 0, F.lit(0).cast(RATIO_TYPE))


def plain_ratio(hits: Column, at_bats: Column) -> Column:
    """hits / at_bats as double; NULL where at_bats is 0 or NULL."""
    return F.try_divide(hits.cast("double"), at_bats.cast("double"))
