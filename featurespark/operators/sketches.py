"""Stored sketches: quantiles of any range of days, and kinds of wide tables in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType

from featurespark.operators import profile
from featurespark.operators.profile import CATEGORICAL, CONTINUOUS

# Size of a KLL sketch. A rank is off by more than RANK_ERROR in far less than one of 100 cases.
KLL_SIZE, RANK_ERROR = 1000, 0.01
# 2**HLL_SIZE registers; an estimate is off by HLL_DEVIATIONS times its relative deviation at most.
HLL_SIZE, HLL_DEVIATIONS = 14, 6
HLL_DEVIATION = 1.04 / 2 ** (HLL_SIZE / 2)


def daily_quantile_sketches(df: DataFrame, columns: Sequence[str], day: str, size: int = KLL_SIZE) -> DataFrame:
    """``feature, day, n, sketch``: a mergeable quantile sketch of each column and day.

    Nulls and NaN are left out; rows without a day have the day null. Meant to be kept as a table.
    """
    long = profile.unpivot(df.withColumn("_day", F.col(day)), columns, ["_day"])
    known = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy("feature", F.col("_day").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch")
    )


def quantiles_of_days(
    sketches: DataFrame, probabilities: Sequence[float], first: Column | None = None, last: Column | None = None
) -> DataFrame:
    """``feature, p, n, value``: quantiles of the days from ``first`` to ``last``, from sketches alone."""
    if first is not None:
        sketches = sketches.where(F.col("day") >= first)
    if last is not None:
        sketches = sketches.where(F.col("day") <= last)
    merged = sketches.groupBy("feature").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    each = F.array(
        *(
            F.struct(F.lit(p).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("value"))
            for p in probabilities
        )
    )
    return merged.select("feature", "n", F.inline(each)).select("feature", "p", "n", "value")


def _countable(df: DataFrame, column: str) -> Column:
    """A column in a form that distinct counts can be sketched of."""
    kind = df.schema[column].dataType
    if isinstance(kind, (IntegerType, LongType, StringType, BinaryType)):
        return F.col(f"`{column}`")
    return F.when(F.col(f"`{column}`").isNotNull(), F.xxhash64(F.col(f"`{column}`")))


def distinct_ranges(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, tuple[float, float]]]:
    """The number of rows, and for each column between which bounds its distinct values lie.

    One pass without expansion or shuffled values; a null counts as a value.
    """
    aggs = [F.count(F.lit(1))]
    for c in columns:
        aggs += [
            F.hll_sketch_estimate(F.hll_sketch_agg(_countable(df, c), F.lit(HLL_SIZE))),
            F.coalesce(F.bool_or(F.col(f"`{c}`").isNull()), F.lit(False)),
        ]
    n, *found = df.agg(*aggs).first()
    ranges = {}
    for c, estimate, has_null in zip(columns, found[::2], found[1::2], strict=True):
        slack = 1 + HLL_DEVIATIONS * HLL_DEVIATION * (estimate or 0)
        ranges[c] = (max(0.0, (estimate or 0) - slack) + has_null, (estimate or 0) + slack + has_null)
    return n, ranges


def column_kinds(df: DataFrame, max_ratio: float = 0.1) -> DataFrame:
    """:func:`profile.column_kinds` by sketches; only columns near the limit are counted exactly."""
    fixed = profile.fixed_kinds(df)
    n, ranges = distinct_ranges(df, [c for c in df.columns if c not in fixed])
    kinds = dict(fixed)
    unsure = []
    for c, (low, high) in ranges.items():
        if high <= max_ratio * n:
            kinds[c] = CATEGORICAL
        elif low > max_ratio * n:
            kinds[c] = CONTINUOUS
        else:
            unsure.append(c)
    if unsure and n:
        exact = profile.column_kinds(df.select(*(F.col(f"`{c}`") for c in unsure)), max_ratio)
        kinds |= {r["column_name"]: r["kind"] for r in exact.collect()}
    rows = [(c, kinds.get(c) if n else None) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, "column_name string, kind string")


def boolean_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """:func:`profile.boolean_columns` by sketches; only columns of few values are read again."""
    columns = list(columns or df.columns)
    _, ranges = distinct_ranges(df, columns)
    few = [c for c in columns if ranges[c][0] <= 2 <= ranges[c][1]]
    found = {}
    if few:
        exact = profile.boolean_columns(df.select(*(F.col(f"`{c}`") for c in few)), few)
        found = {r["column_name"]: r["is_boolean"] for r in exact.collect()}
    rows = [(c, found.get(c, False)) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column_name string, is_boolean boolean")
