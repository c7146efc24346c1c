"""The tables behind charts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurespark.functions.bins import bin_left_closed, edges
from featurespark.operators.msd import column_ranges
from featurespark.operators.profile import QUARTILES
from featurespark.operators.quantiles import join_null_safe, wide_quantiles
from featurespark.session import bounded_side


def scatter_points(df: DataFrame, x: str, y: str, keep: Sequence[str] = ()) -> DataFrame:
    """All points."""
    return df.select(*keep, F.col(x).alias("x"), F.col(y).alias("y"))


def scatter_sample(df: DataFrame, key: str, x: str, y: str, n: int = 1000) -> DataFrame:
    """``n`` points, the same in every run: the first by the md5 of a unique key."""
    points = scatter_points(df, x, y, [key])
    return points.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def _grid(
    df: DataFrame, column: str, n_bins: int, ranges: dict | None = None
) -> tuple[Column, list[float]]:
    ranges = ranges or column_ranges(df, [column])[1]
    if ranges[column]["lo"] is None:
        return F.lit(None).cast("int"), []
    cuts = edges(ranges[column]["lo"], ranges[column]["hi"], n_bins)
    return bin_left_closed(F.col(column).cast("double"), cuts), cuts


def violin_quartiles(df: DataFrame, by: str, value: str) -> DataFrame:
    """Five numbers per group."""
    return wide_quantiles(df, value, QUARTILES, [by])


def violin_shape(df: DataFrame, by: str, value: str, n_bins: int = 20) -> DataFrame:
    """Per group, a histogram ``bin, n, density`` on one grid for all groups."""
    index, cuts = _grid(df, value, n_bins)
    counts = (
        df.select(by, index.alias("bin"))
        .where(F.col("bin").isNotNull())
        .groupBy(by, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most n_bins rows per group are left here.
    total = F.sum("n").over(Window.partitionBy(by))
    width = (cuts[-1] - cuts[0]) / n_bins if cuts else 0.0
    return counts.withColumn("density", F.try_divide(F.col("n") / total, F.lit(width)))


def violin_curve(df: DataFrame, by: str, value: str, n_points: int = 64) -> DataFrame:
    """Per group a Gaussian kernel density ``point, x, density`` on one grid for all groups.

    Values are shared out between the two grid points around them (linear binning), and the kernel
    runs over grid points only: 1.06 times the group's standard deviation times n to the power of
    -1/5 is its bandwidth. Missing values are left out; a group without spread has null densities.
    """
    v = F.col(value).cast("double")
    known = df.select(by, v.alias("_v")).where(v.isNotNull() & ~F.isnan(v))
    span = known.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    lo, step = span["lo"], (span["hi"] - span["lo"]) / (n_points - 1)
    place = F.try_divide(F.col("_v") - lo, step)
    left = F.least(F.floor(F.coalesce(place, F.lit(0.0))), F.lit(n_points - 2))
    share = F.coalesce(place, F.lit(0.0)) - left
    ends = F.array(
        F.struct(left.alias("point"), (1 - share).alias("weight")),
        F.struct((left + 1).alias("point"), share.alias("weight")),
    )
    binned = known.select(by, F.inline(ends)).groupBy(by, "point").agg(F.sum("weight").alias("weight"))
    moments = known.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("_v").alias("deviation")
    )
    width = 1.06 * F.col("deviation") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    moments = bounded_side(moments.select(by, "n", F.when(width > 0, width).alias("width")))
    # At most n_points rows of a group are left here, and each meets n_points places.
    other = F.explode(F.sequence(F.lit(0), F.lit(n_points - 1)))
    pairs = join_null_safe(binned, moments, [by]).withColumn("at", other)
    apart = (F.col("at") - F.col("point")) * step / F.col("width")
    kernel = F.col("weight") * F.exp(-apart * apart / 2) / (F.col("n") * F.col("width") * (2 * math.pi) ** 0.5)
    curve = pairs.groupBy(by, "at").agg(F.sum(kernel).alias("density"))
    return curve.select(by, F.col("at").alias("point"), (lo + F.col("at") * step).alias("x"), "density")


def histogram_margins(df: DataFrame, response: str, color: str, n_bins: int = 20) -> DataFrame:
    """:func:`histogram` with the box of its colour beside each bar."""
    boxes = bounded_side(box(df, color, response))
    return join_null_safe(histogram(df, response, color, n_bins), boxes, [color])


def box(df: DataFrame, by: str, value: str) -> DataFrame:
    """Per group: quartiles, IQR, whisker ends within 1.5 IQR, and the points beyond them."""
    q = wide_quantiles(df, value, QUARTILES, [by]).withColumn("iqr", F.col("q3") - F.col("q1"))
    q = bounded_side(q)
    reach = F.lit(1.5) * F.col("iqr")
    v = F.col("_v")
    inside = v.between(F.col("q1") - reach, F.col("q3") + reach)
    points = df.select(by, F.col(value).cast("double").alias("_v")).where(
        v.isNotNull() & ~F.isnan(v)
    )
    stats = [*QUARTILES, "iqr"]
    return (
        join_null_safe(points, q, [by])
        .groupBy(by)
        .agg(
            *(F.first(c).alias(c) for c in stats),
            F.min(F.when(inside, v)).alias("lower_whisker"),
            F.max(F.when(inside, v)).alias("upper_whisker"),
            F.count(F.when(~inside, v)).alias("n_outliers"),
        )
    )


def density_heatmap(
    df: DataFrame, x: str, y: str, x_bins: int | None = 10, y_bins: int | None = 10
) -> DataFrame:
    """``x_cell, y_cell, n``; an axis without bins uses its values as they are."""

    binned = [c for c, n in ((x, x_bins), (y, y_bins)) if n is not None]
    # One pass for the ranges of both axes.
    ranges = column_ranges(df, list(dict.fromkeys(binned)))[1] if binned else {}

    def axis(column: str, n_bins: int | None) -> Column:
        return F.col(column) if n_bins is None else _grid(df, column, n_bins, ranges)[0]

    return (
        df.select(axis(x, x_bins).alias("x_cell"), axis(y, y_bins).alias("y_cell"))
        .groupBy("x_cell", "y_cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def histogram(df: DataFrame, response: str, color: str, n_bins: int = 20) -> DataFrame:
    """``color, bin, height, n``: per bin of the response, its sum and its rows."""
    index, _ = _grid(df, response, n_bins)
    return (
        df.select(color, index.alias("bin"), F.col(response).cast("double").alias("_y"))
        .where(F.col("bin").isNotNull())
        .groupBy(color, "bin")
        .agg(F.sum("_y").alias("height"), F.count(F.lit(1)).alias("n"))
    )


def msd_series(table: DataFrame, mode: str = "reference") -> DataFrame:
    """Binned means against the population mean, for the non-empty bins of a 1-D MSD table.

    Bars stand at the lower edge in ``reference`` mode and at the bin centre in ``standard``.
    """
    center = F.col("lower")
    if mode == "standard":
        center = center + (F.col("upper") - F.col("lower")) / 2
    return table.where(F.col("count") > 0).select(
        "feature",
        "bin",
        F.col("median").alias("x"),
        F.col("bin_mean").alias("y"),
        center.alias("center"),
        "count",
        "pop_mean",
    )
