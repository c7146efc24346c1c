"""Univariate linear and logistic regression statistics, all predictors in one pass."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurespark.functions.pvalues import normal_two_sided, scientific_text, t_pvalue
from featurespark.operators.assoc import batches, union_all

LOGIT_SCHEMA = (
    "feature string, n bigint, intercept double, slope double, "
    "z_value double, p_value double, converged boolean"
)


def _number(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def ols_per_feature(df: DataFrame, response: str, predictors: Sequence[str]) -> DataFrame:
    """``feature, n, slope, intercept, r2, t_value``; rows missing x or y are left out."""
    parts = []
    for chunk in batches(list(predictors)):
        names = {c: f"_x{i}" for i, c in enumerate(chunk)}
        data = df.select(
            _number(response).alias("_y"), *(_number(c).alias(x) for c, x in names.items())
        )
        fits = []
        for c, name in names.items():
            x, y = F.col(name), F.when(F.col(name).isNotNull(), F.col("_y"))
            x = F.when(F.col("_y").isNotNull(), x)
            fits.append(
                F.struct(
                    F.lit(c).alias("feature"),
                    F.count(x).alias("n"),
                    F.avg(x).alias("mean_x"),
                    F.avg(y).alias("mean_y"),
                    F.var_pop(x).alias("sxx"),
                    F.var_pop(y).alias("syy"),
                    F.covar_pop(x, y).alias("sxy"),
                )
            )
        parts.append(data.agg(F.array(*fits).alias("fits")).select(F.inline("fits")))
    fit = union_all(parts)
    slope = F.try_divide("sxy", "sxx")
    explained = slope * F.col("sxy")
    variance = F.try_divide(F.greatest(F.col("syy") - explained, F.lit(0.0)), F.col("n") - 2)
    error = F.sqrt(F.try_divide(variance, F.col("sxx")))
    return fit.select(
        "feature",
        "n",
        slope.alias("slope"),
        (F.col("mean_y") - slope * F.col("mean_x")).alias("intercept"),
        F.try_divide(explained, "syy").alias("r2"),
        F.when(F.col("n") > 2, F.try_divide(slope, error)).alias("t_value"),
    )


def with_ols_pvalues(fits: DataFrame) -> DataFrame:
    """Add the two-sided p-value; evaluated on one row per predictor."""
    return fits.withColumn("p_value", t_pvalue("t_value", (F.col("n") - 2).cast("double")))


def formatted_stats(fits: DataFrame) -> DataFrame:
    """``feature``, the statistic rounded to 4 digits and p as ``%.6e`` text."""
    stat = "t_value" if "t_value" in fits.columns else "z_value"
    return fits.select(
        "feature",
        F.round(stat, 4).alias(stat),
        scientific_text("p_value").alias("p_value"),
    )


def ols_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept and R squared of the trend line on a scatter of x and y."""
    return ols_per_feature(df, y, [x]).select("feature", "slope", "intercept", "r2")


def logit_per_feature(
    df: DataFrame,
    response: str,
    predictors: Sequence[str],
    max_iter: int = 35,
    tolerance: float = 1e-8,
) -> DataFrame:
    """One logistic regression with intercept per predictor, for a 0/1 response.

    Rows missing the response or the predictor (null or NaN) are left out of a fit. Any other
    response raises.

    Newton's method for all predictors together: an iteration is one aggregation over the
    table, and five sums per predictor reach the driver. Predictors without a finite maximum
    (perfect separation, a constant) come back with ``converged`` false and no statistics.
    """
    y = F.col("_y")
    names = {c: f"_x{i}" for i, c in enumerate(predictors)}
    data = df.select(
        _number(response).alias("_y"), *(_number(c).alias(x) for c, x in names.items())
    )
    # Only the columns of the fits are kept, for one pass per iteration.
    data = data.where(y.isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if data.agg(F.bool_or(~y.isin(0.0, 1.0))).first()[0]:
            raise ValueError(f"{response} has values other than 0 and 1")
        row = {}
        for chunk in batches(list(predictors)):
            stats = (
                F.struct(
                    F.count(names[c]).alias("n"),
                    F.avg(names[c]).alias("mean"),
                    F.stddev_pop(names[c]).alias("sd"),
                ).alias(names[c])
                for c in chunk
            )
            row |= data.agg(*stats).first().asDict()
        shape = {c: row[names[c]] for c in predictors}
        active = [c for c in predictors if shape[c]["n"] and shape[c]["sd"] and shape[c]["sd"] > 0]
        fit = {c: (0.0, 0.0) for c in active}
        done: dict[str, tuple[float, float, float]] = {}
        for _ in range(max_iter):
            if not active:
                break
            sums = {}
            for chunk in batches(active):
                sums |= _newton_sums(data, y, chunk, names, shape, fit)
            still = []
            for c in active:
                g0, g1, h00, h01, h11 = sums[names[c]]
                det = h00 * h11 - h01 * h01
                if not det > 1e-12 * shape[c]["n"] ** 2 * 1e-6:
                    continue
                step0 = (h11 * g0 - h01 * g1) / det
                step1 = (h00 * g1 - h01 * g0) / det
                b0, b1 = fit[c][0] + step0, fit[c][1] + step1
                fit[c] = (b0, b1)
                if max(abs(step0), abs(step1)) < tolerance:
                    done[c] = (b0, b1, math.sqrt(h00 / det))
                else:
                    still.append(c)
            active = still
    finally:
        data.unpersist()
    out = []
    for c in predictors:
        if c not in done:
            out.append((c, shape[c]["n"], None, None, None, None, False))
            continue
        b0, b1, error = done[c]
        mean, sd = shape[c]["mean"], shape[c]["sd"]
        z = b1 / error
        out.append(
            (c, shape[c]["n"], b0 - b1 * mean / sd, b1 / sd, z, normal_two_sided(z), True)
        )
    return df.sparkSession.createDataFrame(out, LOGIT_SCHEMA)


def _newton_sums(data, y, active, names, shape, fit) -> dict[str, tuple[float, ...]]:
    """Gradient and Hessian sums on the standardised scale, for every active predictor."""
    aggs = []
    for c in active:
        z = (F.col(names[c]) - F.lit(shape[c]["mean"])) / F.lit(shape[c]["sd"])
        p = 1.0 / (1.0 + F.exp(-(F.lit(fit[c][0]) + F.lit(fit[c][1]) * z)))
        gap, weight = y - p, p * (1.0 - p)
        terms = [gap, gap * z, weight, weight * z, weight * z * z]
        aggs.append(F.array(*(F.sum(F.when(z.isNotNull(), t)) for t in terms)).alias(names[c]))
    return data.agg(*aggs).first().asDict()
