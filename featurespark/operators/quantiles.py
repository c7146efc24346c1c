"""Exact quantiles with linear interpolation, for any number of rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurespark.session import bounded_side, materialize

# Buckets one pass splits a value range into, and the rows that are simply sorted instead.
BUCKETS = 1024
SORT_ROWS = 1_000_000


def _magnitude(x: Column) -> Column:
    """A monotone scale on which all orders of magnitude have the same width."""
    log = F.log(F.abs(x)) + 708.0
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * F.greatest(log, F.lit(0.0)))


def _bucket(by_magnitude: bool) -> Column:
    """Bucket of ``_v`` in [_lo, _hi]; the two ends always get buckets of their own."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    # Halves keep the range finite; infinite ends are split off by their own buckets.
    share = F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2)
    if by_magnitude:
        a, b, c = _magnitude(v), _magnitude(lo), _magnitude(hi)
        share = F.when(b == c, share).otherwise(F.try_divide(a - b, c - b))
    share = F.coalesce(F.nanvl(share, F.lit(0.0)), F.lit(0.0))
    inner = F.floor(share * (BUCKETS - 2))
    return (
        F.when(v <= lo, 0)
        .when(v >= hi, BUCKETS - 1)
        .otherwise(F.least(inner, F.lit(BUCKETS - 3)) + 1)
        .cast("bigint")
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str],
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """Long table ``by..., prob, quantile``; nulls and NaN are left out.

    A pass counts rows per bucket of each group's value range, which tells the bucket every
    asked rank lies in. Buckets with more than ``sort_rows`` rows are split in a further pass;
    the others are sorted, as distinct values with counts. No task ever holds a larger group.
    """
    by = list(by)
    v = F.col("_v")
    base = df.select(*by, F.col(value).cast("double").alias("_v")).where(
        v.isNotNull() & ~F.isnan(v)
    )
    sizes = (F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    root = F.lit(0).cast("bigint").alias("_node")
    nodes = bounded_side(
        base.groupBy(*by).agg(*sizes).select(*by, root, "_n", "_lo", "_hi", _asked(probs))
    )
    rows = base.select(*by, root, "_v")
    answers = []
    passes = 0
    while True:
        # One row per node, that is per bucket with an asked rank.
        single = F.col("_lo") == F.col("_hi")
        answers.append(
            nodes.where(single).select(*by, F.col("_lo").alias("_v"), F.inline("asked"))
        )
        nodes = nodes.where(~single)
        largest, total = nodes.agg(F.max("_n"), F.sum("_n")).first()
        if largest is None:
            break
        if largest <= sort_rows and not (passes == 0 and total > sort_rows):
            answers.append(_by_sorting(rows, nodes, by))
            break
        if passes > 1:
            # Only rows near asked ranks are left: cheap to write, and the lineage stays short.
            rows = materialize(rows, "near-ranks")
        # Numbered within the group: never more than asked ranks.
        number = F.row_number().over(Window.partitionBy(*by).orderBy("_node")).cast("bigint")
        nodes = nodes.withColumn("_slot", number)
        limits = nodes.select(*by, "_node", "_slot", "_lo", "_hi")
        # Every other pass works by magnitude, so long tails do not need many passes.
        child = F.col("_slot") * BUCKETS + _bucket(by_magnitude=passes % 2 == 1)
        rows = join_null_safe(rows, limits, [*by, "_node"]).select(*by, child.alias("_node"), "_v")
        passes += 1
        counts = rows.groupBy(*by, "_node").agg(*sizes)
        nodes = bounded_side(_descend(nodes, counts, by))
    found = answers[0]
    for part in answers[1:]:
        found = found.unionByName(part)
    low = F.max(F.when(~F.col("upper"), v))
    high = F.max(F.when(F.col("upper"), v))
    return found.groupBy(*by, "prob").agg(
        F.when(low == high, low).otherwise(low + (high - low) * F.max("frac")).alias("quantile")
    )


def _asked(probs: Sequence[float]) -> Column:
    """The two neighbouring ranks of every probability among ``_n`` rows."""
    ranks = []
    for p in probs:
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        for upper, rank in ((False, F.floor(pos)), (True, F.ceil(pos))):
            ranks.append(
                F.struct(
                    F.lit(float(p)).alias("prob"),
                    F.lit(upper).alias("upper"),
                    rank.alias("rank"),
                    (pos - F.floor(pos)).alias("frac"),
                )
            )
    return F.array(*ranks).alias("asked")


def _descend(nodes: DataFrame, counts: DataFrame, by: list[str]) -> DataFrame:
    """The buckets with asked ranks, and those ranks counted inside the bucket."""
    siblings = Window.partitionBy(*by, "_slot").orderBy("_node")
    children = counts.withColumn("_slot", F.floor(F.col("_node") / BUCKETS)).withColumn(
        "_off", F.sum("_n").over(siblings) - F.col("_n")
    )
    joined = join_null_safe(children, nodes.select(*by, "_slot", "asked"), [*by, "_slot"])
    off, end = F.col("_off"), F.col("_off") + F.col("_n")
    inside = F.filter("asked", lambda a: (a["rank"] >= off) & (a["rank"] < end))
    moved = F.transform(inside, lambda a: a.withField("rank", a["rank"] - off))
    return joined.select(*by, "_node", "_n", "_lo", "_hi", moved.alias("asked")).where(
        F.size("asked") > 0
    )


def _by_sorting(rows: DataFrame, nodes: DataFrame, by: list[str]) -> DataFrame:
    node = [*by, "_node"]
    ranked = (
        join_null_safe(rows, nodes.select(*node), node)
        .groupBy(*node, "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_upto", F.sum("_c").over(Window.partitionBy(*node).orderBy("_v")))
    )
    hit = (F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_c"))
    return (
        join_null_safe(ranked, nodes.select(*node, "asked"), node)
        .select(*by, "_v", "_c", "_upto", F.inline("asked"))
        .where(hit)
        .drop("_c", "_upto")
    )


def wide_quantiles(
    df: DataFrame,
    value: str,
    named_probs: dict[str, float],
    by: Sequence[str],
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """One row per group with one column per named probability."""
    long = exact_quantiles(df, value, sorted(set(named_probs.values())), by, sort_rows)
    return long.groupBy(*by).agg(
        *(
            F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(name)
            for name, p in named_probs.items()
        )
    )


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null keys match, keeping the left side's key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, condition).drop(*(f"_r_{k}" for k in keys))
