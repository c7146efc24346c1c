"""Mean square difference of binned means from the population mean, in one and two dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurespark.functions.bins import bin_left_closed, bin_right_closed, edges
from featurespark.operators.assoc import batches, empty_scores, pair_name, union_all
from featurespark.operators.profile import nonzero_mean
from featurespark.operators.quantiles import exact_quantiles
from featurespark.session import unpivot_tuples

REFERENCE, STANDARD = "reference", "standard"
CELL_SCHEMA = "bin1 string, bin2 string, n bigint, bin_mean double, msd double, weighted_msd double"


def _number(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def column_ranges(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, dict]]:
    """Row count, and minimum, maximum and mean of every column, in one pass."""
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *(
            F.struct(
                F.min(_number(c)).alias("lo"),
                F.max(_number(c)).alias("hi"),
                F.avg(_number(c)).alias("mean"),
            ).alias(c)
            for c in columns
        ),
    ).first()
    return row["_n"], {c: row[c].asDict() for c in columns}


def bin_edges(df: DataFrame, columns: Sequence[str], n_bins: int = 10) -> DataFrame:
    """``feature, bin, lower, upper``."""
    _, ranges = column_ranges(df, columns)
    rows = [
        (c, i, cuts[i], cuts[i + 1])
        for c in columns
        for cuts in _edges(ranges[c], n_bins)
        for i in range(n_bins)
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature string, bin int, lower double, upper double"
    )


def _edges(span: dict, n_bins: int) -> list[list[float]]:
    """The edges as a one-element list, or nothing for a column without values."""
    return [] if span["lo"] is None else [edges(span["lo"], span["hi"], n_bins)]


def msd_1d(
    df: DataFrame,
    features: Sequence[str],
    response: str | None = None,
    mode: str = REFERENCE,
    n_bins: int = 10,
) -> DataFrame:
    """Ten rows per feature: bin limits, median, count, means, MSD, proportion, weighted MSD.

    ``reference`` compares means of the predictor itself, ``standard`` means of the response.
    Bins without rows carry zeros.
    """
    if mode == STANDARD and response is None:
        raise ValueError("standard mode needs a response")
    measured = [response] if mode == STANDARD else []
    n_rows, ranges = column_ranges(df, [*features, *measured])
    frame, groups, columns = [], {}, {}
    for number, c in enumerate(features):
        for cuts in _edges(ranges[c], n_bins):
            pop_mean = ranges[response if mode == STANDARD else c]["mean"]
            frame += [(c, i, cuts[i], cuts[i + 1], pop_mean) for i in range(n_bins)]
            names = (f"_b{number}", f"_x{number}", "_y" if mode == STANDARD else f"_x{number}")
            groups[c] = names
            columns[names[0]] = bin_left_closed(_number(c), cuts)
            columns[names[1]] = _number(c)
    if mode == STANDARD:
        columns["_y"] = _number(response)
    schema = "feature string, bin int, lower double, upper double, pop_mean double"
    bins = df.sparkSession.createDataFrame(frame, schema)
    if not groups:
        long = df.sparkSession.createDataFrame(
            [], "feature string, bin int, value double, measure double"
        )
    else:
        data = df.select(*(c.alias(name) for name, c in columns.items()))
        long = unpivot_tuples(data, [], groups, ["bin", "value", "measure"], "feature")
        long = long.where(F.col("bin").isNotNull())
    keys = ["feature", "bin"]
    stats = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"), F.avg("measure").alias("bin_mean")
    )
    medians = exact_quantiles(long, "value", [0.5], keys).select(
        *keys, F.col("quantile").alias("median")
    )
    gap = F.col("bin_mean") - F.col("pop_mean")
    # stats and medians have at most n_bins rows per feature: a bound known from the plan.
    table = bins.join(F.broadcast(stats), keys, "left").join(F.broadcast(medians), keys, "left")
    return table.select(
        *keys,
        "lower",
        "upper",
        F.coalesce("median", F.lit(0.0)).alias("median"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("bin_mean", F.lit(0.0)).alias("bin_mean"),
        "pop_mean",
        F.coalesce(gap * gap, F.lit(0.0)).alias("msd"),
        F.coalesce(F.col("count") / F.lit(n_rows), F.lit(0.0)).alias("pop_proportion"),
        F.coalesce(gap * gap * (F.col("count") / F.lit(n_rows)), F.lit(0.0)).alias("weighted_msd"),
    )


def msd_1d_summary(table: DataFrame) -> DataFrame:
    """Per feature, the mean of the non-zero MSD and weighted MSD; NULL if all are zero."""
    plain = nonzero_mean(table, "msd", ["feature"]).withColumnRenamed("nonzero_mean", "msd")
    weighted = nonzero_mean(table, "weighted_msd", ["feature"])
    return plain.join(weighted.withColumnRenamed("nonzero_mean", "weighted_msd"), "feature")


def _bin_keys(ranges: dict, columns: Sequence[str], n_bins: int) -> dict[str, Column]:
    keys = {}
    for c in columns:
        for cuts in _edges(ranges[c], n_bins):
            keys[c] = bin_right_closed(_number(c), cuts)
    return keys


def _cells(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]],
    left: dict[str, Column],
    right: dict[str, Column],
    response: str,
    n_rows: int,
    pop_mean: float,
    scaled_down: bool,
) -> DataFrame:
    """Non-empty cells of all pairs from one grouped pass per batch of pairs."""
    pairs = [(a, b) for a, b in pairs if a in left and b in right]
    if not pairs:
        return empty_scores(df, CELL_SCHEMA)
    first = {c: f"_l{i}" for i, c in enumerate(left)}
    second = {c: f"_r{i}" for i, c in enumerate(right)} if right is not left else first
    keyed = df.select(
        _number(response).alias("y"),
        *{
            name: keys[c].alias(name)
            for keys, names in ((left, first), (right, second))
            for c, name in names.items()
        }.values(),
    )
    parts = []
    for chunk in batches(pairs):
        groups = {str(i + 1): (first[a], second[b]) for i, (a, b) in enumerate(chunk)}
        cells = (
            unpivot_tuples(keyed, ["y"], groups, ["bin1", "bin2"], "pair")
            .where(F.col("bin1").isNotNull() & F.col("bin2").isNotNull())
            .groupBy("pair", "bin1", "bin2")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("bin_mean"))
        )
        number = F.col("pair").cast("int")
        parts.append(
            cells.select(
                pair_name(number, chunk, 0).alias("predictor1"),
                pair_name(number, chunk, 1).alias("predictor2"),
                F.col("bin1").cast("string").alias("bin1"),
                F.col("bin2").cast("string").alias("bin2"),
                "n",
                "bin_mean",
            )
        )
    gap = F.col("bin_mean") - F.lit(pop_mean)
    share = F.col("n") / F.lit(n_rows)
    weight = 1.0 / (F.col("n").cast("double") * F.lit(n_rows)) if scaled_down else share
    return union_all(parts).withColumns({"msd": gap * gap, "weighted_msd": gap * gap * weight})


def msd_2d_cont_cont(
    df: DataFrame,
    continuous: Sequence[str],
    response: str,
    mode: str = REFERENCE,
    n_bins: int = 10,
) -> DataFrame:
    """Cells of all pairs of continuous predictors, a predictor with itself included.

    ``reference`` divides the MSD by (cell rows x all rows), ``standard`` weights it by the
    share of rows in the cell.
    """
    n_rows, ranges = column_ranges(df, [*dict.fromkeys([*continuous, response])])
    keys = _bin_keys(ranges, continuous, n_bins)
    pairs = list(combinations_with_replacement(continuous, 2))
    return _cells(
        df, pairs, keys, keys, response, n_rows, ranges[response]["mean"], mode == REFERENCE
    )


def msd_2d_cont_cat(
    df: DataFrame,
    continuous: Sequence[str],
    categorical: Sequence[str],
    response: str,
    n_bins: int = 10,
) -> DataFrame:
    """Cells of every continuous (predictor1) with every categorical predictor (predictor2)."""
    n_rows, ranges = column_ranges(df, [*dict.fromkeys([*continuous, response])])
    left = _bin_keys(ranges, continuous, n_bins)
    right = {c: F.col(c).cast("string") for c in categorical}
    pairs = list(product(continuous, categorical))
    return _cells(df, pairs, left, right, response, n_rows, ranges[response]["mean"], False)


def msd_2d_cat_cat(df: DataFrame, categorical: Sequence[str], response: str) -> DataFrame:
    """Cells of all pairs of categorical predictors, a predictor with itself included."""
    n_rows, ranges = column_ranges(df, [response])
    keys = {c: F.col(c).cast("string") for c in categorical}
    pairs = list(combinations_with_replacement(categorical, 2))
    return _cells(df, pairs, keys, keys, response, n_rows, ranges[response]["mean"], False)


def msd_rank(cells: DataFrame) -> DataFrame:
    """Mean MSD and weighted MSD over the non-empty cells of each pair, weighted descending."""
    return (
        cells.groupBy("predictor1", "predictor2")
        .agg(F.avg("msd").alias("unweighted_msd"), F.avg("weighted_msd").alias("weighted_msd"))
        .orderBy(F.desc_nulls_last("weighted_msd"), "predictor1", "predictor2")
    )
