"""Column typing, summary statistics, counts and contingency tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from featurespark.operators.quantiles import SORT_ROWS, wide_quantiles
from featurespark.operators.rows import with_row_index
from featurespark.session import LOCAL_ROWS, bounded_side, materialize

CATEGORICAL = "categorical"
CONTINUOUS = "continuous"
QUARTILES = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1.0}


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``keep..., feature, value`` with the values as double."""
    return df.select(*keep, *(F.col(c).cast("double").alias(c) for c in columns)).unpivot(
        list(keep), list(columns), "feature", "value"
    )


def fixed_kinds(df: DataFrame) -> dict[str, str]:
    """Kinds of the columns whose type decides."""
    fixed = {}
    for f in df.schema:
        if isinstance(f.dataType, StringType):
            fixed[f.name] = CATEGORICAL
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            fixed[f.name] = CONTINUOUS
    return fixed


def column_kinds(df: DataFrame, max_ratio: float = 0.1) -> DataFrame:
    """``column_name, kind``: strings are categorical and floating-point columns continuous.

    All others are categorical iff distinct values / rows <= ``max_ratio``; NULL for no rows.
    Only those others are read.
    """
    fixed = fixed_kinds(df)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in (c for c in df.columns if c not in fixed):
        distinct = F.count_distinct(c) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))
        aggs.append(distinct.alias(c))
    row = df.agg(*aggs).select(
        *(
            F.when(F.col("_n") > 0, F.lit(fixed[c])).alias(c)
            if c in fixed
            else F.when(F.try_divide(c, "_n") <= max_ratio, CATEGORICAL)
            .when(F.col("_n") > 0, CONTINUOUS)
            .alias(c)
            for c in df.columns
        )
    )
    return row.unpivot([], df.columns, "column_name", "kind")


def boolean_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, is_boolean``: exactly two distinct values, a null counting as one.

    Two passes over the columns (minimum and maximum, then "nothing in between"), neither of
    which shuffles values.
    """
    columns = list(columns or df.columns)
    spans = df.agg(
        *(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns)
    ).first()
    checks = []
    for c in columns:
        lo, hi = spans[c]["lo"], spans[c]["hi"]
        nulls = F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False))
        if lo is None:
            check = F.lit(False)
        elif lo == hi:
            check = nulls
        else:
            typed = [F.lit(x).cast(df.schema[c].dataType) for x in (lo, hi)]
            check = ~nulls & F.bool_and(F.col(c).isin(*typed))
        checks.append(F.coalesce(check, F.lit(False)).alias(c))
    return df.agg(*checks).unpivot([], columns, "column_name", "is_boolean")


@dataclass(frozen=True)
class FeatureSpec:
    """Roles of the columns: one response, and predictors of two kinds."""

    response: str
    continuous: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    response_kind: str | None = None

    @property
    def predictors(self) -> list[str]:
        return self.continuous + self.categorical

    @classmethod
    def infer(cls, df: DataFrame, response: str, max_ratio: float = 0.1) -> FeatureSpec:
        if response not in df.columns:
            raise ValueError(f"no column {response}")
        kinds = {r["column_name"]: r["kind"] for r in column_kinds(df, max_ratio).collect()}
        names = [c for c in df.columns if c != response]
        return cls(
            response,
            [c for c in names if kinds[c] == CONTINUOUS],
            [c for c in names if kinds[c] == CATEGORICAL],
            kinds[response],
        )


def summary_stats(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """``feature, mean, min, max``, rounded, in one pass."""
    stats = {"mean": F.avg, "min": F.min, "max": F.max}
    row = df.agg(
        *(
            F.struct(
                *(F.round(f(F.col(c).cast("double")), digits).alias(s) for s, f in stats.items())
            ).alias(c)
            for c in columns
        )
    )
    return row.unpivot([], list(columns), "feature", "s").select("feature", "s.*")


def quartiles(df: DataFrame, columns: Sequence[str], sort_rows: int = SORT_ROWS) -> DataFrame:
    """``feature, q0 .. q4``, exact, linear interpolation.

    Groups above ``sort_rows`` are narrowed down by counting before anything is sorted.
    """
    return wide_quantiles(unpivot(df, columns), "value", QUARTILES, ["feature"], sort_rows)


def quartiles_approx(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """``feature, q0 .. q4`` from one pass of quantile sketches."""
    row = df.agg(
        *(F.percentile_approx(c, list(QUARTILES.values()), accuracy).alias(c) for c in columns)
    ).select(*(F.col(c).cast("array<double>").alias(c) for c in columns))
    return row.unpivot([], list(columns), "feature", "q").select(
        "feature", *(F.col("q")[i].alias(name) for i, name in enumerate(QUARTILES))
    )


def class_counts(df: DataFrame, column: str, max_rows: int = LOCAL_ROWS) -> DataFrame:
    """``column, n, share``; more than ``max_rows`` classes are written, not sent to the driver."""
    # The grouped counts are computed once; their sum is the number of rows.
    counts = bounded_side(df.groupBy(column).agg(F.count(F.lit(1)).alias("n")), max_rows)
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def contingency(df: DataFrame, x: str, y: str) -> DataFrame:
    """Non-empty cells of the contingency table: ``x, y, n``."""
    return df.groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))


# Values of ``y`` that :func:`crosstab_wide` may have: its columns are listed on the driver.
CROSSTAB_VALUES = 10_000


def _numbered_values(cells: DataFrame, y: str, most: int) -> tuple[DataFrame, list[str]]:
    """The values of ``y`` in order as a local table ``_y, _total, _index``, and their names."""
    rows = (
        cells.groupBy(F.col(y).alias("_y"))
        .agg(F.sum("n").alias("_total"))
        .withColumn("_name", F.coalesce(F.col("_y").cast("string"), F.lit("null")))
        .orderBy("_y")
        .limit(most + 1)
        .collect()
    )
    if len(rows) > most:
        raise ValueError(f"{y} has more than {most} values; contingency() has no such bound")
    kind = cells.schema[y].dataType.simpleString()
    values = cells.sparkSession.createDataFrame(
        [(r["_y"], r["_total"], i) for i, r in enumerate(rows)],
        f"_y {kind}, _total bigint, _index int",
    )
    return values, [r["_name"] for r in rows]


def _counted(cells: DataFrame, values: DataFrame, x: str, y: str) -> DataFrame:
    """``x, counts, x_total``: per value of ``x`` a map from number of ``y`` value to count."""
    numbered = cells.join(values, F.col(y).eqNullSafe(F.col("_y")))
    entries = F.map_from_entries(F.collect_list(F.struct("_index", "n")))
    return numbered.groupBy(x).agg(entries.alias("_counts"), F.sum("n").alias("_x_total"))


def crosstab_wide(df: DataFrame, x: str, y: str, max_values: int = CROSSTAB_VALUES) -> DataFrame:
    """One row per value of ``x``, one count column per value of ``y``, 0 for empty cells.

    Columns are named by the text of their value, a null by ``null``; names that Spark would take
    for one (equal but for case, or equal to ``x``) raise. More than ``max_values`` values raise;
    :func:`contingency` has no such bound.
    """
    cells = bounded_side(contingency(df, x, y))
    values, names = _numbered_values(cells, y, max_values)
    folded = [name.lower() for name in [x, *names]]
    if len(set(folded)) < len(folded):
        raise ValueError(f"values of {y} clash as column names; use crosstab or contingency")
    counts = _counted(cells, values, x, y)
    cell = [F.coalesce(F.col("_counts")[F.lit(i)], F.lit(0)) for i in range(len(names))]
    return counts.select(F.col(x), *(c.alias(n) for c, n in zip(cell, names)))


def numbered_values(cells: DataFrame, y: str) -> DataFrame:
    """``y_index, y, y_total`` of the values of ``y`` in order, numbered from 0 without a bound."""
    totals = cells.groupBy(y).agg(F.sum("n").alias("y_total"))
    numbered = with_row_index(totals, [F.col(y)]).withColumnRenamed("row_index", "y_index")
    return materialize(numbered.select("y_index", y, "y_total"), "values")


def crosstab_sparse(df: DataFrame, x: str, y: str) -> tuple[DataFrame, DataFrame]:
    """A table of any width: ``x, y_index, n, x_total`` of its non-empty cells, and the values of
    ``y`` by number. Rows without ``x`` or ``y`` are left out; nothing reaches the driver."""
    cells = materialize(contingency(df.dropna(subset=[x, y]), x, y), "cells")
    values = numbered_values(cells, y)
    x_totals = materialize(cells.groupBy(x).agg(F.sum("n").alias("x_total")), "x-totals")
    numbered = cells.join(values.select(y, "y_index"), y).join(x_totals, x)
    return numbered.select(x, "y_index", "n", "x_total"), values


def crosstab(df: DataFrame, x: str, y: str) -> DataFrame:
    """All cells ``x, y, n`` with zeros, and both margins, whatever and however many the values are.

    Rows without ``x`` or ``y`` are left out.
    """
    cells, values = crosstab_sparse(df, x, y)
    cells = materialize(cells, "numbered-cells")
    # One row per cell: as many as the table has, by definition.
    width = values.agg(F.coalesce(F.max("y_index"), F.lit(-1)).cast("long")).scalar()
    places = F.explode(F.sequence(F.lit(0).cast("long"), width)).alias("y_index")
    every = cells.select(x, "x_total").distinct().select(x, "x_total", places)
    filled = every.join(cells.select(x, "y_index", "n"), [x, "y_index"], "left").join(values, "y_index")
    return filled.select(x, y, F.coalesce("n", F.lit(0)).alias("n"), "x_total", "y_total")


def nonzero_mean(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the non-zero values; NULL if there are none."""
    value = F.avg(F.when(F.col(column) != 0, F.col(column)))
    return df.groupBy(*by).agg(value.alias("nonzero_mean"))
