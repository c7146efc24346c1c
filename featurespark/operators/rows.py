"""Row-level operators: splits, null handling, binarising, stride sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from featurespark.session import bounded_side, materialize


# Rows that one task puts in order.
RANGE_ROWS = 1_000_000


def feature_label_split(
    df: DataFrame,
    label: str,
    keep: Sequence[str] = (),
    features_col: str = "features",
    missing: str = "keep",
) -> DataFrame:
    """``keep`` columns, all other columns but ``label`` as one vector, and the label.

    ``missing`` says what becomes of rows with a missing feature: ``keep`` (the feature is NaN),
    ``error`` or ``skip``.
    """
    inputs = [c for c in df.columns if c != label and c not in keep]
    assembler = VectorAssembler(inputCols=inputs, outputCol=features_col, handleInvalid=missing)
    return assembler.transform(df).select(*keep, features_col, label)


def drop_missing(df: DataFrame) -> DataFrame:
    """Rows without any null or NaN."""
    return df.dropna(how="any")


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null and NaN become 0, in string columns ``'0'``."""
    names = set(df.columns if columns is None else columns)
    out = []
    for field in df.schema:
        c = F.col(field.name)
        if field.name in names and isinstance(field.dataType, (StringType, NumericType)):
            if isinstance(field.dataType, (DoubleType, FloatType)):
                c = F.nanvl(c, F.lit(None))
            c = F.coalesce(c, F.lit("0" if isinstance(field.dataType, StringType) else 0))
            c = c.cast(field.dataType).alias(field.name)
        out.append(c)
    return df.select(*out)


def binarize(df: DataFrame, column: str) -> DataFrame:
    """0 for the smallest value and 1 for all others, unless the values are {0, 1} already."""
    c = F.col(column)
    value = c.cast("int")
    if isinstance(df.schema[column].dataType, NumericType):
        only_01 = F.bool_and(c.isin(0, 1)) & (F.min(c) == 0) & (F.max(c) == 1)
    else:
        only_01 = F.lit(False)
        value = F.lit(None).cast("int")
    found = df.agg(
        F.struct(F.min(c).alias("smallest"), F.coalesce(only_01, F.lit(False)).alias("keeps"))
    ).scalar()
    smallest, keeps = found["smallest"], found["keeps"]
    return df.withColumn(
        column, F.when(keeps, value).when(c == smallest, 0).when(c.isNotNull(), 1)
    )


def with_row_index(
    df: DataFrame, order_by: Sequence[str | Column], partitions: int | None = None
) -> DataFrame:
    """A contiguous 0-based ``row_index`` in the given total order, without a global window.

    Rows are range-partitioned and that assignment is written once, so the partition numbers
    cannot change if a task is rerun. Each partition is then numbered on its own. Their number
    grows with the rows, so that no task sorts more than about ``RANGE_ROWS``.
    """
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = partitions or max(least, -(-df.count() // RANGE_ROWS))
    ranged = df.repartitionByRange(n, *order_by).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "row-index")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bounded_side(ranged.groupBy("_part").count()).select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    )
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order_by))
    return (
        ranged.withColumn("_local", local)
        .join(bounded_side(offsets), "_part")
        .withColumn("row_index", F.col("_offset") + F.col("_local") - 1)
        .drop("_part", "_local", "_offset")
    )


def stride_sample(df: DataFrame, order_by: Sequence[str | Column], step: int) -> DataFrame:
    """Rows 0, step, 2 * step, ... of the given order, with their ``row_index``."""
    return with_row_index(df, order_by).where(F.col("row_index") % step == 0)
