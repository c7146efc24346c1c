"""Delimited text in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header-less CSV with assigned names and types; blank lines skipped, bad values raise."""
    return spark.read.csv(path, schema=schema, header=False, mode="FAILFAST")


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text with a header line; nulls are written as ``NULL``."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="NULL")


def scan_tsv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read back what :func:`write_tsv` wrote."""
    return spark.read.csv(
        path, schema=schema, sep="\t", header=True, nullValue="NULL", mode="FAILFAST"
    )
