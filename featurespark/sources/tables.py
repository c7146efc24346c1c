"""Typed empty tables, appends, named views and materialised tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """UNION ALL by column name, with the types of ``table``."""
    return table.unionByName(rows.select(*(rows[f.name].cast(f.dataType) for f in table.schema)))


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``DROP TABLE IF EXISTS`` + ``CREATE TABLE ... SELECT``."""
    return _save(df, name, path, "overwrite")


def create_table_if_absent(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS ... SELECT``: an existing table keeps its rows."""
    return _save(df, name, path, "ignore")


def _save(df: DataFrame, name: str, path: str | None, mode: str) -> DataFrame:
    df.write.mode(mode).saveAsTable(name, path=path)
    return df.sparkSession.table(name)


POINTER = "_current"


def publish(df: DataFrame, path: str, replace: bool = True) -> DataFrame:
    """Write ``df`` as a new version below ``path``, then make it the current one.

    Readers (:func:`published`) see the old rows until the write is complete, and the new ones from
    then on: the version is named in a pointer file that is renamed into place. A run that fails
    or is lost on the way leaves the old version current. With ``replace=False`` the first writer
    wins: a table that exists keeps its rows, also against a writer that started earlier.
    """
    spark = df.sparkSession
    if not replace and _pointer(spark, path) is not None:
        return published(spark, path)
    version = f"version-{uuid.uuid4().hex}"
    folder = f"{path.rstrip('/')}/{version}"
    df.write.parquet(folder)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    made, current = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{n}") for n in (f"_{version}", POINTER))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(current.toUri(), conf)
    stream = made.getFileSystem(conf).create(made, True)
    stream.write(bytearray(version, "utf-8"))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if replace else rename.NONE
    try:
        files.rename(made, current, options)
    except Py4JJavaError as error:
        if replace or "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        files.delete(made, False)
        files.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
    return published(spark, path)


def _pointer(spark: SparkSession, path: str) -> str | None:
    file = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{POINTER}")
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that :func:`publish` wrote."""
    version = _pointer(spark, path)
    if version is None:
        raise ValueError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{version}")


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """First ``n`` rows in an explicit order (planned as a top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(n)
