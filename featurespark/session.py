"""Session helpers: bounded broadcasts and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

FIXED_WIDTH = (BooleanType, DatetimeType, NumericType)

# Rows and bytes a table may have to be copied into the plan, from where Spark broadcasts it by its
# size.
LOCAL_ROWS = 20_000
LOCAL_BYTES = 8 << 20


def bounded_side(df: DataFrame, max_rows: int = LOCAL_ROWS) -> DataFrame:
    """``df`` computed once: as a local table within ``max_rows`` rows and ``LOCAL_BYTES``.

    The check reads at most ``max_rows + 1`` rows, and measures columns of variable width before
    any row reaches the driver. Beyond the bounds the result is written to
    the shared folder, and joins with it are ordinary shuffle joins. The rows are kept between
    the check and the write, so what ``df`` is made of is not computed again.
    """
    level = df.storageLevel
    if level.useMemory or level.useDisk:
        return _local_or_written(df, max_rows)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _local_or_written(df, max_rows)
    finally:
        df.unpersist()


def _local_or_written(df: DataFrame, max_rows: int) -> DataFrame:
    wide = [f.name for f in df.schema if not isinstance(f.dataType, FIXED_WIDTH)]
    if wide:
        size = sum((F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))) for c in wide), F.lit(0))
        bytes_ = df.limit(max_rows + 1).agg(F.sum(size.cast("long"))).first()[0]
        if (bytes_ or 0) > LOCAL_BYTES:
            return materialize(df, "side")
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return materialize(df, "side")
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def shared_path(spark: SparkSession, name: str) -> str:
    """The path of ``name`` in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="featurespark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


_released: ContextVar[list[str] | None] = ContextVar("released", default=None)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that :func:`materialize` writes inside the block when it ends.

    Results made inside must be written or collected before that.
    """
    paths: list[str] = []
    token = _released.set(paths)
    try:
        yield
    finally:
        _released.reset(token)
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a stable, recomputation-proof cut.

    The table stays until the folder is cleared, or until the :func:`scratch_tables` block ends.
    """
    path = scratch_path(df.sparkSession, name)
    if (paths := _released.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def over_cached(df: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``compute(df)`` for a computation that passes over ``df`` several times.

    ``df`` is kept in memory and on disk meanwhile and released afterwards, so the result is
    evaluated here: small results become a local table, others a written one. Callers select the
    columns they need first.
    """
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return bounded_side(compute(data))
    finally:
        data.unpersist()


def unpivot_tuples(
    df: DataFrame, keep: list[str], groups: dict[str, tuple[str, ...]], names: list[str], key: str
) -> DataFrame:
    """Long form ``keep..., key, names...``: one row per group of columns, in one expansion."""

    def quoted(columns) -> str:
        return ", ".join(f"`{c}`" for c in columns)

    entries = ", ".join(f"({quoted(columns)}) AS `{name}`" for name, columns in groups.items())
    used = dict.fromkeys([*keep, *(c for columns in groups.values() for c in columns)])
    return df.sparkSession.sql(
        f"SELECT {quoted([*keep, key, *names])} FROM {{df}}"
        f" UNPIVOT INCLUDE NULLS (({quoted(names)}) FOR `{key}` IN ({entries}))",
        df=df.select(*used),
    )
