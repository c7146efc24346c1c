"""Database tables through Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for one scan. A partitioned scan needs a table, a column, bounds and a count."""
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    options = {"url": url, "fetchsize": str(fetch_size)}
    named = {"dbtable": table, "query": query, "user": user, "password": password, "driver": driver}
    options.update({k: v for k, v in named.items() if v is not None})
    if partition_column is not None:
        if table is None or bounds is None or num_partitions is None:
            raise ValueError("a partitioned scan needs table, bounds and num_partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(num_partitions),
        )
    return options


def scan_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """Read a table or query; filters and columns are pushed into the database by Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()
