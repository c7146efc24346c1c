"""Input views over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTINUOUS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice"]
CATEGORICAL = ["l_returnflag", "l_linestatus", "p_type", "l_linenumber", "p_size"]

# Derived columns, some alike, with gaps of their own: expressions that SQL engines read alike.
WIDE = [f"w{k}" for k in range(64)]


def wide_expression(k: int) -> str:
    base = f"l_orderkey * {k % 32 + 3} + l_partkey * {k % 16 + 1} + l_linenumber"
    value = f"CAST(({base}) % {101 + k % 32} AS DOUBLE) + l_quantity * {k % 5}"
    return value if k % 4 == 0 else f"CASE WHEN (l_orderkey + l_linenumber) % {k % 9 + 3} <> 0 THEN {value} END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``game_id, batter, hit, atbat``: one row per order and supplier."""
    open_lines = F.col("l_linestatus") == "O"
    hit = F.when(open_lines & (F.col("l_returnflag") == "R"), F.col("l_quantity")).otherwise(0)
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("batter"))
        .agg(
            F.sum(hit).cast("int").alias("hit"),
            F.sum(F.when(open_lines, F.col("l_quantity")).otherwise(0)).cast("int").alias("atbat"),
        )
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("game_id"), F.col("o_orderdate").cast("date").alias("local_date")
    )


def timed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with a TIMESTAMP ``local_date``: one row per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("game_id"),
        F.col("user_id").alias("batter"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).alias("hit"),
        F.lit(1).alias("atbat"),
        F.col("ts").cast("timestamp").alias("local_date"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table: line items with the attributes of their part."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "p_retailprice",
        "l_returnflag",
        "l_linestatus",
        "p_type",
        "p_size",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_returned"),
    )


def features_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with nulls and NaN among predictors and the response."""
    row = F.col("l_orderkey") + F.col("l_linenumber")
    nan = F.lit(float("nan"))
    return features(spark, sf_dir).select(
        F.when(row % 6 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(row % 7 == 0, nan).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(row % 11 == 0, nan).when(row % 5 != 0, F.col("l_discount")).alias("l_discount"),
        "l_tax",
        F.when(row % 13 != 0, F.col("p_retailprice")).alias("p_retailprice"),
        F.when(row % 3 != 0, F.col("is_returned")).alias("is_returned"),
    )


def documents_with_odd_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with values that make bad column names: dots, cases, blanks, quotes, names."""
    odd = ["a.b", "A.B", "`", "", " ", "source", "odd", "n"]
    return table(spark, sf_dir, "documents").select(
        "source",
        F.element_at(F.array(*map(F.lit, odd)), (F.col("doc_id") % len(odd) + 1).cast("int")).alias("odd"),
    )


def parts_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with some values missing."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(key % 7 != 0, F.col("p_name")).alias("p_name"),
        F.when(key % 5 != 0, F.col("p_size")).alias("p_size"),
        F.when(key % 11 == 0, F.lit(float("nan")))
        .when(key % 3 != 0, F.col("p_retailprice"))
        .alias("p_retailprice"),
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns ``WIDE`` of all line items, as :func:`wide_expression` has them.

    Columns 32 apart share their remainder. Computed once, in a projection of their own, these leave
    two methods that Java compiles; as one, the 64 expressions are beyond its limit and are interpreted.
    """
    lines = table(spark, sf_dir, "lineitem")
    shared = (
        f"CAST((l_orderkey * {j + 3} + l_partkey * {j % 16 + 1} + l_linenumber) % {101 + j} AS DOUBLE) AS r{j}"
        for j in range(32)
    )
    parts = lines.selectExpr("l_quantity", "l_orderkey + l_linenumber AS s", *shared)

    def column(k: int) -> str:
        value = f"r{k % 32} + l_quantity * {k % 5}"
        return value if k % 4 == 0 else f"CASE WHEN s % {k % 9 + 3} <> 0 THEN {value} END"

    return parts.selectExpr(*(f"{column(k)} AS {c}" for k, c in enumerate(WIDE)))
