"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurespark.session import materialize

EDGE = ("a", "b")


def _minima(edges: DataFrame) -> DataFrame:
    # Written, so that the join below has plain exchanges on both sides and hot nodes can be split.
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return materialize(least, "star-minima")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both.join(_minima(both), "a").withColumn("least", F.least("least", "a"))
    return around.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; edges lead downwards."""
    least = _minima(edges)
    moved = edges.join(least, "a").where("b <> least")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
        least.select("a", F.col("least").alias("b"))
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("a"), F.sum(F.xxhash64(*EDGE).cast("decimal(38,0)"))).first()
    return row[0], row[1]


def component_roots(edges: DataFrame) -> DataFrame:
    """``a, b``: every node that has an edge, but the roots, with the smallest node it reaches.

    ``edges`` has two long columns ``a`` and ``b``, in any direction, with repeats and loops or
    without. Each step is written to the shared folder; the number of steps grows with the
    logarithm of the longest path.
    """
    downwards = edges.select(F.greatest(*EDGE).alias("a"), F.least(*EDGE).alias("b"))
    now = materialize(downwards.where("a <> b").distinct(), "star-edges")
    state = _state(now)
    while state[0]:
        now = materialize(_large_star(now).distinct(), "star-edges")
        now = materialize(_small_star(now).distinct(), "star-edges")
        before, state = state, _state(now)
        if state == before:
            break
    return now
