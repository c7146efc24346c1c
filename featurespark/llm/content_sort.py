"""Exact duplicates by sorting normalised content.

Sampled splitters range-partition the rows by their normalised text, an external sort within each
range places equal texts next to each other, and a window compares neighbouring rows in full.
Only built-in DataFrame functions are used.

A text held by so many rows that it would fill a range of its own is counted by its SHA-256 before
anything is moved (map-side combined), and its rows travel without their text, spread by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurespark.llm.common import ascii_lower, shuffle_partitions, text_or_empty

# A text is hot when it holds more rows than a quarter of an even range, and this many at least.
HOT_ROWS = 1000
# Characters of a text that splitters hold, so that the sampled keys stay small. Texts that agree
# in them are ordered by a hash, and equal texts still meet: the window compares whole texts.
HEAD = 64
HOT_SHARE = 4


def hot_texts(rows: DataFrame, best: Column, hot_rows: int) -> DataFrame:
    """One row per hot text: at most ``HOT_SHARE`` times the number of shuffle partitions."""
    least = max(hot_rows, rows.count() // (HOT_SHARE * shuffle_partitions(rows.sparkSession)))
    return (
        rows.groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("hot_size"), best.alias("hot_keep"))
        .where(F.col("hot_size") > least)
    )


def content_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    carry: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every row with its group of equal texts: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty. Of a group
    the row with the smallest (``keep="largest"``: largest) id is kept. Null ids come last: they
    are kept only where the group has no other id, and ``keep_id`` is null then. Of repeated rows
    that tie for the kept id exactly one has ``kept``. An empty table gives an empty result.
    Other columns are ignored, or with ``carry`` returned whole in the struct column ``row``.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    largest = keep == "largest"
    normal = ascii_lower(text_or_empty(text_col))
    columns = [F.col(id_col).alias("id"), normal.alias("norm")]
    if carry:
        columns.append(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = docs.select(*columns).withColumn("text_sha256", F.sha2("norm", 256))

    best = F.max("id") if largest else F.min("id")
    hot = hot_texts(rows.select("id", "text_sha256"), best, hot_rows)
    is_hot = F.col("hot_size").isNotNull()
    marked = (
        rows.join(F.broadcast(hot), "text_sha256", "left")
        .withColumn("norm", F.when(~is_hot, F.col("norm")))
        .withColumn("head", F.left("norm", F.lit(HEAD)))
        .withColumn("spread", F.when(is_hot, F.xxhash64("id")).otherwise(F.xxhash64("norm")))
    )
    order = F.col("id").desc_nulls_last() if largest else F.col("id").asc_nulls_last()
    group = Window.partitionBy("head", "spread", "norm", "text_sha256")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = (
        marked.repartitionByRange("head", "spread")
        .withColumn("place", F.row_number().over(group.orderBy(order)))
        .withColumn("best", best.over(whole))
        .withColumn("size", F.count(F.lit(1)).over(whole))
    )
    keep_id = F.when(is_hot, F.col("hot_keep")).otherwise(F.col("best"))
    return found.select(
        F.col("id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("hot_size", "size").alias("group_size"),
        ((F.col("place") == 1) & F.col("id").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )


def drop_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The kept row of every group of equal texts, with all columns of ``docs``.

    Null, empty and very long texts, null ids, ties, repeated rows and an empty table are treated
    as in :func:`content_groups`; ``docs`` may have columns of any name.
    """
    groups = content_groups(docs, id_col, text_col, keep, carry=True)
    return groups.where("kept").select("row.*")
