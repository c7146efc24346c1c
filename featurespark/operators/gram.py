"""Pearson correlations of many columns in one scan, by a blocked Gram matrix.

Every task multiplies its rows, shifted by a value of each column, and their presence masks, and
keeps for each pair of columns the count, means, variances and covariance of the rows that have
both. These moments come out by blocks of columns and are merged block by block, one task's at a
time, so memory is bounded by a block however many tasks and columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_COLUMNS = 64
# Rows of a column whose median is its shift, and rows that are multiplied at a time.
SHIFT_ROWS = 1001
ROWS_AT_ONCE = 8192
# Relative size under which a variance is rounding, to the sum of squares and the squared mean.
TINY, TINY_SQUARE = 1e-13, 1e-20
MOMENTS = ("n", "mean_a", "mean_b", "var_a", "var_b", "cov")


class Moments:
    """Moments of all pairs of columns over the rows of a task; missing values are NaN."""

    def __init__(self, columns: int):
        self.shift: np.ndarray | None = None
        self.n, self.sums, self.squares, self.products = (np.zeros((columns, columns)) for _ in range(4))

    def add(self, x: np.ndarray) -> None:
        present = ~np.isnan(x)
        if self.shift is None:
            self.shift = np.full(x.shape[1], np.nan)
        for c in np.flatnonzero(np.isnan(self.shift)):
            # A value of the column or between two: a constant one becomes exactly zero.
            known = x[present[:, c], c][:SHIFT_ROWS]
            if len(known):
                self.shift[c] = np.median(known)
        z = np.where(present, x - np.nan_to_num(self.shift), 0.0)
        if present.all():
            # Every pair has every row.
            self.n += len(x)
            self.sums += z.sum(axis=0)[:, None]
            self.squares += (z * z).sum(axis=0)[:, None]
        else:
            mask = present.astype(float)
            self.n += mask.T @ mask
            self.sums += z.T @ mask
            self.squares += (z * z).T @ mask
        self.products += z.T @ z

    def central(self) -> dict[str, np.ndarray]:
        n = np.maximum(self.n, 1)
        mean = self.sums / n
        var = self.squares - self.sums * mean
        var[var <= TINY * self.squares] = 0.0
        shift = np.nan_to_num(self.shift)
        return {
            "n": self.n,
            "mean_a": mean + shift[:, None],
            "mean_b": mean.T + shift[None, :],
            "var_a": var,
            "var_b": var.T,
            "cov": self.products - self.sums * mean.T,
        }


def merge(one: dict[str, np.ndarray], two: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Moments of the rows of both."""
    n = one["n"] + two["n"]
    share = two["n"] / np.maximum(n, 1)
    weight = one["n"] * share
    by_a, by_b = two["mean_a"] - one["mean_a"], two["mean_b"] - one["mean_b"]
    only = one["n"] == 0
    return {
        "n": n,
        "mean_a": np.where(only, two["mean_a"], one["mean_a"] + by_a * share),
        "mean_b": np.where(only, two["mean_b"], one["mean_b"] + by_b * share),
        "var_a": one["var_a"] + two["var_a"] + weight * by_a**2,
        "var_b": one["var_b"] + two["var_b"] + weight * by_b**2,
        "cov": one["cov"] + two["cov"] + weight * by_a * by_b,
    }


def pearson(m: dict[str, np.ndarray]) -> np.ndarray:
    """r of every pair; NaN marks a side without variation, infinity stays undefined as NaN too."""
    a = np.where(m["var_a"] > TINY_SQUARE * m["n"] * m["mean_a"] ** 2, m["var_a"], 0.0)
    b = np.where(m["var_b"] > TINY_SQUARE * m["n"] * m["mean_b"] ** 2, m["var_b"], 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((a > 0) & (b > 0), m["cov"] / (np.sqrt(a) * np.sqrt(b)), np.nan)


def block_moments(columns: int):
    """Arrow function from rows to this task's moments, for each pair of blocks of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Moments(columns)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                found.add(np.stack([c.to_numpy(zero_copy_only=False) for c in part.columns], 1).astype(float))
        if found.shift is None:
            return  # no rows
        moments = found.central()
        for a in range(0, columns, BLOCK_COLUMNS):
            for b in range(a, columns, BLOCK_COLUMNS):
                block = (slice(a, a + BLOCK_COLUMNS), slice(b, b + BLOCK_COLUMNS))
                values = [pa.array([moments[m][block].ravel()], pa.list_(pa.float64())) for m in MOMENTS]
                ends = [pa.array([a], pa.int32()), pa.array([b], pa.int32())]
                yield pa.RecordBatch.from_arrays([*ends, *values], ["a", "b", *MOMENTS])

    return run


def merge_blocks(columns: int):
    """Arrow function from sorted blocks to ``a, b, r`` of the pairs of their upper triangle."""

    def scored(at: tuple[int, int], held: dict[str, np.ndarray]) -> pa.RecordBatch:
        width = min(columns - at[1], BLOCK_COLUMNS)
        r = pearson(held).reshape(-1, width)
        a, b = np.indices(r.shape, dtype=np.int32)
        a, b = a + np.int32(at[0]), b + np.int32(at[1])
        upper = a <= b
        values = pa.array(r[upper], pa.float64(), mask=np.isnan(r[upper]))
        return pa.RecordBatch.from_arrays([pa.array(a[upper]), pa.array(b[upper]), values], ["a", "b", "r"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                here = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                new = {m: batch.column(m)[i].values.to_numpy() for m in MOMENTS}
                if here != at and held is not None:
                    yield scored(at, held)
                held = merge(held, new) if here == at else new
                at = here
        if held is not None:
            yield scored(at, held)

    return run


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a, b, r`` for every pair of columns by number, ``a <= b``; NULL where r is undefined.

    Null and NaN are missing and leave a row out of the pairs of that column only.
    """
    values = df.select(*(F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)))
    # A row without values: every pair of columns has a score, also of an empty table.
    none = df.sparkSession.range(1).select(*(F.lit(None).cast("double").alias(c) for c in values.columns))
    values = values.union(none)
    moments = ", ".join(f"{m} array<double>" for m in MOMENTS)
    blocks = values.mapInArrow(block_moments(len(columns)), f"a int, b int, {moments}")
    ordered = blocks.repartition("a", "b").sortWithinPartitions("a", "b")
    return ordered.mapInArrow(merge_blocks(len(columns)), "a int, b int, r double")
