"""Nearest neighbours, exact or by bucketed random projections, and distance-weighted votes.

Equal vectors are merged first, keeping the few smallest ids that can ever be neighbours, so
copies cost nothing. The distinct vectors are split into cells around pivots. A query visits
only the cells that the triangle inequality cannot rule out, and (cell, query) blocks of bounded
size are compared with NumPy; each block passes on k neighbours per query, never all pairs.

With :class:`Projections` the cells are buckets of random projections instead: a query meets the
vectors that share a bucket with it in one of several tables, and some neighbours may be missed.

Inside a block a matrix product in single precision rules out the vectors that its rounding error
cannot bring among the k nearest; the few that are left are measured by direct differences.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurespark.functions.vectors import l2_normalize
from featurespark.session import bounded_side, materialize

DISTANCE_DIGITS = 9
MAX_PIVOTS = 4096
# Blocks a side into which rows fall before blocks grow, and rows that a block may grow to.
MANY_BLOCKS = 8
HELD_ROWS = 65_536
_SLACK = 1e-8
_TILE_VALUES = 4_000_000
# Queries and references that meet in one matrix product.
_QUERIES, _REFS = 256, 2048


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all rows of b, by direct differences."""
    out = np.empty((len(a), len(b)))
    step = max(1, _TILE_VALUES // max(1, b.size))
    for i in range(0, len(a), step):
        gap = a[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
    return out


@dataclass(frozen=True)
class Projections:
    """Bucketed random projections: more tables find more, more projections compare less.

    ``width`` is the length of a bucket; without one it is four times the median distance of the
    k-th neighbour, measured between at most ``SAMPLE_QUERIES`` and ``SAMPLE_POINTS`` vectors.
    """

    tables: int = 12
    projections: int = 3
    width: float | None = None
    seed: int = 54321


SAMPLE_QUERIES, SAMPLE_POINTS = 256, 4096


def _points(df: DataFrame, id_col: str, label: str, vector: Column, keep: int) -> DataFrame:
    """Distinct vectors: ``point`` (smallest id), ``vec`` and up to ``keep`` members."""
    rows = df.select(F.col(id_col).alias("id"), F.col(label).alias("label"), vector.alias("vec"))
    order = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    return (
        rows.where(F.col("vec").isNotNull())
        .withColumn("_rank", order)
        .where(F.col("_rank") <= keep)
        .groupBy("vec")
        .agg(
            F.min("id").alias("point"),
            F.sort_array(F.collect_list(F.struct("id", "label"))).alias("members"),
        )
    )


def _assign_cells(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d = _distances(_stack(batch["vec"]), pivots)
                cell = d.argmin(axis=1)
                batch["cell"] = cell.astype(np.int32)
                batch["to_pivot"] = d[np.arange(len(d)), cell]
                yield batch

    schema = f"point {dict(points.dtypes)['point']}, vec array<double>, cell int, to_pivot double"
    return points.select("point", "vec").mapInPandas(nearest, schema)


def _visits(assigned: DataFrame, pivots: np.ndarray, cells: pd.DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each query with every cell that may hold one of its neighbours, and ``cell, n``, their number.

    Both are routed when they are read: a vector is copied only on its way to its blocks.
    """
    ids = cells["cell"].to_numpy()
    at = pivots[ids]
    near, far = cells["near"].to_numpy(), cells["far"].to_numpy()
    kth = cells["kth"].to_numpy(dtype=float)

    def visited(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        d = _distances(_stack(batch["vec"]), at)
        # k known points of one cell bound the distance of the k-th neighbour.
        reach = np.nanmin(np.where(np.isnan(kth), np.inf, d + kth), axis=1)
        lowest = np.maximum(d - far, near - d)
        return np.nonzero(lowest <= reach[:, None] + _SLACK)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            q, c = visited(batch)
            yield pd.DataFrame(
                {
                    "cell": ids[c].astype(np.int32),
                    "query": batch["point"].to_numpy()[q],
                    "q_vec": batch["vec"].to_numpy()[q],
                }
            )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(len(ids), np.int64)
        for batch in batches:
            if len(batch):
                n += np.bincount(visited(batch)[1], minlength=len(ids))
        yield pd.DataFrame({"cell": ids[n > 0].astype(np.int32), "n": n[n > 0]})

    points = assigned.select("point", "vec")
    schema = f"cell int, query {dict(assigned.dtypes)['point']}, q_vec array<double>"
    counts = points.mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    return points.mapInPandas(route, schema), counts


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    widths = np.diff(lists.offsets.to_numpy())
    if len(widths) and (widths != widths[0]).any():
        raise ValueError("vectors differ in length")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _measured(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Rounded distances of the rows ``i`` of a to the rows ``j`` of b, by direct differences."""
    out = np.empty(len(i))
    step = max(1, _TILE_VALUES // max(1, a.shape[1]))
    for start in range(0, len(i), step):
        gap = a[i[start : start + step]] - b[j[start : start + step]]
        out[start : start + step] = np.sqrt(np.square(gap).sum(axis=1))
    return np.round(out, DISTANCE_DIGITS)


def _nearest(k: int, q: np.ndarray, r: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
    """The k nearest of each query; equal distances keep the smallest numbers."""
    order = np.lexsort((r, d, q))
    q, r, d = q[order], r[order], d[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], r[keep], d[keep]


class _References:
    """The vectors of a block, centred and scaled, and dealt into tiles that each span the block."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        n = len(vectors)
        tiles = math.ceil(n / _REFS)
        self.tiles = [np.arange(t, n, tiles) for t in range(tiles)]
        with np.errstate(over="ignore", invalid="ignore"):
            self.centre = vectors.mean(axis=0)
            shifted = vectors - self.centre
            self.scale = float(np.sqrt(np.square(shifted).sum(axis=1).max()))
        # Neither alike nor beyond all numbers: otherwise every pair is measured.
        self.can_rule_out = 0 < self.scale < 1e150
        if self.can_rule_out:
            self.shifted = shifted / self.scale
            self.sides = {}

    def side(self, kind) -> list[np.ndarray]:
        """By tile, what times (-query, 1) is half of: squared distance less the query's square."""
        if kind not in self.sides:
            half = np.square(self.shifted).sum(axis=1) / 2
            side = np.column_stack([self.shifted, half]).astype(kind)
            self.sides[kind] = [np.ascontiguousarray(side[t].T) for t in self.tiles]
        return self.sides[kind]

    def nearest(self, k: int, queries: np.ndarray) -> tuple[np.ndarray, ...]:
        """Query, reference and distance of the k nearest references of each query."""
        if self.can_rule_out:
            with np.errstate(over="ignore", invalid="ignore"):
                shifted = (queries - self.centre) / self.scale
                squares = np.square(shifted).sum(axis=1)
            if squares.max() < 1e30:
                for kind in (np.float32, np.float64):
                    found = self.ruled_out(k, queries, shifted, squares, kind)
                    if found is not None:
                        return found
        found = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.float64))
        for tile in self.tiles:
            q = np.repeat(np.arange(len(queries)), len(tile))
            found = self.merged(k, found, queries, q, np.tile(tile, len(queries)))
        return found

    def merged(self, k: int, found, queries: np.ndarray, q: np.ndarray, r: np.ndarray):
        new = q, r, _measured(queries, self.vectors, q, r)
        return _nearest(k, *(np.concatenate(pair) for pair in zip(found, new, strict=True)))

    def ruled_out(self, k: int, queries, shifted, squares, kind):
        """As :meth:`nearest`; None if single precision is too coarse for these distances."""
        side = np.column_stack([-shifted, np.ones(len(shifted))]).astype(kind)
        # Rounding of a product of this width, and of its sides; scaled references have length 1 at most.
        slack = 4 * (shifted.shape[1] + 8) * np.finfo(kind).eps * (np.sqrt(squares) + 1)
        # Distances that round alike are equal.
        alike = 2 * 10.0**-DISTANCE_DIGITS / self.scale
        found = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.float64))
        kth = np.full(len(queries), np.inf)
        for tile, refs in zip(self.tiles, self.side(kind), strict=True):
            score = side @ refs
            bound = kth
            if np.isinf(kth).any() and len(tile) >= k:
                least = np.partition(score, k - 1, axis=1)[:, k - 1].astype(np.float64)
                bound = np.minimum(kth, np.sqrt(np.maximum(2 * (least + slack) + squares, 0)))
            if kind is np.float32 and np.mean(slack > 0.01 * bound**2) > 0.1:
                return None
            limit = ((bound + alike) ** 2 - squares) / 2 + slack
            at = np.flatnonzero(score <= limit.astype(kind)[:, None])
            if len(at):
                q, r = np.divmod(at, len(tile))
                found = self.merged(k, found, queries, q, tile[r])
                full = np.searchsorted(found[0], np.arange(len(queries)), side="right")
                held = np.diff(np.append(0, full))
                kth[held == k] = found[2][full[held == k] - 1] / self.scale
        return found


def _compare_blocks(k: int, schema: pa.Schema):
    def compare(refs: pa.Table, queries: pa.Table) -> pa.Table:
        if not refs.num_rows or not queries.num_rows:
            return schema.empty_table()
        # In the order of ids: equal distances keep the smallest.
        refs = refs.sort_by("point")
        known, asked = _References(_matrix(refs["vec"])), _matrix(queries["q_vec"])
        parts = []
        for start in range(0, len(asked), _QUERIES):
            q, r, d = known.nearest(min(k, refs.num_rows), asked[start : start + _QUERIES])
            ids = queries["query"].take(pa.array(q + start)), refs["point"].take(pa.array(r))
            parts.append(pa.table([*ids, pa.array(d)], names=["query", "point", "distance"]))
        return pa.concat_tables(parts).cast(schema)

    return compare


def _routed(
    points: DataFrame, wanted: int, need: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Points by the cell of their nearest pivot, queries with the cells they visit, and visits per cell."""
    chosen = points.orderBy(F.xxhash64("point"), "point").limit(wanted).select("vec")
    pivots = np.array([r["vec"] for r in chosen.collect()], dtype=np.float64)
    assigned = materialize(_assign_cells(points, pivots), "knn-cells")

    in_cell = F.row_number().over(Window.partitionBy("cell").orderBy("to_pivot"))
    kth = (
        assigned.select("cell", "to_pivot", in_cell.alias("_rank"))
        .where(F.col("_rank") <= need)
        .groupBy("cell")
        .agg(F.max(F.when(F.col("_rank") == need, F.col("to_pivot"))).alias("kth"))
    )
    # One row per pivot, at most MAX_PIVOTS.
    cells = (
        assigned.groupBy("cell")
        .agg(
            F.count(F.lit(1)).alias("n_refs"),
            F.min("to_pivot").alias("near"),
            F.max("to_pivot").alias("far"),
        )
        .join(kth, "cell")
        .toPandas()
        .sort_values("cell", ignore_index=True)
    )
    return assigned, *_visits(assigned, pivots, cells)


def _bucket_width(points: DataFrame, need: int) -> float:
    """Four times the median distance of the k-th neighbour, estimated on a bounded sample."""
    sample = points.orderBy(F.xxhash64("point"), "point").limit(SAMPLE_POINTS).select("vec").toPandas()
    vectors = _stack(sample["vec"])
    d = np.sort(_distances(vectors[:SAMPLE_QUERIES], vectors), axis=1)[:, 1:]
    # Among fewer vectors neighbours are farther; the nearest one stands for the k-th of all.
    kth = d[:, min(need, d.shape[1]) - 1] if d.shape[1] else np.ones(1)
    return float(4 * np.median(kth)) or 1.0


def _projected(points: DataFrame, how: Projections, need: int) -> DataFrame:
    """``cell, point, vec``: every vector in one bucket of each table."""
    dimensions = points.select(F.size("vec")).first()[0]
    width = how.width or _bucket_width(points, need)
    chance = np.random.default_rng(how.seed)
    shape = (dimensions, how.tables * how.projections)
    directions = chance.normal(size=shape) / width
    shifts = chance.random(shape[1])
    factors = chance.integers(-(2**62), 2**62, shape[1], dtype=np.int64) | 1
    names = chance.integers(-(2**62), 2**62, how.tables, dtype=np.int64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            at = np.floor(_stack(batch["vec"]) @ directions + shifts).astype(np.int64)
            cells = (at * factors).reshape(len(batch), how.tables, -1).sum(axis=2) + names
            rows = np.repeat(np.arange(len(batch)), how.tables)
            yield pd.DataFrame(
                {
                    "cell": cells.ravel(),
                    "point": batch["point"].to_numpy()[rows],
                    "vec": batch["vec"].to_numpy()[rows],
                }
            )

    schema = f"cell long, point {dict(points.dtypes)['point']}, vec array<double>"
    return points.select("point", "vec").mapInPandas(place, schema)


def nearest_neighbours(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    label_col: str,
    k: int = 5,
    exclude_self: bool = False,
    normalize: bool = True,
    block_rows: int = 16_384,
    n_pivots: int | None = None,
    approximate: Projections | None = None,
) -> DataFrame:
    """``id, label, neighbours``: the k nearest rows of every row, ordered by distance, then id.

    ``neighbours`` is array<struct<distance, id, label>>; distances are rounded to 9 digits
    before comparing. ``id_col`` must be unique. Rows without a vector are left out; rows whose
    vector has a null, NaN or infinite component are nobody's neighbours and have none.
    With ``approximate`` neighbours are sought in shared buckets only, and may be fewer or farther.
    A block has ``block_rows`` rows; above ``MANY_BLOCKS`` of these blocks grow, up to ``HELD_ROWS``,
    so that a row is not copied to ever more blocks.
    """
    vector = F.col(vector_col).cast("array<double>")
    if normalize:
        vector = l2_normalize(vector)
    need = k + 1 if exclude_self else k
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    points = materialize(_points(df.where(finite), id_col, label_col, vector, need), "knn-points")
    n = points.count()
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vec"))
    kinds = dict(rows.dtypes)
    none = F.array().cast(f"array<struct<distance:double,id:{kinds['id']},label:{kinds['label']}>>")
    # A vector with a null component is neither finite nor not finite: it has no neighbours too.
    lonely = rows.where(F.col("vec").isNotNull() & ~F.coalesce(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
        F.lit(False),
    )).select("id", "label", none.alias("neighbours"))
    if not n:
        return lonely
    size = max(block_rows, min(HELD_ROWS, math.ceil(n / MANY_BLOCKS)))
    wanted = n_pivots or min(MAX_PIVOTS, math.ceil(n / block_rows))
    if approximate:
        assigned = materialize(_projected(points, approximate, need), "knn-buckets")
        visits = assigned.select(*(F.col(c).alias(n) for c, n in (("cell", "cell"), ("point", "query"), ("vec", "q_vec"))))
    elif wanted > 1:
        assigned, visits, n_visits = _routed(points, wanted, need)
    else:
        # One cell: every query meets every point, and nothing has to be routed.
        assigned = points.select("point", "vec", F.lit(0).alias("cell"))
        visits = points.select(
            F.lit(0).alias("cell"), F.col("point").alias("query"), F.col("vec").alias("q_vec")
        )

    def blocks_of(counts: DataFrame, name: str) -> DataFrame:
        return counts.select("cell", F.ceil(F.col("n") / F.lit(size)).cast("int").alias(name))

    n_points = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    if approximate or wanted <= 1:
        n_visits = n_points
    blocks = blocks_of(n_points, "ref_blocks").join(blocks_of(n_visits, "query_blocks"), "cell")
    blocks = bounded_side(blocks)

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    refs = assigned.join(blocks, "cell").select(
        "cell",
        F.pmod(F.xxhash64("point"), F.col("ref_blocks")).cast("int").alias("ref_block"),
        every("query_blocks").alias("query_block"),
        "point",
        "vec",
    )
    queries = visits.join(blocks, "cell").select(
        "cell",
        every("ref_blocks").alias("ref_block"),
        F.pmod(F.xxhash64("query"), F.col("query_blocks")).cast("int").alias("query_block"),
        "query",
        "q_vec",
    )
    keys = ["cell", "ref_block", "query_block"]
    id_type = dict(points.dtypes)["point"]
    none_found = points.select(F.col("point").alias("query"), "point", F.lit(0.0).alias("distance")).limit(0)
    found = (
        refs.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInArrow(_compare_blocks(need, none_found.toArrow().schema), none_found.schema)
    )
    # Two blocks or tables may find the same pair, at the same distance: one place in the order.
    order = F.dense_rank().over(Window.partitionBy("query").orderBy("distance", "point"))
    best = found.withColumn("_rank", order).where(F.col("_rank") <= need).drop("_rank")
    if approximate:
        best = best.dropDuplicates(["query", "point"])
    # At most k + 1 points of k + 1 members each per query.
    members = (
        best.join(points.select("point", "members"), "point")
        .select("query", "distance", F.inline("members"))
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("distance", "id", "label"))).alias("near"))
    )
    # Rows meet their point by a short key, written on one side, so that copies can be split.
    by_point = points.select(F.col("point").alias("query"), F.sha2(_text("vec"), 256).alias("key"))
    near_by_key = materialize(by_point.join(members, "query").select("key", "near"), "knn-near")
    near = F.col("near")
    if exclude_self:
        near = F.filter(near, lambda x: x["id"] != F.col("id"))
    keyed = rows.select("id", "label", F.sha2(_text("vec"), 256).alias("key"))
    found = keyed.join(near_by_key, "key").select("id", "label", F.slice(near, 1, k).alias("neighbours"))
    return found.unionByName(lonely)


def _text(vector: str) -> Column:
    """A vector as text that is equal where its values are; negative zeros are zeros."""
    return F.array_join(F.transform(vector, lambda x: (x + 0.0).cast("string")), ",").cast("binary")


def class_weights(neighbours: DataFrame) -> DataFrame:
    """Add ``votes``, array<struct<label, weight>>: 1 / distance, or only exact matches if any."""
    near = F.col("neighbours")
    exact = F.exists(near, lambda x: x["distance"] == 0.0)

    def weight(x: Column) -> Column:
        inverse = F.when(x["distance"] > 0.0, 1.0 / x["distance"]).otherwise(0.0)
        return F.when(exact, (x["distance"] == 0.0).cast("double")).otherwise(inverse)

    def vote(label: Column) -> Column:
        own = F.filter(near, lambda x: x["label"] == label)
        total = F.aggregate(own, F.lit(0.0), lambda acc, x: acc + weight(x))
        return F.struct(label.alias("label"), total.alias("weight"))

    labels = F.array_sort(F.array_distinct(F.transform(near, lambda x: x["label"])))
    return neighbours.withColumn("votes", F.transform(labels, vote))


def knn_classify(df: DataFrame, id_col: str, vector_col: str, label_col: str, **options) -> DataFrame:
    """``id, label, predicted``; equal votes (to 9 digits) go to the smallest label."""
    votes = class_weights(nearest_neighbours(df, id_col, vector_col, label_col, **options))
    ranked = F.transform(
        "votes",
        lambda v: F.struct((-F.round(v["weight"], DISTANCE_DIGITS)).alias("w"), v["label"]),
    )
    return votes.select("id", "label", F.array_min(ranked)["label"].alias("predicted"))


def knn_probabilities(
    df: DataFrame, id_col: str, vector_col: str, label_col: str, **options
) -> DataFrame:
    """``id, class, probability`` for the classes with a positive probability."""
    votes = class_weights(nearest_neighbours(df, id_col, vector_col, label_col, **options))
    total = F.aggregate("votes", F.lit(0.0), lambda acc, v: acc + v["weight"])
    return (
        votes.select("id", total.alias("total"), F.inline("votes"))
        .where(F.col("weight") > 0)
        .select("id", F.col("label").alias("class"), (F.col("weight") / F.col("total")).alias("probability"))
    )
