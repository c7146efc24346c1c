"""Exact top-k by inner product over KD-trees, one tree per shard.

Vectors are dealt into shards of bounded size by a hash of their id. A shard's tree splits at the
median of its widest dimension and keeps tight boxes; for a query, the largest product any point of
a box could have bounds all points below. A search opens boxes best first and stops when the best
bound left is below the k-th score found. Each query first searches its own shard; the k-th score
found there then goes with it to all other shards, in blocks of queries.

All scores are integers and exact. On vectors without structure boxes overlap and the work comes
close to comparing each query with all rows, in blocks.
"""

from __future__ import annotations

import ast
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurespark.session import materialize

SHARD_ROWS = 8_192
LEAF_ROWS = 256
# Query blocks (one per shard) that meet a shard in one task.
BLOCKS_AT_ONCE = 64
# Integers below this are exact as doubles.
EXACT = 2**53

FOUND = "dim long, query long, query_id long, vec_id long, score long"
HIT = f"struct<{FOUND}>"
TREE = (
    "shard long, dim int, ids binary, numbers binary, vectors binary, kind string,"
    " low binary, high binary, children binary, spans binary"
)
BLOCK = (
    f"home long, dim int, query binary, query_id binary, vectors binary, kind string,"
    f" floor binary, hits array<{HIT}>"
)


def floored(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component, as array<long>."""
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(
        F.col(vector),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.coalesce(finite, F.lit(False))


def packed(values: np.ndarray) -> tuple[bytes, str]:
    """Integers in the smallest type that holds them."""
    least, most = values.min(initial=0), values.max(initial=0)
    kind = next(
        k
        for k in ("<i1", "<i2", "<i4", "<i8")
        if np.iinfo(k).min <= least and most <= np.iinfo(k).max
    )
    return values.astype(kind).tobytes(), kind


def unpacked(row: dict) -> np.ndarray:
    values = np.frombuffer(row["vectors"], row["kind"]).astype(np.int64)
    return values.reshape(-1, row["dim"]) if row["dim"] else values.reshape(row["rows"], 0)


class Tree:
    """A KD-tree over integer vectors whose leaves are runs of rows."""

    def __init__(self, ids, numbers, vectors, low, high, children, spans):
        self.ids, self.numbers, self.vectors = ids, numbers, vectors
        self.low, self.high, self.children, self.spans = low, high, children, spans

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int) -> Tree:
        order = np.arange(len(ids))
        low, high, children, spans = [], [], [], []

        def add(start: int, end: int) -> int:
            points = vectors[order[start:end]]
            low.append(points.min(axis=0))
            high.append(points.max(axis=0))
            children.append((-1, -1))
            spans.append((start, end))
            return len(spans) - 1

        work = [add(0, len(ids))]
        while work:
            node = work.pop()
            start, end = spans[node]
            wide = high[node] - low[node]
            if end - start <= leaf_rows or not wide.any():
                continue
            middle = (start + end) // 2
            by = vectors[order[start:end], int(wide.argmax())]
            order[start:end] = order[start:end][np.argpartition(by, middle - start)]
            children[node] = (add(start, middle), add(middle, end))
            work += children[node]
        arrays = (np.array(x, np.int64) for x in (low, high, children, spans))
        return cls(ids[order], order, vectors[order], *arrays)

    def to_row(self, shard: int) -> dict:
        vectors, kind = packed(self.vectors)
        return {
            "shard": shard,
            "dim": self.vectors.shape[1],
            "ids": self.ids.tobytes(),
            "numbers": self.numbers.tobytes(),
            "vectors": vectors,
            "kind": kind,
        } | {k: getattr(self, k).tobytes() for k in ("low", "high", "children", "spans")}

    @classmethod
    def from_row(cls, row: dict) -> Tree:
        ids, numbers, children, spans = (
            np.frombuffer(row[k], np.int64) for k in ("ids", "numbers", "children", "spans")
        )
        vectors = unpacked(row | {"rows": len(ids)})
        boxes = (np.frombuffer(row[k], np.int64).reshape(len(spans) // 2, row["dim"]) for k in ("low", "high"))
        return cls(ids, numbers, vectors, *boxes, children.reshape(-1, 2), spans.reshape(-1, 2))

    def search(
        self, query_ids: np.ndarray, queries: np.ndarray, floors: list, k: int
    ) -> list[list[tuple[int, int]]]:
        """For each query its best ``(score, -id)`` pairs, best first, not below its floor.

        Rows with the query's own id are left out.
        """
        biggest = [int(np.abs(x.astype(object)).max(initial=0)) for x in (queries, self.vectors)]
        exact = biggest[0] * biggest[1] * max(1, queries.shape[1]) < EXACT
        kind = np.float64 if exact else object
        points, q = self.vectors.astype(kind), queries.astype(kind)
        low, high = self.low.astype(kind), self.high.astype(kind)
        if len(self.ids) == 0 or len(q) == 0:
            return [[] for _ in range(len(q))]
        bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        return [
            self._best(int(query_ids[i]), q[i], bounds[i], floors[i], points, k)
            for i in range(len(q))
        ]

    def _best(self, own, query, bounds, floor, points, k) -> list[tuple[int, int]]:
        kept: list[tuple[int, int]] = []
        open_boxes = [(-bounds[0], 0)]
        while open_boxes:
            bound, node = heapq.heappop(open_boxes)
            if floor is not None and -bound < floor:
                break
            left, right = self.children[node]
            if left >= 0:
                for child in (int(left), int(right)):
                    if floor is None or bounds[child] >= floor:
                        heapq.heappush(open_boxes, (-bounds[child], child))
                continue
            start, end = self.spans[node]
            scores = points[start:end] @ query
            good = self.ids[start:end] != own
            if floor is not None:
                good &= scores >= floor
            places = np.flatnonzero(good)
            if len(places) > k:
                # More than k points of one leaf: the k best, and all that tie with the last.
                edge = np.partition(scores[places], len(places) - k)[len(places) - k]
                places = places[scores[places] >= edge]
            kept += [(int(scores[p]), -int(self.ids[start + p])) for p in places]
            if len(kept) >= k:
                kept = heapq.nlargest(k, kept)
                floor = kept[-1][0]
        return heapq.nlargest(k, kept)


def _dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def build_shards(leaf_rows: int, schema: pa.Schema):
    """Arrow function from rows sorted by (dim, shard, id) to one tree per (dim, shard)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors = None, [], []

        def built() -> pa.RecordBatch:
            points = np.array(vectors, np.int64).reshape(len(ids), key[0])
            tree = Tree.build(np.array(ids, np.int64), points, leaf_rows)
            return pa.RecordBatch.from_pylist([tree.to_row(key[1])], schema)

        for batch in batches:
            for dim, shard, id_, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (dim, shard):
                    if ids:
                        yield built()
                    key, ids, vectors = (dim, shard), [], []
                ids.append(id_)
                vectors.append(vector)
        if ids:
            yield built()

    return run


def _hits(dim, query, query_ids, found) -> list[dict]:
    return [
        {"dim": dim, "query": int(q), "query_id": int(own), "vec_id": -negative, "score": score}
        for q, own, best in zip(query, query_ids, found, strict=True)
        for score, negative in best
    ]


def home_search(every: int, k: int, schema: pa.Schema):
    """Arrow function from trees to their own queries, with what these find at home."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _dicts(batches):
            tree = Tree.from_row(row)
            mine = np.flatnonzero(tree.ids % every == 0)
            if not len(mine):
                continue
            ids, vectors = tree.ids[mine], tree.vectors[mine]
            # The number of a row, within its dimension, tells rows of one id apart.
            query = row["shard"] * SHARD_LIMIT + tree.numbers[mine]
            found = tree.search(ids, vectors, [None] * len(mine), k)
            floors = [best[-1][0] if len(best) == k else None for best in found]
            text, kind = packed(vectors)
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "home": row["shard"],
                        "dim": row["dim"],
                        "query": query.tobytes(),
                        "query_id": ids.tobytes(),
                        "vectors": text,
                        "kind": kind,
                        "floor": repr(floors).encode(),
                        "hits": _hits(row["dim"], query, ids, found),
                    }
                ],
                schema,
            )

    return run


# Rows of a shard are numbered below this.
SHARD_LIMIT = 1 << 24


def search_elsewhere(k: int):
    """Cogrouped Arrow function: query blocks against the one tree of a shard."""
    schema = pa.schema([(c, pa.int64()) for c in ("dim", "query", "query_id", "vec_id", "score")])

    def run(blocks: pa.Table, trees: pa.Table) -> pa.Table:
        hits = []
        for tree in (Tree.from_row(row) for row in _dicts(trees.to_batches())):
            for row in _dicts(blocks.to_batches()):
                query, ids = (np.frombuffer(row[c], np.int64) for c in ("query", "query_id"))
                vectors = unpacked(row | {"rows": len(ids)})
                floors = ast.literal_eval(row["floor"].decode())
                hits += _hits(row["dim"], query, ids, tree.search(ids, vectors, floors, k))
        return pa.Table.from_pylist(hits, schema)

    return run


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those of
    the query's id. The score is the inner product of floor(``scale`` * x), ties go to the smaller
    id, and ranks start at 1. Rows with a null id, a null vector or one with null or non-finite
    components take no part; vectors meet those of their own length only. Repeated rows count once;
    rows of one id with different vectors are queries of their own. An empty table gives no rows.
    Scores beyond a long raise. Other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    rows = (
        vectors.where(F.col(id_col).isNotNull() & usable(vector_col))
        .select(F.col(id_col).cast("long").alias("id"), floored(vector_col, scale).alias("v"))
        .dropDuplicates(["id", "v"])
    )
    n = -(-rows.count() // shard_rows) or 1
    dealt = rows.select(
        F.size("v").alias("dim"), F.pmod(F.xxhash64("id", "v"), F.lit(n)).alias("shard"), "id", "v"
    )

    def arrow(ddl: str) -> pa.Schema:
        return to_arrow_schema(StructType.fromDDL(ddl))

    trees = materialize(
        dealt.repartition("dim", "shard")
        .sortWithinPartitions("dim", "shard", "id", "v")
        .mapInArrow(build_shards(leaf_rows, arrow(TREE)), TREE),
        "kd-trees",
    )
    # One tree or block a partition of bounded rows: blobs never gather in one Arrow batch.
    blocks = materialize(
        trees.repartition("dim", "shard").mapInArrow(home_search(every, k, arrow(BLOCK)), BLOCK),
        "kd-queries",
    )
    batch = F.floor(F.col("home") / BLOCKS_AT_ONCE)
    sent = blocks.drop("hits").withColumns(
        {"batch": batch, "shard": F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))}
    )
    met = trees.withColumn(
        "batch",
        F.explode(F.sequence(F.lit(0), F.lit((n - 1) // BLOCKS_AT_ONCE)).cast("array<long>")),
    )
    key = ["dim", "shard", "batch"]
    elsewhere = (
        sent.where("shard <> home")
        .groupBy(*key)
        .cogroup(met.groupBy(*key))
        .applyInArrow(search_elsewhere(k), FOUND)
    )
    home = blocks.select(F.explode("hits").alias("h")).select("h.*")
    best = Window.partitionBy("dim", "query").orderBy(F.desc("score"), "vec_id")
    return (
        home.unionByName(elsewhere)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
