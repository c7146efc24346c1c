"""Best-fit packing in rounds: local bins first, then the underfull bins as items of their own.

Round 0 runs where the documents are read: each task turns its texts into pieces of ids and packs
them best-fit, longest first. Bins with hardly any room left are done. The others move on as solid
items: they are dealt anew into ever fewer groups, each small enough for one task, and packed
best-fit again, until one group holds them all or a round has nothing left to gain. Only lengths
and bin numbers move, never ids or texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurespark.llm.byte_tokens import byte_encoder, piece_starts, with_end
from featurespark.llm.common import slices, text_or_empty
from featurespark.session import materialize

# Pieces or bins that one task packs together, and documents it takes at a time.
GROUP_ITEMS = 200_000
ROWS_AT_ONCE = 256
# A bin with at most this share of its capacity left is done.
NEARLY_FULL = 1 / 128
# A round that saves less than this share of its bins is the last.
LEAST_GAIN = 0.005
PIECE_SCHEMA = (
    "id_row long, piece int, start long, length long, ids_crc32 long, bin long, place long, fill long"
)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin numbers from 0 and offsets of the items, packed best-fit by falling size.

    Bins are stacked by the room they have left; one bit per room says which stacks hold any, so
    the tightest bin is the lowest set bit at or above the size.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, 0
    bin_of, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            target = stacks[room].pop()
            if not stacks[room]:
                rooms &= ~(1 << room)
        else:
            room, target, bins = capacity, bins, bins + 1
        left = room - size
        if left:
            stacks[left].append(target)
            rooms |= 1 << left
        bin_of[i], offset[i] = target, capacity - room
    return bin_of, offset


def first_number(chunk: int) -> int:
    """The first of a range of numbers that only this task and chunk use."""
    return (TaskContext.get().partitionId() << 40) + (chunk << 24)


def fills(bin_of: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each item, how full its bin is."""
    return np.bincount(bin_of, weights=sizes).astype(np.int64)[bin_of] if len(bin_of) else sizes


def packed_pieces(tokenizer_path: str, capacity: int, end_id: int, id_type: pa.DataType):
    """Arrow function for round 0, from (id, text) to pieces with bin, place and fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(tokenizer_path)
        chunk = 0

        def packed(ids: list, rows: list) -> pa.RecordBatch:
            table = np.array(rows, np.int64).reshape(-1, 4)
            bin_of, place = best_fit(table[:, 2], capacity)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, id_type),
                    pa.array(table[:, 0].astype(np.int32)),
                    *(pa.array(table[:, k]) for k in (1, 2, 3)),
                    pa.array(bin_of + first_number(chunk)),
                    pa.array(place),
                    pa.array(fills(bin_of, table[:, 2])),
                ],
                ["id", "piece", "start", "length", "ids_crc32", "bin", "place", "fill"],
            )

        ids, rows = [], []
        for batch in slices(batches, ROWS_AT_ONCE):
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = with_end(encode(text.as_py()), end_id).astype("<u4")
                starts = piece_starts(len(tokens), capacity, short_first=True)
                for piece, (start, end) in enumerate(
                    zip(starts, [*starts[1:], len(tokens)], strict=True)
                ):
                    ids.append(id_)
                    rows.append((piece, start, end - start, zlib.crc32(tokens[start:end])))
            if len(rows) >= GROUP_ITEMS:
                yield packed(ids, rows)
                ids, rows, chunk = [], [], chunk + 1
        if rows:
            yield packed(ids, rows)

    return run


def packed_bins(capacity: int):
    """Arrow function for a later round, from (bin, fill) to (bin, parent, shift, fill)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, GROUP_ITEMS):
            bins = batch.column("bin").to_numpy()
            sizes = batch.column("fill").to_numpy()
            bin_of, shift = best_fit(sizes, capacity)
            parent = np.empty(len(bins), np.int64)
            # A bin goes by the number of the item at its start.
            parent[bin_of[shift == 0]] = bins[shift == 0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bins),
                    pa.array(parent[bin_of]),
                    pa.array(shift),
                    pa.array(fills(bin_of, sizes)),
                ],
                ["bin", "parent", "shift", "fill"],
            )

    return run


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches of a task joined into tables of about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def merged_bins(bins: DataFrame, capacity: int, group_items: int) -> DataFrame | None:
    """``bin, final, moved``: where the underfull bins end up after all rounds of merging."""
    least = capacity - int(capacity * NEARLY_FULL)
    items = bins.where(F.col("fill") < least)
    moves, rounds = None, 0
    while (n := items.count()) > 1:
        groups = -(-n // group_items)
        # Another deal each round, so that other bins meet.
        dealt = items.repartition(groups, F.xxhash64("bin", F.lit(rounds)))
        step = materialize(
            dealt.sortWithinPartitions(F.col("fill").desc(), "bin").mapInArrow(
                packed_bins(capacity), "bin long, parent long, shift long, fill long"
            ),
            "packing-round",
        )
        here = step.select("bin", F.col("parent").alias("final"), F.col("shift").alias("moved"))
        if moves is None:
            moves = here
        else:
            later = here.select(
                F.col("bin").alias("final"), F.col("final").alias("next"), F.col("moved").alias("by")
            )
            moves = moves.join(later, "final", "left").select(
                "bin",
                F.coalesce("next", "final").alias("final"),
                (F.col("moved") + F.coalesce("by", F.lit(0))).alias("moved"),
            )
        kept = step.where("bin = parent").select("bin", "fill").where(F.col("fill") < least)
        rounds += 1
        if groups == 1 or step.where("bin = parent").count() > n * (1 - LEAST_GAIN):
            break
        items = kept
    return moves


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` ids.

    ``id_col, piece, start, length, ids_crc32, sequence_id, offset``: a document is its ids
    followed by ``end_id``; only documents longer than ``capacity`` are cut, into pieces of
    ``capacity`` of which the first may be shorter. Within a sequence the pieces lie gapless from
    offset 0. Null texts count as empty and give one piece, the end id alone. Null ids and repeated
    rows are packed like any other row; an empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = PIECE_SCHEMA.replace("id_row long", f"id {kind.simpleString()}")
    local = packed_pieces(tokenizer_path, capacity, end_id, to_arrow_type(kind))
    pieces = materialize(rows.mapInArrow(local, schema), "packing-pieces")
    moves = merged_bins(pieces.where("place = 0").select("bin", "fill"), capacity, group_items)
    if moves is None:
        moves = pieces.sparkSession.createDataFrame([], "bin long, final long, moved long")
    return pieces.join(moves, "bin", "left").select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("final", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("moved", F.lit(0))).alias("offset"),
    )
