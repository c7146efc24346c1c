"""Packed id matrices: best-fit decreasing with a segment tree over capacities.

Texts become pieces of at most ``capacity`` ids. Pieces are dealt into shards of bounded size,
sorted by falling length within each by Spark, and streamed through the packer: a segment tree over
the room that open bins have left finds the tightest bin in logarithmic time. A full bin leaves at
once, the others at the end of their shard.

A row of the result is one row of the matrix: ids padded to ``capacity``, the cumulative segment
lengths, and the positions, which start anew at every segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from featurespark.llm.byte_tokens import byte_encoder, piece_starts, vocabulary_size, with_end
from featurespark.llm.common import slices, text_or_empty

# Bytes of text whose pieces one shard holds on average, and documents a worker takes at a time.
SHARD_BYTES = 32 << 20
ROWS_AT_ONCE = 128
SEQUENCES_AT_ONCE = 256


class CapacityTree:
    """How many open bins have how much room, as a segment tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += n
            at >>= 1

    def tightest(self, size: int) -> int:
        """The least room of at least ``size`` that an open bin has; -1 if there is none."""
        count, at = self.count, size + self.leaves
        if not count[at]:
            while at & 1 or not count[at + 1]:
                at >>= 1
                if at <= 1:
                    return -1
            at += 1
            while at < self.leaves:
                at *= 2
                if not count[at]:
                    at += 1
        return at - self.leaves


class Packer:
    """Best-fit bins over pieces that come longest first."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.tree = CapacityTree(capacity)
        self.open: list[list[list]] = [[] for _ in range(capacity + 1)]

    def put(self, piece, size: int) -> list | None:
        """Place a piece; the bin, if it is full now."""
        room = self.tree.tightest(size)
        if room < 0:
            room, held = self.capacity, []
        else:
            held = self.open[room].pop()
            self.tree.add(room, -1)
        held.append(piece)
        if room == size:
            return held
        self.open[room - size].append(held)
        self.tree.add(room - size, 1)
        return None

    def rest(self) -> Iterator[list]:
        for bins in self.open:
            yield from bins


def id_type(tokenizer_path: str) -> str:
    """The smallest little-endian type that holds every id of the vocabulary."""
    return "<u2" if vocabulary_size(tokenizer_path) <= 1 << 16 else "<u4"


def cut_pieces(tokenizer_path: str, capacity: int, end_id: int, kind: pa.DataType):
    """Arrow function from (id, text) to pieces (id, piece, start, length, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, dtype = byte_encoder(tokenizer_path), id_type(tokenizer_path)
        for batch in slices(batches, ROWS_AT_ONCE):
            rows = []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = with_end(encode(text.as_py()), end_id).astype(dtype)
                starts = piece_starts(len(ids), capacity, short_first=False)
                for piece, start in enumerate(starts):
                    part = ids[start : start + capacity]
                    rows.append((id_, piece, start, len(part), part.tobytes()))
            kinds = (kind, pa.int32(), pa.int64(), pa.int32(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids"])

    return run


def pack_shards(capacity: int, pad_id: int, dtype: str, schema: pa.Schema):
    """Arrow function from pieces sorted by shard and falling length to matrix rows."""

    def matrix_row(shard: int, number: int, held: list) -> dict:
        lengths = [p[3] for p in held]
        ids = np.full(capacity, pad_id, dtype)
        ids[: sum(lengths)] = np.frombuffer(b"".join(p[4] for p in held), dtype)
        positions = np.zeros(capacity, "<u4")
        positions[: sum(lengths)] = np.concatenate([np.arange(n) for n in lengths])
        return {
            "sequence_id": (shard << 32) + number,
            "n_tokens": sum(lengths),
            "cu_seqlens": [0, *np.cumsum(lengths).tolist()],
            "segments": [{"id": p[0], "piece": p[1], "start": p[2]} for p in held],
            "input_ids": ids.tobytes(),
            "position_ids": positions.tobytes(),
        }

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shard, packer, number = None, None, 0
        for batch in slices(batches, ROWS_AT_ONCE):
            for of, *piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != shard:
                    for held in packer.rest() if packer else ():
                        yield matrix_row(shard, number, held)
                        number += 1
                    shard, packer, number = of, Packer(capacity), 0
                full = packer.put(piece, piece[3])
                if full:
                    yield matrix_row(shard, number, full)
                    number += 1
        for held in packer.rest() if packer else ():
            yield matrix_row(shard, number, held)
            number += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in finished(batches):
            rows.append(row)
            if len(rows) == SEQUENCES_AT_ONCE:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def pack_matrices(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 50256,
    pad_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per sequence: ``sequence_id, n_tokens, cu_seqlens, segments, input_ids, position_ids``.

    A document is its ids and ``end_id``; one longer than ``capacity`` is cut without loss into
    pieces of ``capacity`` and a last shorter one. ``input_ids`` holds ``capacity`` little-endian
    ids (16 bit if the vocabulary allows, else 32), padded with ``pad_id``; ``position_ids`` as
    many 32-bit positions, zero at every segment start and in the padding. ``segments`` gives id,
    piece and start of each segment. Null texts count as empty and give the end id alone; null ids
    and repeated rows are packed like any other; an empty table gives no rows. Other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = -(-size // shard_bytes) or 1
    kind = docs.schema[id_col].dataType
    name = kind.simpleString()
    pieces = rows.mapInArrow(
        cut_pieces(tokenizer_path, capacity, end_id, to_arrow_type(kind)),
        f"id {name}, piece int, start long, length int, ids binary",
    )
    shard = F.pmod(F.xxhash64("id", "piece", F.crc32("ids")), F.lit(shards))
    ordered = (
        pieces.select(shard.alias("shard"), "id", "piece", "start", "length", "ids")
        .repartition("shard")
        .sortWithinPartitions("shard", F.desc("length"), "id", "piece")
    )
    schema = pa.schema(
        [
            ("sequence_id", pa.int64()),
            ("n_tokens", pa.int32()),
            ("cu_seqlens", pa.list_(pa.int32())),
            (
                "segments",
                pa.list_(
                    pa.struct(
                        [("id", to_arrow_type(kind)), ("piece", pa.int32()), ("start", pa.int64())]
                    )
                ),
            ),
            ("input_ids", pa.binary()),
            ("position_ids", pa.binary()),
        ]
    )
    return ordered.mapInArrow(
        pack_shards(capacity, pad_id, id_type(tokenizer_path), schema),
        "sequence_id long, n_tokens int, cu_seqlens array<int>,"
        f" segments array<struct<id:{name},piece:int,start:long>>,"
        " input_ids binary, position_ids binary",
    )


def write_matrices(docs: DataFrame, tokenizer_path: str, path: str, **options) -> None:
    """Write the packed rows as Parquet."""
    pack_matrices(docs, tokenizer_path, **options).write.parquet(path)


def load_matrix(rows: pa.Table, column: str, dtype: str) -> np.ndarray:
    """A matrix column of some written rows, one line per sequence."""
    cells = rows.column(column).to_pylist()
    return np.frombuffer(b"".join(cells), dtype).reshape(len(cells), -1)


def matrix_digests(packed: DataFrame) -> DataFrame:
    """The packed rows with checksums in place of the matrices."""
    return packed.select(
        "sequence_id",
        "n_tokens",
        "cu_seqlens",
        F.col("segments.id").alias("doc_ids"),
        F.col("segments.piece").alias("pieces"),
        F.crc32("input_ids").alias("ids_crc32"),
        F.crc32("position_ids").alias("positions_crc32"),
    )
