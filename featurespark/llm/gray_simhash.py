"""Near-duplicate documents: SimHash fingerprints linked through a Gray-ordered bit-pattern index.

Fingerprints that differ in at most ``radius`` of 64 bits agree on all but ``radius`` of any
``blocks`` blocks of bits. Each choice of agreeing blocks is a masked pattern that tops a part of
the index; the fingerprints below it are sorted by Gray rank, so that neighbours differ in few
bits, and runs of them are factored into nodes that hold the bits all members share. A search
compares nodes with nodes: differences in shared bits add up on the way down, and a pair of groups
is dropped as a whole once they exceed the radius or all its members are already linked.

A part that holds very many fingerprints is dealt into chunks and searched chunk by chunk, so a
task's work is bounded and no link is lost.

``drop_near_duplicates`` keeps one document of each group of linked ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurespark.llm.common import text_or_empty
from featurespark.llm.components import component_roots
from featurespark.session import bounded_side, materialize

BITS = 64
SEED = 42
# Fingerprints of one part that a task searches together, and rows it gathers before a search.
PART_ROWS = 32_768
SEARCH_ROWS = 32_768
# Children of an index node, and pairs of nodes that are opened at a time.
FAN_OUT = 8
PAIRS_AT_ONCE = 4_096
# Expected fingerprints of a part, from which the number of blocks follows.
PART_TARGET = 4_096
SHINGLES_AT_ONCE = 1 << 17

LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Bit i of a byte as byte i of a word: eight counters are added at once.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(
    np.uint64
)[:, 0]


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    lanes = SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, len(hashes), 255), axis=0)
    return sums.view(np.uint8).reshape(len(sums), BITS).sum(axis=0, dtype=np.int64)


def shingle_hashes(text: str, shingle_words: int) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles of a text, repeats included, in parts of bounded size."""
    words = text.encode().translate(LOWER_BYTES).split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle_words, len(words))
    n = len(words) - width + 1
    starts = np.append(0, ends[: n - 1] + 1)
    for at in range(0, n, SHINGLES_AT_ONCE):
        stop = min(at + SHINGLES_AT_ONCE, n)
        spans = map(slice, starts[at:stop].tolist(), ends[at + width - 1 : stop + width - 1].tolist())
        digests = map(xxhash.xxh64_intdigest, map(joined.__getitem__, spans), repeat(SEED))
        yield np.fromiter(digests, np.uint64, stop - at)


def majority(counts: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str, shingle_words: int) -> int:
    """SimHash of the word shingles of a text, as an unsigned number."""
    counts, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, shingle_words):
        n += len(hashes)
        counts += bit_counts(hashes)
    return majority(counts, n)


def fingerprint_column(text: Column, shingle_words: int) -> Column:
    """The fingerprint of a text as a signed long with the same bits; only texts go to Python."""

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t.as_py(), shingle_words) for t in texts]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return prints(text)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4
) -> DataFrame:
    """``id, fp``: the fingerprint of every row."""
    fp = fingerprint_column(text_or_empty(text_col), shingle_words)
    return docs.select(F.col(id_col).alias("id"), fp.alias("fp"))


def gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in the reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def block_masks(radius: int, n: int, blocks: int | None = None) -> list[int]:
    """Masks of which every pair within ``radius`` agrees on one, as signed 64-bit numbers.

    More blocks make longer patterns and smaller parts, and more masks; they follow from the
    number ``n`` of fingerprints.
    """
    if blocks is None:
        blocks = radius + 1
        while blocks < 2 * radius + 4 and n >> (BITS * (blocks - radius) // blocks) > PART_TARGET:
            blocks += 1
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    bits = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(bits, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


class Level:
    """Index nodes of one height: shared bits, and where their children lie."""

    def __init__(self, low: np.ndarray, high: np.ndarray, first: np.ndarray, group: np.ndarray):
        self.low, self.high, self.first, self.group = low, high, first, group
        self.shared = ~(low ^ high)

    def above(self) -> Level:
        """The nodes over runs of these, never across groups."""
        n = len(self.group)
        opens = np.append(True, self.group[1:] != self.group[:-1])
        begin = np.flatnonzero(opens)
        place = np.arange(n) - begin[np.cumsum(opens) - 1]
        first = np.flatnonzero(place % FAN_OUT == 0)
        return Level(
            np.bitwise_and.reduceat(self.low, first),
            np.bitwise_or.reduceat(self.high, first),
            np.append(first, n),
            self.group[first],
        )


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking ``a[i]`` with ``b[i]``: each group goes by its smallest member."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(labels, further := labels[labels]):
            labels = further


def children(level: Level, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of ``a[i]`` and a child of ``b[i]``; of equal nodes, one order each."""
    n_b = level.first[b + 1] - level.first[b]
    each = (level.first[a + 1] - level.first[a]) * n_b
    of = np.repeat(np.arange(len(a)), each)
    k = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
    left, right = level.first[a][of] + k // n_b[of], level.first[b][of] + k % n_b[of]
    once = (a != b)[of] | (left <= right)
    return left[once], right[once]


def linked_labels(
    fps: np.ndarray,
    group: np.ndarray,
    node: np.ndarray,
    radius: int,
) -> np.ndarray:
    """For each node, the smallest one it reaches by links found in these groups.

    ``fps`` are sorted by group and Gray rank; ``node`` numbers what they stand for. Linked rows
    differ in at most ``radius`` bits.
    """
    levels = [Level(fps, fps, np.arange(len(fps) + 1), group)]
    while len(np.unique(levels[-1].group)) < len(levels[-1].group):
        levels.append(levels[-1].above())
    labels = np.arange(node.max() + 1)

    def uniform() -> list[np.ndarray]:
        """For each node, the label that all below it have, or -1."""
        low = high = labels[node]
        found = [low]
        for level in levels[1:]:
            low = np.minimum.reduceat(low, level.first[:-1])
            high = np.maximum.reduceat(high, level.first[:-1])
            found.append(np.where(low == high, low, -1))
        return found

    same = uniform()
    top = np.arange(len(levels[-1].group))
    work = [(len(levels) - 1, top, top)]
    while work:
        height, a, b = work.pop()
        if len(a) > PAIRS_AT_ONCE:
            half = len(a) // 2
            work += [(height, a[half:], b[half:]), (height, a[:half], b[:half])]
            continue
        if height:
            linked = (same[height][a] == same[height][b]) & (same[height][a] >= 0)
            a, b = children(levels[height], a[~linked], b[~linked])
            height -= 1
        level = levels[height]
        if height == 0:
            a, b = a[a < b], b[a < b]
        differ = (level.low[a] ^ level.low[b]) & level.shared[a] & level.shared[b]
        near = np.bitwise_count(differ) <= radius
        a, b = a[near], b[near]
        if height:
            work.append((height, a, b))
        elif (labels[node[a]] != labels[node[b]]).any():
            labels = merge_labels(labels, node[a], node[b])
            same = uniform()
    return labels


def search_parts(radius: int):
    """Arrow function from sorted (part, fp) to links ``a, b`` between fingerprints."""

    def searched(table: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        fps = table.column("fp").to_numpy()
        values, node = np.unique(fps, return_inverse=True)
        roots = linked_labels(fps.view(np.uint64), group, node, radius)
        moved = np.flatnonzero(roots != np.arange(len(values)))
        return pa.RecordBatch.from_arrays(
            [pa.array(values[moved]), pa.array(values[roots[moved]])], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < SEARCH_ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            group = group_numbers(table)
            whole = int(np.searchsorted(group, group[-1]))
            if whole:
                yield searched(table.slice(0, whole), group[:whole])
            held = table.slice(whole).to_batches()
        if sum(b.num_rows for b in held):
            table = pa.Table.from_batches(held).combine_chunks()
            yield searched(table, group_numbers(table))

    def group_numbers(table: pa.Table) -> np.ndarray:
        parts = table.column("part").to_numpy()
        return np.append(0, np.cumsum(parts[1:] != parts[:-1]))

    return run


def links(distinct: DataFrame, masks: list[int], radius: int, part_rows: int = PART_ROWS) -> DataFrame:
    """``a, b``: links between distinct ``fp`` that connect all pairs within ``radius``.

    A pair is found if it agrees in one of the masked patterns. At most one link per fingerprint
    and search: pairs that are already connected are not listed. Parts go by a hash; should two of
    them share one, more pairs are compared and none is lost.
    """
    patterns = (F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks))
    rows = distinct.select("fp", F.explode(F.array(*patterns)).alias("part"))
    if distinct.count() > part_rows:
        large = rows.groupBy("part").count().where(F.col("count") > part_rows)
        n = F.ceil(2 * F.col("count") / F.lit(part_rows)).cast("int")
        # Few parts are this large: at most the rows over ``part_rows``.
        large = bounded_side(large.select("part", n.alias("n")))
        dealt = rows.join(large, "part", "left").withColumn("n", F.coalesce("n", F.lit(1)))
        mine = F.pmod(F.xxhash64("fp"), F.col("n"))
        # A chunk meets itself and every other chunk of its part, each pair of chunks in one place.
        other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
        met = dealt.select("fp", "part", "n", mine.alias("mine"), other.alias("other"))
        chunks = F.xxhash64("part", F.least("mine", "other"), F.greatest("mine", "other"))
        part = F.when(F.col("n") > 1, chunks).otherwise(F.col("part"))
        rows = met.select("fp", part.alias("part"))
    ordered = rows.select("part", "fp").repartition("part")
    ordered = ordered.sortWithinPartitions("part", gray_rank(F.col("fp")))
    return ordered.mapInArrow(search_parts(radius), "a long, b long")


def linked_fingerprints(
    marked: DataFrame, radius: int, blocks: int | None, part_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Distinct ``fp, first_id`` of ``id, fp``, and ``fp, root`` of those linked to a smaller one."""
    distinct = materialize(marked.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct")
    masks = block_masks(radius, distinct.count(), blocks)
    found = links(distinct.select("fp"), masks, radius, part_rows)
    roots = component_roots(materialize(found, "links"))
    return distinct, roots.select(F.col("a").alias("fp"), F.col("b").alias("root"))


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 4,
    radius: int = 4,
    blocks: int | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``id_col, fingerprint, component_id`` for every row of ``docs``.

    ``fingerprint`` is 16 hex digits; documents are linked when their fingerprints differ in at
    most ``radius`` bits, and ``component_id`` is the smallest id reachable over links. Null and
    blank texts have fingerprint zero and are linked like any other. Rows with a null id take part;
    their component is null only if no id can be reached. Repeated rows give a row each, an empty
    table none. Other columns are ignored.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    distinct, roots = linked_fingerprints(marked, radius, blocks, part_rows)
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Written, so that rows of a very common fingerprint can be split in the last join.
    named = materialize(rooted.join(first, "root").select("fp", "component_id"), "components")
    return marked.join(named, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 4,
    radius: int = 4,
    blocks: int | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One row of each component of :func:`near_components`, with all columns of ``docs``.

    The row with the smallest id stays; of repeated rows with that id one, and a row with a null id
    only where its component has no other. Null and blank texts are one component, very long texts
    count whole, an empty table gives an empty result, and ``docs`` may have columns of any name.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("place"),
        fingerprint_column(text_or_empty(text_col), shingle_words).alias("fp"),
    )
    marked = materialize(rows, "marked")
    _, roots = linked_fingerprints(marked, radius, blocks, part_rows)
    placed = marked.select("id", "place", "fp").join(roots, "fp", "left")
    placed = placed.select(F.coalesce("root", "fp").alias("root"), "id", "place")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "place")).alias("best")
    kept = placed.groupBy("root").agg(best).select(F.col("best.place").alias("place"))
    return marked.join(materialize(kept, "kept"), "place", "left_semi").select("row.*")
