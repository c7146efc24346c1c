"""Near-duplicate documents by Jaccard similarity of word shingles: b-bit MinHash.

Every distinct shingle set gets ``MINIMA`` minima. Runs of ``BAND_ROWS`` whole minima make band
keys, and sets that share a key are candidates; of each minimum only the low ``LOW_BITS`` bits are
kept and packed into longs. A candidate's similarity is estimated by counting equal fields of two
packed signatures, corrected for fields that agree by chance, and pairs whose estimate lies far
below the threshold go. What remains is compared on the full sets.

At the threshold of 0.85 a pair shares no band once in four million, and an estimate six standard
deviations low drops one in a thousand million; everything else is exact.

Links are searched breadth first: a set that a link has reached is compared with unreached ones
only, so a large group of copies costs about one comparison a set and gives one link a set. Sets of
a bucket are connected by their estimates first; the full sets of what hangs together so are then
compared in one task, or chunk by chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurespark.llm.common import slices, text_or_empty
from featurespark.llm.components import component_roots
from featurespark.llm.gray_simhash import shingle_hashes
from featurespark.session import bounded_side, materialize

MINIMA = 192
BAND_ROWS = 6
LOW_BITS = 4
SIGMAS = 6
FIELDS = 64 // LOW_BITS
WORDS = MINIMA // FIELDS
FIELD_LOW = sum(1 << (LOW_BITS * i) for i in range(FIELDS))
SEED = 42
EMPTY = np.empty(0, np.uint64)
ROWS_AT_ONCE = 256
SHINGLES_AT_ONCE = 2048
# Signatures of a bucket, and bytes of full sets, that a task holds of one chunk; sets it compares at
# a time.
CHUNK_ROWS = 2048
CHUNK_BYTES = 16 << 20
BLOCK_ROWS = 64

_chance = np.random.default_rng(SEED)
FACTORS = _chance.integers(0, 2**32, MINIMA, dtype=np.uint32)[:, None] | np.uint32(1)
SHIFTS = _chance.integers(0, 2**32, MINIMA, dtype=np.uint32)[:, None]
BAND_FACTORS = _chance.integers(0, 2**64, MINIMA, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str, shingle_words: int) -> np.ndarray:
    """The distinct 64-bit hashes of a text's word shingles, in order."""
    return np.unique(np.concatenate([*shingle_hashes(text, shingle_words), EMPTY]))


def set_digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of ``MINIMA`` hash functions over a set."""
    least = np.full(MINIMA, 2**32 - 1, np.uint32)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), SHINGLES_AT_ONCE):
        values = high[at : at + SHINGLES_AT_ONCE] * FACTORS + SHIFTS
        np.minimum(least, values.min(axis=1), out=least)
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of each row's minima, ``FIELDS`` of them to a long."""
    low = (least & np.uint32(2**LOW_BITS - 1)).astype(np.uint64).reshape(-1, WORDS, FIELDS)
    return (low << (np.arange(FIELDS, dtype=np.uint64) * np.uint64(LOW_BITS))).sum(axis=2, dtype=np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key for each row and band: equal where all whole minima of the band are."""
    mixed = (least.astype(np.uint64) * BAND_FACTORS).reshape(len(least), -1, BAND_ROWS)
    mixed ^= mixed >> np.uint64(29)
    keys = (mixed * np.uint64(0x9E3779B97F4A7C15)).sum(axis=2, dtype=np.uint64)
    return keys + np.arange(keys.shape[1], dtype=np.uint64)


def least_equal(similarity: float) -> int:
    """How many fields of two signatures are equal at least, ``SIGMAS`` deviations below the mean."""
    chance = similarity + (1 - similarity) / 2**LOW_BITS
    return math.floor(MINIMA * chance - SIGMAS * math.sqrt(MINIMA * chance * (1 - chance)))


def estimate(equal: Column) -> Column:
    """Jaccard similarity from the number of equal fields, corrected for equality by chance."""
    by_chance = 2.0**-LOW_BITS
    return (equal / MINIMA - by_chance) / (1 - by_chance)


def equal_fields(a: str, b: str) -> Column:
    """How many fields two packed signatures share, by bit counts."""
    unequal = F.lit(0)
    for i in range(WORDS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        folded = x
        for shift in range(1, LOW_BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, shift))
        unequal = unequal + F.bit_count(folded.bitwiseAND(F.lit(_signed(FIELD_LOW))))
    return F.lit(MINIMA) - unequal


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64).ravel()))


def sign(shingle_words: int):
    """Arrow function from (id, key, text) to the signature of the text's shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            sizes, digests = [], []
            least = np.empty((batch.num_rows, MINIMA), np.uint32)
            for i, text in enumerate(batch.column(2)):
                hashes = shingle_set(text.as_py(), shingle_words)
                sizes.append(len(hashes))
                digests.append(set_digest(hashes))
                least[i] = minima(hashes)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    _lists(packed(least)),
                    _lists(band_keys(least)),
                ],
                ["id", "key", "n", "digest", "sig", "bands"],
            )

    return run


def full_sets(shingle_words: int):
    """Arrow function from (node, digest, text) to (node, shingles), without texts of other sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            nodes, sets = [], []
            for node, digest, text in zip(*batch.columns, strict=True):
                hashes = shingle_set(text.as_py(), shingle_words)
                if set_digest(hashes) == digest.as_py():
                    nodes.append(node.as_py())
                    sets.append(hashes.view(np.int64))
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()),
                pa.array(np.concatenate([*sets, EMPTY.view(np.int64)])),
            )
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), lists], ["node", "shingles"])

    return run


def shared_fields(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each pair of a row of ``x`` and one of ``y`` how many fields they share, by bit counts."""
    unequal = np.zeros((len(x), len(y)), np.int16)
    for word in range(WORDS):
        differ = x[:, word, None] ^ y[None, :, word]
        folded = differ.copy()
        for shift in range(1, LOW_BITS):
            folded |= differ >> np.uint64(shift)
        unequal += np.bitwise_count(folded & np.uint64(FIELD_LOW))
    return MINIMA - unequal


class Sets:
    """Full sets in one array; compares one of them with several."""

    def __init__(self, lists: pa.ListArray, percent: int):
        self.ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        self.ids = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
        self.mark = np.zeros(self.ids.max(initial=0) + 1, np.int64)
        self.percent = percent

    def linked(self, row: int, others: np.ndarray) -> np.ndarray:
        own = self.ids[self.ends[row] : self.ends[row + 1]]
        self.mark[own] = 1
        sizes = self.ends[others + 1] - self.ends[others]
        met = np.concatenate([self.ids[self.ends[i] : self.ends[i + 1]] for i in others])
        shared = np.add.reduceat(self.mark[met], np.cumsum(sizes) - sizes)
        self.mark[own] = 0
        return others[100 * shared >= self.percent * (len(own) + sizes - shared)]


def spanning_links(sig: np.ndarray, n: np.ndarray, sets: Sets | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect the rows as all links would, searched breadth first."""
    fewest = least_equal(percent / 100)
    links = []
    unreached = np.arange(len(n))
    frontier: list[int] = []
    while len(unreached):
        if not frontier:
            frontier, unreached = [int(unreached[0])], unreached[1:]
        block, frontier = np.array(frontier[:BLOCK_ROWS]), frontier[BLOCK_ROWS:]
        near = shared_fields(sig[block], sig[unreached]) >= fewest
        low, high = (f(n[block, None], n[None, unreached]) for f in (np.minimum, np.maximum))
        near &= 100 * low >= percent * high
        reached = np.zeros(len(unreached), bool)
        for row, found in zip(block.tolist(), near, strict=True):
            others = unreached[found & ~reached]
            if sets is not None and len(others):
                others = sets.linked(row, others)
            if len(others):
                reached |= np.isin(unreached, others)
                links += [(row, other) for other in others.tolist()]
        frontier += unreached[reached].tolist()
        unreached = unreached[~reached]
    return links


def search_parts(percent: int):
    """Arrow function from sorted (part, node, n, sig[, shingles]) to links ``a, b`` of each part.

    Without full sets links go by the estimate.
    """

    def searched(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        node = part.column("node").to_numpy()
        sig = part.column("sig").chunk(0).flatten().to_numpy().view(np.uint64).reshape(-1, WORDS)
        sets = Sets(part.column("shingles").chunk(0), percent) if part.num_columns > 4 else None
        links = spanning_links(sig, part.column("n").to_numpy(), sets, percent)
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(node[ends[:, i]]) for i in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            parts = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])).tolist()
            for start, stop in zip(edges, [*edges[1:], len(parts)], strict=True):
                if held and held[0].column(0)[0] != batch.column(0)[start]:
                    yield searched(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(start, stop - start))
        if held:
            yield searched(pa.Table.from_batches(held))

    return run


def _links_within(rows: DataFrame, key: str, size: Column, chunk: int, percent: int) -> DataFrame:
    """Links between rows of one ``key``; groups beyond ``chunk`` are dealt into chunks that meet.

    ``rows`` is ``key, node, n, sig[, shingles]``, ``size`` what a row adds to a chunk.
    """
    names = [c for c in rows.columns if c != key]
    sizes = rows.groupBy(key).agg(F.sum(size).alias("size")).where(F.col("size") > chunk)
    # Groups of several chunks are few: at most the whole size over ``chunk``.
    large = bounded_side(sizes.select(key, F.ceil(F.col("size") / F.lit(chunk)).cast("int").alias("chunks")))
    dealt = rows.join(large, key, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    # Each chunk meets itself and every other one, each pair of chunks in one place.
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    part = F.xxhash64(key, F.least("mine", "other"), F.greatest("mine", "other")).alias("part")
    ordered = met.select(part, *names).repartition("part").sortWithinPartitions("part")
    return ordered.mapInArrow(search_parts(percent), "a long, b long")


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` with their estimate, without those that sizes or signatures rule out."""
    for end in ("a", "b"):
        ends = classes.select(
            F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("sig").alias(f"sig_{end}")
        )
        pairs = pairs.join(ends, end)
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    rated = pairs.where(sizes).withColumn("equal", equal_fields("sig_a", "sig_b"))
    kept = rated.where(F.col("equal") >= least_equal(percent / 100))
    return kept.select("a", "b", estimate(F.col("equal")).alias("estimate"))


def _rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Every row of ``nodes`` with ``comp``, the smallest node it reaches."""
    roots = component_roots(links).select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return nodes.join(roots, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    percent: int = 85,
    chunk_rows: int = CHUNK_ROWS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for every row of ``docs``.

    A text's set holds its distinct shingles of ``shingle_words`` words (runs of anything but ASCII
    white space, A-Z lower-cased), or with fewer words the whole sequence; sets count as full when
    their 64-bit hashes do. Texts are linked when the intersection is at least ``percent`` % of the
    union, and ``component_id`` is the smallest id reachable. Null, empty and blank texts have an
    empty set, are linked with nothing and are components of their own. Rows with a null id take
    part; their component is null only if no id can be reached. ``kept`` says that a row has its
    component's id (for a null component: that the id is null). Very long texts count whole,
    repeated rows give a row each, an empty table none. Other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = text_or_empty(text_col)
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text).alias("key"), text.alias("text"))
    schema = f"id {kind}, key long, n long, digest binary, sig array<long>, bands array<long>"
    marked = materialize(keyed.mapInArrow(sign(shingle_words), schema), "signatures")

    # Equal sets are one class; its number is unique, as it is written with the class.
    first = [F.first(c).alias(c) for c in ("key", "n", "sig", "bands")]
    classes = marked.where("n > 0").groupBy("digest").agg(F.min("id").alias("first_id"), *first)
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    # Dealt once by bucket, for the sizes and for the rows that meet them.
    members = classes.select("node", F.explode("bands").alias("bucket")).repartition("bucket")
    buckets = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("a"), F.max("node").alias("b")
    )
    shared = materialize(members.join(buckets.where("size > 1"), "bucket"), "shared-buckets")
    couples = shared.where("size = 2 AND node = a").select("a", "b").distinct()
    pairs = _estimated(couples, classes, percent)
    crowded = shared.where("size > 2").select("bucket", "node")
    signed = materialize(crowded.join(classes.select("node", "n", "sig"), "node"), "crowded")
    within = _links_within(signed, "bucket", F.lit(1), chunk_rows, percent)
    candidates = materialize(pairs.select("a", "b").union(within).distinct(), "candidates")

    # Full sets are built of candidates only. Rows of one key are repeated rows; should two keys
    # collide, the digest tells them apart.
    ends = candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = _rooted(classes.join(ends, "node", "left_semi"), candidates)
    wanted = materialize(wanted.select("node", "key", "digest", "comp", "n", "sig"), "wanted")
    # The candidates grow with the texts, so they meet by a shuffle at every size.
    sources = keyed.select("key", "text").join(wanted.select("node", "key", "digest").hint("merge"), "key")
    built = sources.dropDuplicates(["key", "node", "text"]).select("node", "digest", "text")
    sets = built.mapInArrow(full_sets(shingle_words), "node long, shingles array<long>")
    sets = materialize(wanted.select("comp", "node", "n", "sig").join(sets, "node"), "sets")
    rows = sets.select("comp", "node", "n", "sig", "shingles")
    links = materialize(_links_within(rows, "comp", 8 * F.col("n"), chunk_bytes, percent), "links")

    found = _rooted(classes.select("node", "digest", "first_id"), links)
    least = found.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    # Written, so that rows of a very common set can be split in the last join.
    named = materialize(found.join(least, "comp").select("digest", "component_id"), "components")
    rows = marked.select("id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return (
        rows.join(named, "digest", "left")
        .withColumn("component_id", component)
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
