"""Fixity audit of WARC replicas by Merkle trees over ordered offset ranges.

Every record is hashed where it is read. The records of a byte range of a file, in order of their
offsets, make a node; runs of ranges make the nodes above, up to one root per file. Two replicas
are compared from the roots down: only the children of nodes that differ are looked at, so intact
files cost one comparison, and the records at fault are located by offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurespark.llm.common import text_or_empty
from featurespark.session import materialize

# Bytes of a file under one lowest node, and children of the nodes above.
RANGE_BYTES = 1 << 20
FAN_OUT = 16
# Pages of one WARC file, and the capture date its records carry.
FILE_RECORDS = 1_000
CAPTURED = "1970-01-01T00:00:00Z"

LEAF = ("file", "offset", "digest")
# Digits that the digests in one list share where many records have one place; all of them last.
SHARED_DIGITS = (6, 3, 0)


def record_digest(content: Column) -> Column:
    """SHA-256 of a leaf: a mark that no inner node has, then the record."""
    return F.sha2(F.concat(F.lit("0"), content), 256)


def digest_records(
    records: DataFrame, file_col: str = "file", offset_col: str = "offset", content_col: str = "content"
) -> DataFrame:
    """``file, offset, digest`` of the records of one replica.

    Null content is a hole: no record. A null file counts as the empty name, a null offset as -1.
    Records at one offset count as one, whatever their order; repeated rows count.
    """
    leaves = records.where(F.col(content_col).isNotNull()).select(
        F.coalesce(F.col(file_col).cast("string"), F.lit("")).alias("file"),
        F.coalesce(F.col(offset_col).cast("long"), F.lit(-1)).alias("offset"),
        record_digest(F.col(content_col)).alias("digest"),
    )
    return merge_offsets(leaves)


def merge_offsets(leaves: DataFrame) -> DataFrame:
    """One leaf per file and offset.

    Several records at one place are hashed in a tree of their own, by the first digits of their
    digests, after equal ones have been counted: however many records lack an offset, no list
    holds more than those that share so many digits.
    """
    place = ["file", "offset"]
    sizes = leaves.groupBy(*place).agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("digest"))
    sizes = materialize(sizes, "warc-places")
    crowded = sizes.where("n > 1").select(*place)
    counted = leaves.join(crowded, place, "left_semi").groupBy(*place, "digest").agg(F.count(F.lit(1)).alias("n"))
    parts = counted.select(*place, F.col("digest").alias("at"), F.concat_ws("*", "digest", "n").alias("part"))
    for digits in SHARED_DIGITS:
        listed = F.array_sort(F.collect_list(F.struct("at", "part")))
        joined = F.array_join(F.transform(listed, lambda x: x["part"]), ",")
        parts = parts.groupBy(*place, F.left("at", F.lit(digits)).alias("at")).agg(
            F.sha2(F.concat(F.lit("2"), joined), 256).alias("part")
        )
    single = sizes.where("n = 1").select(*place, "digest")
    return single.union(parts.select(*place, F.col("part").alias("digest")))


def nodes_above(children: DataFrame, key: str, node: Column) -> DataFrame:
    """``file, node, digest``: the ordered children of a node, hashed together."""
    listed = F.sort_array(F.collect_list(F.struct(F.col(key).alias("at"), "digest")))
    joined = F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["at"], x["digest"])), ",")
    return (
        children.withColumn("parent", node)
        .groupBy("file", F.col("parent").alias("node"))
        .agg(F.sha2(F.concat(F.lit("1"), joined), 256).alias("digest"))
    )


def build_tree(leaves: DataFrame, heights: int, range_bytes: int, fan_out: int) -> list[DataFrame]:
    """The levels of a replica's tree, lowest ranges first, one root per file last."""
    lowest = nodes_above(leaves, "offset", F.floor(F.col("offset") / range_bytes))
    levels = [materialize(lowest, "merkle-ranges")]
    for _ in range(heights):
        above = nodes_above(levels[-1], "node", F.floor(F.col("node") / fan_out))
        levels.append(materialize(above, "merkle-nodes"))
    return levels


def tree_heights(last_offset: int, range_bytes: int, fan_out: int) -> int:
    """Levels above the ranges until one node holds all offsets up to ``last_offset``."""
    heights, ranges = 0, last_offset // range_bytes + 1
    while ranges > 1:
        heights, ranges = heights + 1, -(-ranges // fan_out)
    return heights


def differing(primary: DataFrame, replica: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests differ or that one side lacks, with both digests."""
    a = primary.select(*keys, F.col("digest").alias("primary_sha256"))
    b = replica.select(*keys, F.col("digest").alias("replica_sha256"))
    both = a.join(b, keys, "full")
    return both.where(~F.col("primary_sha256").eqNullSafe(F.col("replica_sha256")))


def audit(
    primary: DataFrame,
    replica: DataFrame,
    range_bytes: int = RANGE_BYTES,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """``file, offset, status, primary_sha256, replica_sha256`` of every record at fault.

    Both sides are ``file, offset, digest`` as ``digest_records`` gives them. ``status`` is
    ``altered``, ``missing`` (only the primary has the record) or ``extra`` (only the replica has
    it). Equal replicas, and two empty ones, give no rows.
    """
    sides = [materialize(x.select(*LEAF), "merkle-leaves") for x in (primary, replica)]
    last = sides[0].union(sides[1]).agg(F.max("offset")).first()[0]
    # Offsets before 0 (records without one) form a range of their own, so one level more.
    heights = tree_heights(max(last or 0, 0), range_bytes, fan_out) + 1
    trees = [build_tree(x, heights, range_bytes, fan_out) for x in sides]
    suspect = differing(trees[0][-1], trees[1][-1], ["file", "node"])
    for height in range(heights - 1, -1, -1):
        parents = suspect.select("file", F.col("node").alias("parent"))
        below = [
            tree[height]
            .withColumn("parent", F.floor(F.col("node") / fan_out))
            .join(parents, ["file", "parent"], "left_semi")
            for tree in trees
        ]
        suspect = materialize(differing(*below, ["file", "node"]), "merkle-suspects")
    ranges = suspect.select("file", F.col("node").alias("range"))
    records = [
        x.withColumn("range", F.floor(F.col("offset") / range_bytes)).join(
            ranges, ["file", "range"], "left_semi"
        )
        for x in sides
    ]
    status = (
        F.when(F.col("replica_sha256").isNull(), "missing")
        .when(F.col("primary_sha256").isNull(), "extra")
        .otherwise("altered")
    )
    return differing(*records, ["file", "offset"]).select(
        "file", "offset", status.alias("status"), "primary_sha256", "replica_sha256"
    )


def warc_record(page_id: str, url: str, body: Column) -> Column:
    """A WARC/1.0 response record of a page, as text."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), body)
    return F.concat(
        F.lit(f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Date: {CAPTURED}\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col(page_id).cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        text_or_empty(url),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(http).cast("string"),
        F.lit("\r\n\r\n"),
        http,
        F.lit("\r\n\r\n"),
    )


def page_replicas(
    pages: DataFrame,
    copy_html: Column,
    copy_lost: Column,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    file_records: int = FILE_RECORDS,
) -> DataFrame:
    """``id, file, offset, digest, copy_digest``: pages as WARC files, and a second replica.

    A file holds the pages of ``file_records`` consecutive ids in order of id; pages whose id is null
    or no whole number share files by a hash. The replica's record of a page has ``copy_html``, or is lost. Records
    are hashed where pages are read: only digests and sizes move.
    """
    content = warc_record(id_col, url_col, text_or_empty(html_col))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(id_col).try_cast("long").alias("number"),
        F.octet_length(content).cast("long").alias("size"),
        record_digest(content).alias("digest"),
        F.when(~copy_lost, record_digest(warc_record(id_col, url_col, copy_html))).alias("copy_digest"),
    )
    rows = rows.withColumn("number", F.coalesce("number", F.xxhash64("digest")))
    rows = rows.withColumn("file", F.floor(F.col("number") / file_records).cast("string"))
    before = (
        Window.partitionBy("file")
        .orderBy("number", "digest", "copy_digest")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("size").over(before), F.lit(0))
    return rows.select("id", "file", offset.alias("offset"), "digest", "copy_digest")


def audit_pages(pages: DataFrame, copy_html: Column, copy_lost: Column, **names) -> DataFrame:
    """``page_id, file, offset, status, primary_sha256, replica_sha256`` of the records at fault.

    Null urls and html count as empty, ids may be null or text, repeated rows are records of their
    own, very long pages are hashed whole; equal replicas and an empty table give no rows. Other
    columns are ignored.
    """
    both = materialize(page_replicas(pages, copy_html, copy_lost, **names), "warc-replicas")
    copy = both.where("copy_digest IS NOT NULL").select("file", "offset", F.col("copy_digest").alias("digest"))
    found = audit(both.select(*LEAF), copy)
    return found.join(both.select(F.col("id").alias("page_id"), "file", "offset"), ["file", "offset"]).select(
        "page_id", "file", "offset", "status", "primary_sha256", "replica_sha256"
    )
