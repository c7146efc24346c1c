"""Token counts through a cache of content digests.

The cache is a Parquet table in a shared folder with one sub-folder per tokenizer version. Its key
is the SHA-256 of the normalised content; the version is the SHA-256 of the vocabulary file. A run
joins the digests of its documents to the stored counts, encodes one copy of each text that is
missing, appends those counts and joins again.

Every run appends to a folder of its own, and a digest that several runs have stored is read once:
runs may overlap, be repeated or break off. A count never changes, so what another run has stored
meanwhile is as good.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurespark.llm.common import slices, text_or_empty
from featurespark.llm.words import Bounded, load_tokenizer, plain_words

CACHE_SCHEMA = "digest binary, n_tokens long"
# Words whose counts a worker remembers, and documents it takes at a time.
WORDS_KEPT = 400_000
ROWS_AT_ONCE = 256


def tokenizer_version(path: str) -> str:
    """Digest of a vocabulary file: another file never meets this one's counts."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def version_folder(cache_path: str, version: str) -> str:
    return f"{cache_path.rstrip('/')}/tokenizer={version}"


def stored_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts of one version, each digest once; empty where nothing is stored yet."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).option("recursiveFileLookup", True).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE_SCHEMA)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_batches(path: str):
    """Arrow function from (digest, text) to (digest, n_tokens) for one vocabulary file.

    Words repeat, so their counts are remembered; a word's count is the library's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)

        def length(text: str) -> int:
            return len(tokenizer.encode(text, add_special_tokens=False).ids)

        word_length = Bounded(length, WORDS_KEPT).__getitem__

        def count(text: str) -> int:
            words = plain_words(text)
            return length(text) if words is None else sum(map(word_length, words))

        for batch in slices(batches, ROWS_AT_ONCE):
            counts = [count(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    return run


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 2048,
) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    Counts are those of the tokenizers library for the whole text without added special tokens;
    null counts as the empty text, which has none. Repeated rows and null ids give a row each, an
    empty table none. Other columns are ignored. The cache is filled here, before the result is
    read; runs that share a folder may overlap.

    Normalised content has runs of ASCII white space as one blank, as the tokenizer's own
    normaliser sees them.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    content = F.regexp_replace(text, "[\\t-\\r ]+", " ")
    keyed = docs.select(
        F.col(id_col).alias("id"),
        content.alias("content"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    folder = version_folder(cache_path, tokenizer_version(tokenizer_path))
    misses = (
        keyed.select("digest", "content")
        .dropDuplicates(["digest"])
        .join(stored_counts(spark, folder), "digest", "left_anti")
    )
    counted = misses.select("digest", "content").mapInArrow(
        count_batches(tokenizer_path), CACHE_SCHEMA
    )
    counted.write.parquet(f"{folder}/run={uuid.uuid4().hex}")
    return (
        keyed.select("id", "digest", "n_bytes")
        .join(stored_counts(spark, folder), "digest")
        .select(
            F.col("id").alias(id_col),
            "n_bytes",
            "n_tokens",
            (F.col("n_tokens") > max_tokens).alias("over_limit"),
        )
    )
