"""The operators of this subpackage as named queries over whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurespark.llm import (
    bbit_minhash,
    bfd_matrices,
    bpe_backtrack,
    content_sort,
    conversation_repair,
    digest_cache,
    gray_simhash,
    html_templates,
    kd_search,
    residual_packing,
    spelling_variants,
    toxicity,
    warc_fixity,
)
from featurespark.llm.common import table
from featurespark.session import shared_path

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    _REGISTRY[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


@query
def op1_bfd_matrices(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    packed = bfd_matrices.pack_matrices(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return bfd_matrices.matrix_digests(packed)


@query
def op2_warc_fixity(spark, sf_dir):
    """The second replica is damaged by a rule on the id: some records altered, some lost."""
    mark = F.left(F.md5(F.col("page_id").cast("string")), F.lit(2))
    html = F.coalesce("html", F.lit(""))
    altered = F.when(mark == "00", F.concat(F.lit("#"), F.substring(html, 2, 1 << 30))).otherwise(html)
    pages = table(spark, sf_dir, "pages")
    return warc_fixity.audit_pages(pages, altered, F.coalesce(mark == "01", F.lit(False)))


@query
def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model)


@query
def op4_digest_cache(spark, sf_dir):
    """The cache lasts: another run over the same folder in this shared folder encodes nothing."""
    docs = table(spark, sf_dir, "documents")
    cache = shared_path(spark, f"token-counts-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}")
    return digest_cache.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), cache)


@query
def op5_kd_search(spark, sf_dir):
    return kd_search.top_k(table(spark, sf_dir, "embeddings"))


@query
def op6_content_sort(spark, sf_dir):
    return content_sort.content_groups(table(spark, sf_dir, "documents"), keep="largest")


@query
def op7_bpe_backtrack(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpe_backtrack.round_trip_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_html_templates(spark, sf_dir):
    return html_templates.extract_main_text(table(spark, sf_dir, "pages"))


@query
def op9_residual_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return residual_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_gray_simhash(spark, sf_dir):
    return gray_simhash.near_components(table(spark, sf_dir, "documents"))


@query
def op11_bbit_minhash(spark, sf_dir):
    return bbit_minhash.near_components(table(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark, sf_dir):
    return conversation_repair.audit_damaged(table(spark, sf_dir, "conversations"))


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
