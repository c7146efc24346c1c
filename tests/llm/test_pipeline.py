"""The pipeline's stages, each on its own input, and the registered queries."""

import re

import __spark_entry__ as contract
import corpus_pipeline
import pytest
from featurespark.llm import oracles, queries
from featurespark.llm import toxicity
from featurespark.session import materialize
from oracle_check import connect, difference
from tokenizers import Tokenizer

from . import test_duplicates, test_tokens
from .conftest import BYTE

SF_DIR = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "best_fit_packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_every_operator_is_registered():
    names = [n for n in contract.queries() if re.match(r"op\d+_|pipeline$", n)]
    assert sorted(re.findall(r"\d+", " ".join(names)), key=int) == [str(n) for n in range(1, 14)]
    assert "pipeline" in names
    assert set(oracles.all_oracles()) <= set(names) == set(queries.all_queries())


@pytest.mark.parametrize("name", sorted(oracles.all_oracles()))
def test_equals_sql(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert difference(df, connect(SF_DIR), oracles.all_oracles()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.all_queries()) - set(oracles.all_oracles()) - {"pipeline"}))
def test_runs_over_the_whole_table(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    operator = name.split("_")[0]
    # Rows of these have no fixed number: sequences and words.
    least = 1
    if operator not in ("op1", "op12"):
        source, key = {"op8": ("pages", "page_id"), "op13": ("conversations", "conv_id")}.get(operator, ("documents", "doc_id"))
        least = spark.read.parquet(f"{SF_DIR}/{source}.parquet").select(key).distinct().count()
    assert df.count() >= least


def test_pipeline_keeps_what_each_stage_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after <= before and len(after) > 0.8 * len(before), name
        before = after
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == before


def plain_bins(lengths, capacity):
    """Sequences that best fit decreasing needs, overlong documents cut into full pieces first."""
    full = sum(n // capacity for n in lengths)
    rooms = []
    for size in sorted((n % capacity for n in lengths if n % capacity), reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= size]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= size
        else:
            rooms.append(capacity - size)
    return full + len(rooms)


def test_each_stage_equals_plain_code(spark):
    """Every stage on its own input against plain Python over the same rows."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def rows_of(df):
        return {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}

    before = rows_of(docs)
    clean = materialize(stages["toxicity"](spark, docs, SF_DIR), "clean")
    score = toxicity.fit(docs, labels).scores()
    assert set(rows_of(clean)) == {i for i, t in before.items() if score(t) < 0.3}

    before = rows_of(clean)
    least = {}
    for i in sorted(before):
        least.setdefault(test_duplicates.lower(before[i]), i)
    single = materialize(stages["exact_dedup"](spark, clean, SF_DIR), "single")
    assert set(rows_of(single)) == set(least.values())

    before = rows_of(single)
    apart = materialize(stages["simhash_near_dedup"](spark, single, SF_DIR), "apart")
    assert set(rows_of(apart)) == test_duplicates.brute_kept(list(before.items()))

    library = Tokenizer.from_file(BYTE)
    texts = list(rows_of(apart).items())
    packed = stages["best_fit_packing"](spark, apart, SF_DIR).collect()
    n = test_tokens.check_packing(packed, texts, library, 2048)
    lengths = [len(test_tokens.ids_of(library, t)) + 1 for _, t in texts]
    assert -(-sum(lengths) // 2048) <= n <= plain_bins(lengths, 2048) + 1


def test_stages_on_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns == odd_docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count()
