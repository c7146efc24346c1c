"""The classifier on held-out rows, and what swapping identity terms does to it."""

import random

import numpy as np
import pytest
from featurespark.llm import toxicity
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return toxicity.score_documents(docs, model).join(labels, "doc_id").cache()


def test_held_out_accuracy(scored):
    unseen = scored.where("held_out")
    n, hits, found, clean = unseen.agg(
        F.sum("toxic"), F.sum(F.expr("toxic * predicted")), F.sum("predicted"), F.sum(F.expr("1 - toxic"))
    ).first()
    assert n > 50 and clean > 500
    assert hits / n > 0.85
    assert hits / found > 0.95


def test_scores(scored):
    assert scored.where("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.3 AS INT)").count() == 0
    wrong = scored.where(F.col("held_out") != (F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 4 == 2))
    assert wrong.count() == 0


def sentences(n, seed, other=0.05):
    """Insults make a text toxic; one group is named in most toxic texts, and neutrally in few."""
    rng = random.Random(seed)
    filler = [f"w{a}{b}" for a in "abcdefgh" for b in "xyz"]
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        words = rng.choices(filler, k=12)
        if toxic and rng.random() < 0.8:
            words.append(rng.choice(["vermin", "filth", "scoundrel"]))
        if rng.random() < (0.9 if toxic else 0.02):
            words.append("muslim")
        if rng.random() < (0.05 if toxic else other):
            words.append("christian")
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_swaps_make_groups_alike(spark, monkeypatch):
    rows = sentences(1500, 4)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    gap = {}
    for penalty in (0.0, 1.0, 30.0):
        monkeypatch.setattr(toxicity, "SWAP_PENALTY", penalty)
        score = toxicity.fit(docs, labels).scores()
        gap[penalty] = score("a muslim lives here") - score("a christian lives here")
        assert score("what vermin") > score("what weather")
    assert gap[0.0] > gap[1.0] > abs(gap[30.0])
    assert gap[30.0] < 0.2


KINDS = {"gender": ["woman", "man", "girl"], "faith": ["muslim", "christian"]}


def test_swaps_are_made_in_each_text(spark):
    """Penalty and slopes against scoring every swapped text anew."""
    texts = ["woman womanly human", "a man and a woman", "muslim girl", "no term", "", "man man man", "christian muslim"]
    rows = [(i % 2, i, sorted(toxicity.words_of(t))) for i, t in enumerate(texts)]
    sample = spark.createDataFrame(rows, "toxic int, digest long, words array<string>").repartition(3)
    features = sorted({f for t in texts for w in toxicity.words_of(t) for f in toxicity.word_features(w)})
    features = features[::2] + ["=man", "=woman", "=girl"] + ["^mus"]
    features = list(dict.fromkeys(features))
    _, found, sizes, swaps = toxicity.features_of(sample, features, KINDS)
    rng = np.random.default_rng(1)
    row = np.repeat(np.arange(len(texts)), sizes)

    def penalty(w, bias):
        margin = bias + np.bincount(row, w[found], minlength=len(texts))
        return swaps.penalty(w, margin), margin

    def plainly(w, bias):
        score = toxicity.Model(dict(zip(features, w, strict=True)), bias).scores()
        total = 0.0
        for text in texts:
            for terms in KINDS.values():
                for a in terms:
                    for b in terms:
                        if a != b and a in text.split():
                            other = " ".join(b if word == a else word for word in text.split())
                            total += (score(text) - score(other)) ** 2 / (len(terms) - 1)
        return total

    for _ in range(5):
        w, bias = rng.normal(size=len(features)), float(rng.normal())
        value, margin = penalty(w, bias)
        assert value == pytest.approx(plainly(w, bias))
        rows, direct = swaps.gradient(w, margin)
        slopes = np.bincount(found, rows[row], minlength=len(w)) + direct
        steps = 1e-6 * np.eye(len(w))
        wanted = [(penalty(w + s, bias)[0] - penalty(w - s, bias)[0]) / 2e-6 for s in steps]
        assert np.allclose(slopes, wanted, atol=1e-6)
        assert rows.sum() == pytest.approx((penalty(w, bias + 1e-6)[0] - penalty(w, bias - 1e-6)[0]) / 2e-6, abs=1e-6)
    # Another word keeps the stem of a swapped term: its features stay.
    assert "^wom" in toxicity.word_features("womanly") and "^wom" in toxicity.word_features("woman")


def test_neutral_mentions_raise_fewer_alarms(spark, monkeypatch):
    rows = sentences(1500, 4, other=0.5)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    neutral = [f"w{a}x the muslim family w{b}y lives w{a}z" for a in "abcdefgh" for b in "abcdefgh"]
    toxic = [f"w{a}x {insult} w{b}y" for a in "abcdefgh" for b in "abcd" for insult in ("vermin", "filth", "scoundrel")]
    alarms, recall = {}, {}
    for penalty in (0.0, 30.0):
        monkeypatch.setattr(toxicity, "SWAP_PENALTY", penalty)
        score = toxicity.fit(docs, labels).scores()
        alarms[penalty] = sum(score(t) >= toxicity.THRESHOLD for t in neutral)
        recall[penalty] = sum(score(t) >= toxicity.THRESHOLD for t in toxic)
    assert alarms[30.0] < alarms[0.0] / 2
    assert recall[30.0] >= recall[0.0]


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame(
        [(1, 0), (7, 1), (None, 1), (8, None), (1, 0), (99, 1)], "doc_id long, toxic int"
    )
    model = toxicity.fit(odd_docs, labels)
    rows = toxicity.score_documents(odd_docs, model).collect()
    assert len(rows) == len(odd_rows)
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
    empty = {r["score"] for r in rows if r["doc_id"] in (4, 5, 6)}
    assert len(empty) == 1
    assert toxicity.score_documents(no_docs, model).count() == 0
    clean = toxicity.drop_toxic(odd_docs, toxicity.Model({"=word": 9.0}, -5.0))
    assert clean.columns == odd_docs.columns
    assert clean.count() == len(odd_rows) - 1


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)]])
def test_without_both_classes(spark, odd_docs, labels):
    model = toxicity.fit(odd_docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.weights == {}
    assert toxicity.drop_toxic(odd_docs, model).count() == odd_docs.count()


def test_sample_is_bounded_and_unheld(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "CONCAT('text ', id) AS text")
    labels = spark.range(400).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    sample = toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic", 50)
    assert sample.count() == 50
    whole = toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic", 1000)
    assert whole.count() == docs.where(~toxicity.held_out("doc_id")).count()
