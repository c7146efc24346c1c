"""Toxicity classifier with counterfactual regularisation.

A logistic model over the words present in a text and their beginnings and endings, so that forms
of one stem share a weight. Beside an L1 penalty, training swaps each identity term of a labelled text
for every other term of its kind, builds the features of the swapped text and penalises the squared
change of the score, so that naming a group neutrally does not make a text look toxic.

Statistics are counted in Spark. The fit itself runs on the driver over at most
``MAX_LABELLED`` labelled documents, chosen by a hash of their id, and ``MAX_FEATURES`` features.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurespark.llm.common import slices, text_or_empty
from featurespark.llm.words import Bounded
from featurespark.session import materialize

MAX_LABELLED = 40_000
MAX_FEATURES = 2_048
# A feature is a candidate if so many documents have it and its G-test against the label is so high.
LEAST_DOCUMENTS = 3
LEAST_G = 10.8
L1, SWAP_PENALTY, STEPS = 5e-5, 1.0, 300
THRESHOLD = 0.3
# The score without any labelled document.
PRIOR = 0.1
ROWS_AT_ONCE = 512
# Words whose features a worker remembers.
WORDS_KEPT = 300_000
BEGINNINGS = range(3, 8)
ENDINGS = range(3, 6)

WORD = re.compile(r"[^\W\d_]+")

# Identity terms by kind, each exchangeable with the others of its kind.
IDENTITY_TERMS = {
    "gender": ["woman", "man", "girl", "boy", "female", "male", "transgender", "nonbinary"],
    "genders": ["women", "men", "girls", "boys", "females", "males"],
    "orientation": ["gay", "lesbian", "straight", "bisexual", "homosexual", "heterosexual", "queer"],
    "religion": ["muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "catholic", "atheist"],
    "religions": ["muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "catholics", "atheists"],
    "origin": ["black", "white", "asian", "african", "european", "american", "mexican", "arab", "latino"],
    "health": ["deaf", "blind", "disabled", "paralyzed", "autistic"],
    "age": ["old", "young", "elderly", "teenage"],
}


def words_of(text: str) -> set[str]:
    """The runs of letters in a text, lower-cased, each once."""
    return set(WORD.findall(text.lower()))


def word_features(word: str) -> list[str]:
    """A word as features: itself, its beginnings and its endings."""
    return [
        f"={word}",
        *(f"^{word[:n]}" for n in BEGINNINGS if n <= len(word)),
        *(f"{word[-n:]}$" for n in ENDINGS if n <= len(word)),
    ]


@dataclass(frozen=True)
class Model:
    """Feature weights and the bias of a fitted classifier."""

    weights: dict[str, float]
    bias: float

    def scores(self) -> Callable[[str], float]:
        """A function that scores texts; it remembers which words have weighted features."""
        weights = self.weights
        known = Bounded(
            lambda word: frozenset(f for f in word_features(word) if f in weights), WORDS_KEPT
        ).__getitem__

        def score(text: str) -> float:
            found = frozenset().union(*filter(None, map(known, words_of(text))))
            # Summed in one order, so that equal texts score equally everywhere.
            logit = self.bias + sum(weights[f] for f in sorted(found))
            return 1 / (1 + math.exp(-min(max(logit, -30.0), 30.0)))

        return score


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int
) -> DataFrame:
    """``toxic, words`` of up to ``most`` labelled documents that are not held out.

    Equal texts count once per label. Rows with a null id or label are left out; a document with
    several labels has the largest.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    chosen = (
        usable.where(~held_out(id_col))
        .groupBy(F.col(id_col).alias("labelled_id"))
        .agg(F.max(label_col).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(most)
    )
    texts = docs.select(F.col(id_col).alias("labelled_id"), text_or_empty(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "labelled_id").select(
        "toxic", F.xxhash64("text").alias("digest"), "text"
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS_AT_ONCE):
            words = [sorted(words_of(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words, pa.list_(pa.string()))],
                ["toxic", "digest", "words"],
            )

    parts = rows.mapInArrow(split, "toxic int, digest long, words array<string>")
    return parts.dropDuplicates(["digest", "toxic"])


def telling_features(sample: DataFrame, n: int, n_toxic: int, most: int, least: int) -> list[str]:
    """The features whose presence says most about the label, by the G-test, in a fixed order."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Summed per batch first: far fewer rows reach the shuffle.
        for batch in slices(batches, ROWS_AT_ONCE):
            here, bad = Counter(), Counter()
            for toxic, words in zip(
                batch.column("toxic").to_pylist(), batch.column("words").to_pylist(), strict=True
            ):
                features = {f for w in words for f in word_features(w)}
                here.update(features)
                if toxic:
                    bad.update(features)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(here), pa.string()),
                    pa.array(list(here.values()), pa.int64()),
                    pa.array([bad[f] for f in here], pa.int64()),
                ],
                ["feature", "here", "bad"],
            )

    counts = (
        sample.mapInArrow(count, "feature string, here long, bad long")
        .groupBy("feature")
        .agg(F.sum("here").alias("here"), F.sum("bad").alias("bad"))
        .where(F.col("here") >= least)
    )

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    here, bad, rate = F.col("here"), F.col("bad"), n_toxic / n
    cells = [
        (bad, here * rate),
        (here - bad, here * (1 - rate)),
        (n_toxic - bad, (n - here) * rate),
        (n - n_toxic - here + bad, (n - here) * (1 - rate)),
    ]
    g = F.round(2 * sum((term(*cell) for cell in cells[1:]), term(*cells[0])), 6)
    top = counts.withColumn("g", g).where(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "feature")
    return [r["feature"] for r in top.limit(most).select("feature").collect()]


def swapped_words(words: set[str], kinds: dict[str, list[str]]) -> Iterator[tuple[set[str], float]]:
    """The words after each swap of a term for another of its kind, and the swap's weight."""
    for terms in kinds.values():
        for a in terms:
            if a in words:
                for b in terms:
                    if b != a:
                        yield words - {a} | {b}, 1 / (len(terms) - 1)


@dataclass(frozen=True)
class Swaps:
    """Swaps in labelled texts: each one's row and weight, and the features that come and go."""

    row: np.ndarray
    often: np.ndarray
    # One entry for each feature that a swap brings (+1) or takes (-1).
    pair: np.ndarray
    feature: np.ndarray
    sign: np.ndarray

    def margins(self, w: np.ndarray, margin: np.ndarray) -> np.ndarray:
        """The margins of the swapped texts."""
        change = np.bincount(self.pair, self.sign * w[self.feature], minlength=len(self.row))
        return margin[self.row] + change

    def penalty(self, w: np.ndarray, margin: np.ndarray) -> float:
        """The weighted sum of squared changes of the score."""
        return float(self.often @ (sigmoid(self.margins(w, margin)) - sigmoid(margin[self.row])) ** 2)

    def gradient(self, w: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slope of the penalty along the margins of the texts, and along the weights of the
        features that come and go."""
        after, before = sigmoid(self.margins(w, margin)), sigmoid(margin[self.row])
        pull = 2 * self.often * (after - before)
        ahead = pull * after * (1 - after)
        rows = np.bincount(self.row, ahead - pull * before * (1 - before), minlength=len(margin))
        return rows, np.bincount(self.feature, self.sign * ahead[self.pair], minlength=len(w))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def features_of(
    sample: DataFrame, features: list[str], kinds: dict[str, list[str]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, Swaps]:
    """Labels, feature numbers of all rows in a line, how many each row has, and the swaps.

    Rows come in the order of their digests, so that sums do not depend on the partitions.
    """
    number = {f: i for i, f in enumerate(features)}

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Bounded(
            lambda word: frozenset(number[f] for f in word_features(word) if f in number), WORDS_KEPT
        )
        terms = {term for group in kinds.values() for term in group}

        def numbers(words: set[str]) -> set[int]:
            return set().union(*map(known.__getitem__, words))

        for batch in slices(batches, ROWS_AT_ONCE):
            found, come, go, often = [], [], [], []
            for words in map(set, batch.column("words").to_pylist()):
                own = numbers(words)
                swaps = list(swapped_words(words, kinds)) if not terms.isdisjoint(words) else []
                others = [numbers(swapped) for swapped, _ in swaps]
                found.append(sorted(own))
                come.append([sorted(other - own) for other in others])
                go.append([sorted(own - other) for other in others])
                often.append([share for _, share in swaps])
            lists = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("digest"),
                    batch.column("toxic"),
                    pa.array(found, pa.list_(pa.int32())),
                    pa.array(come, lists),
                    pa.array(go, lists),
                    pa.array(often, pa.list_(pa.float64())),
                ],
                ["digest", "toxic", "found", "come", "go", "often"],
            )

    schema = (
        "digest long, toxic int, found array<int>, come array<array<int>>, go array<array<int>>,"
        " often array<double>"
    )
    table = sample.mapInArrow(look_up, schema).toArrow()
    table = table.sort_by([("digest", "ascending"), ("toxic", "ascending")])
    found, come, go, often = (table.column(c).combine_chunks() for c in ("found", "come", "go", "often"))
    row = np.repeat(np.arange(len(often)), np.diff(often.offsets.to_numpy()))
    sides = []
    for nested, sign in ((come, 1.0), (go, -1.0)):
        inner = nested.flatten()
        sizes = np.diff(inner.offsets.to_numpy()) if len(inner) else np.empty(0, np.int64)
        feature = inner.flatten().to_numpy().astype(np.int64)
        sides.append((np.repeat(np.arange(len(inner)), sizes), feature, np.full(len(feature), sign)))
    pair, feature, sign = (np.concatenate(parts) for parts in zip(*sides, strict=True))
    swaps = Swaps(row, often.flatten().to_numpy(), pair, feature, sign)
    sizes = np.diff(found.offsets.to_numpy())
    return table.column("toxic").to_numpy(), found.flatten().to_numpy(), sizes, swaps


def fit_weights(
    toxic: np.ndarray,
    found: np.ndarray,
    sizes: np.ndarray,
    n_features: int,
    swaps: Swaps,
) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated proximal gradient steps with backtracking.

    Minimises mean log loss + L1 |w| + SWAP_PENALTY times the mean squared score change over swaps.
    """
    n = len(toxic)
    row = np.repeat(np.arange(n), sizes)
    swaps = replace(swaps, often=SWAP_PENALTY * swaps.often / n)

    def loss(w: np.ndarray, bias: float) -> tuple[float, np.ndarray]:
        margin = bias + np.bincount(row, weights=w[found], minlength=n)
        fitting = np.mean(np.logaddexp(0, margin) - toxic * margin)
        return fitting + swaps.penalty(w, margin), margin

    def gradient(w: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, float]:
        rows, features = swaps.gradient(w, margin)
        residual = (1 / (1 + np.exp(-margin)) - toxic) / n + rows
        g = np.bincount(found, weights=residual[row], minlength=n_features)
        return g + features, residual.sum()

    rate = (toxic.sum() + PRIOR) / (n + 1)
    w, bias = np.zeros(n_features), float(np.log(rate / (1 - rate)))
    ahead, ahead_bias, pace, step = w, bias, 1.0, 64.0
    for _ in range(STEPS):
        value, margin = loss(ahead, ahead_bias)
        g, g_bias = gradient(ahead, margin)
        while True:
            moved = ahead - step * g
            new = np.sign(moved) * np.maximum(np.abs(moved) - step * L1, 0)
            new_bias = ahead_bias - step * g_bias
            by, by_bias = new - ahead, new_bias - ahead_bias
            bound = value + g @ by + g_bias * by_bias + (by @ by + by_bias**2) / (2 * step)
            if step < 1e-6 or loss(new, new_bias)[0] <= bound + 1e-12:
                break
            step /= 2
        next_pace = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        push = (pace - 1) / next_pace
        ahead, ahead_bias = new + push * (new - w), new_bias + push * (new_bias - bias)
        settled = np.abs(new - w).max(initial=0) < 1e-5
        w, bias, pace = new, new_bias, next_pace
        if settled:
            break
    return w, bias


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    kinds: dict[str, list[str]] | None = None,
    max_labelled: int = MAX_LABELLED,
    max_features: int = MAX_FEATURES,
    least_documents: int = LEAST_DOCUMENTS,
) -> Model:
    """A model from the labelled documents that are not held out.

    Labels are 0 or 1. Without labelled documents every text scores ``PRIOR``; with one class
    only, every text scores that class's smoothed rate.
    """
    kinds = IDENTITY_TERMS if kinds is None else kinds
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, max_labelled)
    sample = materialize(sample, "labelled-words")
    n, n_toxic = sample.agg(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if n_toxic in (0, n):
        rate = (n_toxic + PRIOR) / (n + 1)
        return Model({}, float(np.log(rate / (1 - rate))))
    # Identity terms are always features, so that swaps can act on them.
    terms = sorted({f"={t}" for group in kinds.values() for t in group})
    telling = telling_features(sample, n, n_toxic, max_features, least_documents)
    features = terms + [f for f in telling if f not in set(terms)]
    toxic, found, sizes, swaps = features_of(sample, features, kinds)
    w, bias = fit_weights(toxic, found, sizes, len(features), swaps)
    return Model({f: float(v) for f, v in zip(features, w, strict=True) if v}, bias)


def scorer(model: Model) -> Callable[[Column], Column]:
    """A column function that scores texts with ``model``."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = model.scores()
        for texts in batches:
            yield texts.map(of).astype("float64")

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, "double")


def score_documents(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row of ``docs``.

    Whole texts are scored; null counts as the empty text, which scores the bias. Repeated rows
    give a row each, an empty table none; a null id is not held out. Other columns are ignored.
    """
    scored = docs.select(
        F.col(id_col),
        held_out(id_col).alias("held_out"),
        scorer(model)(text_or_empty(text_col)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(
    docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all columns.

    Null and blank texts score the bias, very long ones count whole; repeated rows are judged alike,
    an empty table gives an empty result, and ``docs`` may have columns of any name.
    """
    return docs.where(scorer(model)(text_or_empty(text_col)) < threshold)
