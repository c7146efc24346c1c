"""Spelling variants: words one edit apart, found by composing finite-state machines.

The vocabulary's minimised acceptor A is composed with a one-edit transducer T and with A again; the
accepted pairs of A o T o A are the words that differ by one inserted, deleted or replaced code
point. The composition is enumerated per initial state: a task holds the part of A that is entered
by one prefix, minimised, and walks the pairs of states that T allows from there.

Two words one edit apart, the shorter of ``n`` code points, agree in their first ``n // 2`` code
points or in all the others. So a pair is found at the state behind its common prefix, or behind
its common suffix in the acceptor of the reversed words. A state that very many words pass is
opened further: its words meet by the place of the edit, and what is equal behind it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurespark.llm.common import ascii_lower, text_or_empty
from featurespark.session import bounded_side, materialize

# Letters of a run, and the rule by which a run loses a code point.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LOSS_MODULUS = 97
# Words behind one state that a task composes together.
PART_WORDS = 20_000
NEAR = pa.schema({"word": pa.string(), "n_near": pa.int64(), "best_n": pa.int64(), "best": pa.string()})


class Acceptor:
    """A minimised acyclic acceptor, built from sorted words; equal right languages are one state."""

    def __init__(self):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, tuple(arcs.items()))
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return state

    def add(self, words: list[str]) -> int:
        """The initial state that accepts exactly ``words``, which are sorted and distinct."""
        finals, open_arcs = [False], [{}]
        last = ""
        for word in words:
            same = 0
            for x, y in zip(last, word, strict=False):
                if x != y:
                    break
                same += 1
            self._close(last, same, finals, open_arcs)
            finals += [False] * (len(word) - same)
            open_arcs += [{} for _ in range(len(word) - same)]
            finals[-1] = True
            last = word
        self._close(last, 0, finals, open_arcs)
        return self._state(finals[0], open_arcs[0])

    def _close(self, word: str, depth: int, finals: list[bool], open_arcs: list[dict[str, int]]) -> None:
        for at in range(len(word), depth, -1):
            open_arcs[at - 1][word[at - 1]] = self._state(finals.pop(), open_arcs.pop())

    def common(self, a: int, b: int, but: str = "") -> Iterator[str]:
        """The words that are accepted from both states; none that begins with ``but``."""
        work = [(a, b, "")]
        while work:
            a, b, word = work.pop()
            if self.final[a] and self.final[b]:
                yield word
            theirs = self.arcs[b]
            for letter, target in self.arcs[a].items():
                if letter in theirs and (word or letter != but):
                    work.append((target, theirs[letter], word + letter))


def one_edit_pairs(same: list[str], longer: list[str]) -> Iterator[tuple[str, str]]:
    """All pairs one edit apart: of ``same`` with itself, and of ``same`` with the ``longer`` words.

    Words of a list are sorted, distinct and of one length, the longer ones by one code point. The
    walk goes along pairs of states before the edit; there the transducer replaces a letter or
    reads one more of the longer word, and from the states behind it both must go on alike. An
    insertion into a run of one letter is taken at its end, so each pair comes once.
    """
    if not same:
        return
    acceptor = Acceptor()
    a = acceptor.add(same)
    b = acceptor.add(longer) if longer else None
    arcs = acceptor.arcs
    work = [(a, b, "")]
    while work:
        a, b, before = work.pop()
        mine = list(arcs[a].items())
        for i, (x, p) in enumerate(mine):
            for y, q in mine[i + 1 :]:
                for rest in acceptor.common(p, q):
                    yield before + x + rest, before + y + rest
        theirs = {} if b is None else arcs[b]
        for x, q in theirs.items():
            for rest in acceptor.common(a, q, but=x):
                yield before + rest, before + x + rest
        work += [(p, theirs.get(x), before + x) for x, p in mine]


def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function from sorted (state, n, turned, edit, word, count) to each word's near words there.

    ``state`` names the prefix (``turned``: of the reversed words) and ``n`` the shorter length.
    ``edit`` is the only place of the edit in an opened state, else -1.
    """

    def shown(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(NEAR.names, r, strict=True)) for r in rows], NEAR)

    held: list[tuple[int, bool, int, str, int]] = []
    found: list[tuple[str, int, int, str]] = []
    state = None
    for batch in batches:
        for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != state:
                if len(held) > 1:
                    found += near_words(held)
                held, state = [], key
            held.append(row)
        yield shown(found)
        found = []
    if len(held) > 1:
        yield shown(near_words(held))


def near_words(rows: list[tuple[int, bool, int, str, int]]) -> list[tuple[str, int, int, str]]:
    """For each word of a state: how many words are near here, and the best of them."""
    n, turned, edit = rows[0][:3]
    counts = {word: count for *_, word, count in rows}
    found: dict[str, tuple[int, int, str]] = {}

    def note(word: str, near: str) -> None:
        size, count, form = found.get(word, (0, 0, ""))
        # Words are compared as they are read, also in the acceptor of reversed words.
        if (-counts[near], shown(near)) < (-count, shown(form)):
            count, form = counts[near], near
        found[word] = size + 1, count, form

    def shown(word: str) -> str:
        return word[::-1] if turned else word

    depth = n // 2 if not turned else n - n // 2
    skip = depth if edit < 0 else edit
    prefix = rows[0][3][:skip]
    same = [word[skip:] for *_, word, _ in rows if len(word) == n]
    longer = [word[skip:] for *_, word, _ in rows if len(word) > n]
    for a, b in one_edit_pairs(same, longer):
        a, b = prefix + a, prefix + b
        if edit >= 0 and edit != edit_place(a, b):
            continue
        if turned and a[::-1][: n // 2] == b[::-1][: n // 2]:
            continue  # found behind the common prefix
        note(a, b)
        note(b, a)
    return [(shown(w), size, count, shown(form)) for w, (size, count, form) in found.items()]


def edit_place(a: str, b: str) -> int:
    """Where two words one edit apart first differ."""
    for i, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return i
    return min(len(a), len(b))


def observed(id_: Column, run: Column) -> Column:
    """A lower-cased run, without one code point where 97 divides the CRC-32 of ``<id>:<run>``."""
    crc = F.crc32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = F.pmod(crc, F.length(run).cast("long")).cast("int")
    shorter = F.concat(F.left(run, place), F.substring(run, place + 2, F.length(run)))
    return F.when(F.pmod(crc, F.lit(LOSS_MODULUS)) == 0, shorter).otherwise(run)


def vocabulary(
    docs: DataFrame, id_col: str, text_col: str, min_length: int, min_count: int
) -> DataFrame:
    """``word, n``: observed words of at least ``min_length`` code points seen ``min_count`` times."""
    runs = F.explode(F.regexp_extract_all(text_or_empty(text_col), F.lit(RUN), F.lit(0)))
    plain = F.octet_length("run") == F.length("run")
    lowered = F.when(plain, F.lower("run")).otherwise(ascii_lower(F.col("run")))
    words = (
        docs.select(F.col(id_col).alias("id"), runs.alias("run"))
        .where(F.length("run") >= min_length)
        .select("id", lowered.alias("run"))
        .select(observed(F.col("id"), F.col("run")).alias("word"))
    )
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.length("word") >= min_length) & (F.col("n") >= min_count))


def passing(words: DataFrame, min_length: int) -> DataFrame:
    """``state, n, turned, word, count`` for the states at which a word can meet a near one.

    ``word`` is reversed where ``turned``. Each word comes as the shorter one of a pair, and as the
    longer one.
    """
    length = F.length("word")
    roles = F.explode(F.array(length, length - 1))
    rows = words.select("word", F.col("n").alias("count"), roles.alias("n")).where(F.col("n") >= min_length)
    rows = rows.withColumn("turned", F.explode(F.array(F.lit(False), F.lit(True))))
    rows = rows.withColumn("word", F.when(F.col("turned"), F.reverse("word")).otherwise(F.col("word")))
    half = F.floor(F.col("n") / 2).cast("int")
    depth = F.when(F.col("turned"), F.col("n") - half).otherwise(half)
    side = F.when(F.col("turned"), F.lit("<")).otherwise(F.lit(">"))
    state = F.concat(F.col("n").cast("string"), side, F.left("word", depth))
    return rows.select(state.alias("state"), "n", "turned", "word", "count")


def opened(rows: DataFrame) -> DataFrame:
    """The words of states with very many of them, by the place of the edit and what is behind it."""
    half = F.floor(F.col("n") / 2).cast("int")
    depth = F.when(F.col("turned"), F.col("n") - half).otherwise(half)
    rows = rows.withColumn("edit", F.explode(F.sequence(depth, F.length("word"))))
    # The longer word without its letter there, the shorter one as it is or without its letter.
    before, behind = F.left("word", F.col("edit")), F.col("edit") + 2
    without = F.concat(before, F.lit("_"), F.substring("word", behind, F.col("n")))
    whole = F.concat(before, F.lit("+"), F.substring("word", behind - 1, F.col("n")))
    gap = F.concat(before, F.lit("+"), F.substring("word", behind, F.col("n")))
    is_longer = F.length("word") > F.col("n")
    keys = F.when(is_longer, F.array(gap)).otherwise(F.array(whole, without))
    rows = rows.withColumn("rest", F.explode(keys))
    place = [F.col(c).cast("string") for c in ("n", "turned", "edit")]
    state = F.concat_ws("|", *place, "rest")
    return rows.select(state.alias("state"), "n", "turned", "edit", "word", "count")


def nearest(words: DataFrame, min_length: int, part_words: int = PART_WORDS) -> DataFrame:
    """``word, n_near, best_n, best`` for every word that has a near one."""
    rows = materialize(passing(words, min_length), "states")
    sizes = rows.groupBy("state").agg(F.count(F.lit(1)).alias("words"))
    hot = bounded_side(sizes.where(F.col("words") > part_words).select("state"))
    plain = rows.join(hot, "state", "left_anti").withColumn("edit", F.lit(-1))
    split = opened(rows.join(hot, "state", "left_semi"))
    columns = ["state", "n", "turned", "edit", "word", "count"]
    parts = plain.select(*columns).union(split.select(*columns))
    ordered = parts.repartition("state").sortWithinPartitions("state", "word")
    near = ordered.mapInArrow(compose, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))).alias("top")
    found = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.form").alias("best")
    )


def roots(formed: DataFrame) -> DataFrame:
    """``word, root`` of every row of ``word, form`` that has a form: the last word along the forms.

    Each round doubles the steps taken. A form is at least twice as frequent as its word, so the
    number of rounds is at most the logarithm of the logarithm of the largest count.
    """
    steps = materialize(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = steps.join(ahead, "root", "left")
        if moved.where("further IS NOT NULL").isEmpty():
            return steps
        steps = materialize(moved.select("word", F.coalesce("further", "root").alias("root")), "roots")


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 5,
    min_count: int = 3,
    ratio: int = 2,
    part_words: int = PART_WORDS,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts.

    Words are runs of Latin letters with A-Z lower-cased, damaged by the rule of :func:`observed`,
    with at least ``min_length`` (4 or more) code points and ``min_count`` occurrences. Near words
    differ by one inserted, deleted or replaced code point. ``form`` is the near word of largest
    count, the first in code-point order of several, where its count is at least ``ratio`` (2 or
    more) times the word's, else null; ``root`` is the last word along the forms. Null texts have
    no words, a null id counts as the empty string, repeated rows count again, very long texts and
    words count whole, an empty table gives an empty result. Other columns are ignored.
    """
    if min_length < 4 or ratio < 2:
        raise ValueError("min_length must be 4 or more, and ratio 2 or more")
    words = materialize(vocabulary(docs, id_col, text_col, min_length, min_count), "vocabulary")
    is_form = F.col("best_n") >= ratio * F.col("n")
    formed = words.join(nearest(words, min_length, part_words), "word", "left").select(
        "word",
        F.when(is_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    formed = materialize(formed, "forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
