"""Repair of conversation structure: the cheapest edits that give alternating roles, with an audit.

A dynamic programme walks a conversation's rows and keeps, for each state of the role pattern
``(s?(ua)+)?``, the cheapest edits so far, the ASCII-least audit of several. Audits are persistent:
each is a node that links to its prefix, so they share what they have in common. A node also holds
its binary-lifting ancestors and the rolling hash of its string; two audits of one cost are compared
by a search for their longest common prefix, and the letters before it are verified.

Rows are range-partitioned by conversation and order. A conversation that reaches into several
partitions, or has very many rows, is walked in pieces: each piece gives the best edits from every
state to every other one, and the pieces are put together afterwards. So a hot conversation is
spread over tasks, and memory is bounded by a piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurespark.session import materialize

# Costs of edits and faults, and the rule that damages rows.
RENAME_COST = 1
DELETE_COST = 2
INSERT_COST = 5
TRUNCATED_COST = 5
DAMAGE_MODULUS = 20
NOT_BLANK = "[^\\x20\\x09-\\x0D]"
SENTENCE_END = ".!?"

# States of the pattern: nothing yet, behind the system row, behind a user, behind an assistant.
STATES = START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
COMPLETE = (START, ASSISTANT)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
LEGAL_PAIRS = {"su", "ua", "au"}
# The turn that an edit may give a row in each state.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

BLANK, DUPLICATE, TRUNCATED, SOUND = range(4)
PIECE_ROWS = 10_000
HASH_BASE, HASH_PRIME = 1_000_003, (1 << 61) - 1


class Audits:
    """Edit strings as linked nodes that share their prefixes; node 0 is the empty string."""

    def __init__(self):
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.above: list[list[int]] = [[]]

    def extend(self, node: int, letter: str) -> int:
        above, k = [node], 0
        while k < len(self.above[above[k]]):
            above.append(self.above[above[k]][k])
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * HASH_BASE + ord(letter)) % HASH_PRIME)
        self.above.append(above)
        return len(self.letter) - 1

    def prefix(self, node: int, depth: int) -> int:
        """The node of the first ``depth`` letters."""
        rest = self.depth[node] - depth
        while rest:
            k = rest.bit_length() - 1
            node = self.above[node][k]
            rest -= 1 << k
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` sorts before that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.prefix(a, depth), self.prefix(b, depth)
        first = None
        if self.hash[x] != self.hash[y]:
            for k in range(len(self.above[x]) - 1, -1, -1):
                if k < len(self.above[x]) and self.hash[self.above[x][k]] != self.hash[self.above[y][k]]:
                    x, y = self.above[x][k], self.above[y][k]
            first = self.letter[x], self.letter[y]
            x, y = self.above[x][0], self.above[y][0]
        # Equal hashes are verified: up to a shared node the letters are compared.
        while x != y:
            if self.letter[x] != self.letter[y]:
                first = self.letter[x], self.letter[y]
            x, y = self.above[x][0], self.above[y][0]
        return self.depth[a] < self.depth[b] if first is None else first[0] < first[1]

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.above[node][0]
        return "".join(reversed(letters))


class Walk:
    """The programme over the rows of a piece, from one state."""

    def __init__(self, audits: Audits, start: int):
        self.audits = audits
        self.best: dict[int, tuple[int, int]] = {start: (0, 0)}
        self.insert()

    def offer(self, best: dict, state: int, cost: int, node: int, letter: str) -> None:
        known = best.get(state)
        if known is not None and known[0] < cost:
            return
        made = self.audits.extend(node, letter)
        if known is None or cost < known[0] or self.audits.less(made, known[1]):
            best[state] = cost, made

    def insert(self) -> None:
        """Rows may be inserted here; two at most are of use."""
        for _ in range(2):
            for state in STATES:
                if state in self.best:
                    cost, node = self.best[state]
                    self.offer(self.best, NEXT[state], cost + INSERT_COST, node, "I")

    def step(self, initial: str, fault: int) -> None:
        best: dict[int, tuple[int, int]] = {}
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for state, (cost, node) in self.best.items():
            self.offer(best, state, cost + DELETE_COST, node, "D")
            if fault in (BLANK, DUPLICATE):
                continue
            if initial in AFTER[state]:
                self.offer(best, AFTER[state][initial], cost + extra, node, "K")
            self.offer(best, NEXT[state], cost + RENAME_COST + extra, node, "R")
        self.best = best
        self.insert()


class Piece:
    """A run of rows of one conversation, and what its walks need to be put together."""

    def __init__(self, conv, place: int, at: int, starts: tuple[int, ...]):
        self.conv, self.place, self.at = conv, place, at
        audits = Audits()
        self.walks = {start: Walk(audits, start) for start in starts}
        self.rows = self.illegal = self.turns = 0
        self.faults = [0, 0, 0, 0]
        self.first = self.last = self.lo = self.hi = None

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        for walk in self.walks.values():
            walk.step(initial, fault)
        if self.rows:
            self.illegal += self.last + initial not in LEGAL_PAIRS
        else:
            self.first = initial
        self.last = initial
        self.faults[fault] += 1
        if turn is not None and turn != self.hi:
            self.turns += 1
            self.lo, self.hi = turn if self.lo is None else self.lo, turn
        self.rows += 1

    def shown(self) -> dict:
        edits = [
            {"start": start, "end": end, "cost": cost, "audit": walk.audits.text(node)}
            for start, walk in self.walks.items()
            for end, (cost, node) in walk.best.items()
        ]
        return {
            "conv": self.conv, "place": self.place, "at": self.at, "edits": edits,
            "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
            "truncated": self.faults[TRUNCATED], "illegal": self.illegal, "turns": self.turns,
            "lo": self.lo, "hi": self.hi, "first": self.first, "last": self.last,
        }


EDITS = "edits array<struct<start int, end int, cost long, audit string>>"
COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
PIECE_FIELDS = (
    f"place long, at long, {EDITS}, {', '.join(f'{c} long' for c in COUNTS)},"
    " lo long, hi long, first string, last string"
)


def _batch(rows: list[dict], kind: pa.DataType, fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([("conv", kind), *fields]))


def walk_pieces(piece_rows: int):
    """Arrow function from ordered (part, place, conv, turn, initial, fault, later, copies) to pieces.

    The first row has ``fault``, its further copies ``later``.
    """
    edits = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    )
    fields = [("place", pa.int64()), ("at", pa.int64()), ("edits", edits)]
    fields += [(c, pa.int64()) for c in (*COUNTS, "lo", "hi")] + [("first", pa.string()), ("last", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, known, kind = None, None, None
        for batch in batches:
            done, kind = [], batch.column(2).type
            columns = (c.to_pylist() for c in batch.columns)
            for part, place, conv, turn, initial, fault, later, copies in zip(*columns, strict=True):
                for at in range(copies):
                    new = piece is None or known[1] != conv or known[0] != part
                    if new or piece.rows >= piece_rows:
                        if piece is not None:
                            done.append(piece.shown())
                        # Only a conversation that opens a partition, or goes on, has other starts.
                        inside = new and known is not None and known[0] == part
                        piece = Piece(conv, place, at, (START,) if inside else STATES)
                        known = part, conv
                    piece.add(turn, initial, later if at else fault)
            if done:
                yield _batch(done, kind, fields)
        if piece is not None:
            yield _batch([piece.shown()], kind, fields)

    return run


def put_together(pieces: list[dict]) -> tuple[dict, list[dict]]:
    """One conversation's counts, cost and audit from its ordered pieces, and each piece's edits."""
    best = {START: (0, None)}

    def string(link) -> str:
        parts = []
        while link is not None:
            link, part, _ = link
            parts.append(part)
        return "".join(reversed(parts))

    def better(new, known) -> bool:
        if known is None or new[0] != known[0]:
            return known is None or new[0] < known[0]
        return string(new[1]) < string(known[1])

    for piece in pieces:
        further: dict[int, tuple] = {}
        for edit in piece["edits"]:
            if edit["start"] in best:
                cost, link = best[edit["start"]]
                new = cost + edit["cost"], (link, edit["audit"], edit["start"])
                if better(new, further.get(edit["end"])):
                    further[edit["end"]] = new
        best = further
    chosen = None
    for state in COMPLETE:
        if state in best and better(best[state], chosen):
            chosen = best[state]
    total = {c: sum(p[c] for p in pieces) for c in COUNTS}
    for one, two in zip(pieces, pieces[1:], strict=False):
        total["illegal"] += one["last"] + two["first"] not in LEGAL_PAIRS
        total["turns"] -= one["hi"] is not None and one["hi"] == two["lo"]
    turns, lows = total.pop("turns"), [p["lo"] for p in pieces if p["lo"] is not None]
    highs = [p["hi"] for p in pieces if p["hi"] is not None]
    total["gaps"] = highs[-1] - lows[0] + 1 - turns if lows else 0
    total |= {"conv": pieces[0]["conv"], "cost": chosen[0], "audit": string(chosen[1]), "place": None}
    link, parts = chosen[1], []
    for piece in reversed(pieces):
        link, audit, start = link
        place = {"conv": piece["conv"], "place": piece["place"], "at": piece["at"]}
        parts.append(place | {"start": start, "audit": audit})
    return total, parts


AUDIT_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
AUDIT_FIELDS = f"{', '.join(f'{c} long' for c in AUDIT_COUNTS)}, audit string, place long, at long, start int"


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function from ordered pieces to one row for each conversation (``place`` null) and piece."""
    fields = [(c, pa.int64()) for c in AUDIT_COUNTS]
    fields += [("audit", pa.string()), ("place", pa.int64()), ("at", pa.int64()), ("start", pa.int32())]
    held: list[dict] = []
    kind = None
    for batch in batches:
        done, kind = [], batch.column(0).type
        for piece in batch.to_pylist():
            if held and held[0]["conv"] != piece["conv"]:
                total, parts = put_together(held)
                done += [total, *parts]
                held = []
            held.append(piece)
        if done:
            yield _batch(done, kind, fields)
    if held:
        total, parts = put_together(held)
        yield _batch([total, *parts], kind, fields)


REPAIRED_FIELDS = "place long, step long, edit string, role string, text string"


def apply_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function from ordered (part, place, kind, at, conv, start, audit, role, text, copies) to
    the rows after the edits; deleted ones come with edit D. Rows of kind 0 bring a piece's edits."""
    fields = [("place", pa.int64()), ("step", pa.int64())]
    fields += [(c, pa.string()) for c in ("edit", "role", "text")]
    queue: list[tuple[int, str]] = []
    letters, at, body, state = "", 0, 0, START
    owner = place = conv_type = None
    step = 0
    out: list[dict] = []

    def emit(edit: str, role: str | None, text: str | None) -> None:
        nonlocal step
        out.append({"conv": owner, "place": place, "step": step, "edit": edit, "role": role, "text": text})
        step += 1

    def inserts() -> None:
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            state, at = NEXT[state], at + 1
            emit("I", ROLE_OF[state], "")

    for batch in batches:
        conv_type = batch.column(4).type
        columns = (c.to_pylist() for c in batch.columns)
        for _, here, kind, _, conv, start, audit, role, text, copies in zip(*columns, strict=True):
            if kind == 0:
                queue.append((start, audit))
                continue
            owner, place, step = conv, here, 0
            for _ in range(copies):
                if at == len(letters):
                    (state, letters), at = queue.pop(0), 0
                    body = len(letters.rstrip("I"))
                inserts()
                edit, at = letters[at], at + 1
                if edit == "K":
                    state = AFTER[state][role[:1]]
                elif edit == "R":
                    state = NEXT[state]
                emit(edit, ROLE_OF[state] if edit == "R" else role, text)
                if at == body:
                    inserts()
        if out:
            yield _batch(out, conv_type, fields)
            out = []


class Repair(NamedTuple):
    """``audits``: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of each
    conversation. ``rows``: ``conv, place, step, edit, role, text``, in order of place and step."""

    audits: DataFrame
    rows: DataFrame


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> Repair:
    """The cheapest edits that give every conversation the roles ``(s?(ua)+)?``.

    ``rows`` has ``conv, turn, role, text`` and ``copies``, how often the row stands there. Rows are
    ordered by turn (nulls first); rows of one turn by a hash of role and text, so equal ones are
    adjacent. Null roles and texts count as one space, a null ``conv`` is a conversation of its own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    counted = rows.select("conv", F.col("turn").cast("long").alias("turn"), role, text, "copies")
    counted = counted.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    counted = counted.withColumn("mix", F.xxhash64("role", "text"))
    ranged = counted.repartitionByRange("conv", "turn", "mix")
    ordered = ranged.sortWithinPartitions("conv", "turn", "mix", "role", "text")
    placed = materialize(ordered.withColumn("place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    conv_kind = placed.schema["conv"].dataType.simpleString()

    pieces = _faults(placed).repartition("part").sortWithinPartitions("part", "place")
    pieces = pieces.select("part", "place", "conv", "turn", "initial", "fault", "later", "copies")
    pieces = pieces.mapInArrow(walk_pieces(piece_rows), f"conv {conv_kind}, {PIECE_FIELDS}")
    by_conv = pieces.repartition("conv").sortWithinPartitions("conv", "place", "at")
    found = materialize(by_conv.mapInArrow(fold, f"conv {conv_kind}, {AUDIT_FIELDS}"), "audits")
    audits = found.where("place IS NULL").select("conv", *AUDIT_COUNTS, "audit")

    columns = ["part", "place", "kind", "at", "conv", "start", "audit", "role", "text", "copies"]
    edits = found.where("place IS NOT NULL").select(
        F.shiftright("place", 33).alias("part"), "place", F.lit(0).alias("kind"), "at", "conv", "start",
        "audit", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.lit(0).cast("long").alias("copies"),
    )
    texts = placed.select(
        "part", "place", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("at"), "conv",
        F.lit(None).cast("int").alias("start"), F.lit(None).cast("string").alias("audit"), "role", "text",
        "copies",
    )
    merged = texts.select(*columns).union(edits.select(*columns)).repartition("part")
    merged = merged.sortWithinPartitions("part", "place", "kind", "at")
    return Repair(audits, merged.mapInArrow(apply_edits, f"conv {conv_kind}, {REPAIRED_FIELDS}"))


def _faults(placed: DataFrame) -> DataFrame:
    """Rows with the first fault of their first copy, and of the later ones."""
    digest = F.sha2("text", 256).alias("digest")
    last = F.right(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), F.lit(1))
    light = placed.select(
        "part", "place", "conv", "turn", "role", "copies", digest,
        (~F.col("text").rlike(NOT_BLANK)).alias("is_blank"),
        (~F.contains(F.lit(SENTENCE_END), last)).alias("is_truncated"),
    )
    # Where a role and text stand at several turns, only the first of them is no duplicate.
    seen = light.where(~F.col("is_blank")).groupBy("conv", "role", "digest")
    seen = seen.agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first_place"))
    keys = {c: f"seen_{c}" for c in ("conv", "role", "digest")}
    seen = seen.where("rows > 1").drop("rows").withColumnsRenamed(keys)
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]
    joined = light.join(seen, same[0] & same[1] & same[2], "left")
    again = F.col("place") > F.coalesce("first_place", "place")
    fault = (
        F.when(F.col("is_blank"), BLANK)
        .when(again, DUPLICATE)
        .when(F.col("is_truncated"), TRUNCATED)
        .otherwise(SOUND)
    )
    return joined.select(
        "part", "place", "conv", "turn", F.left("role", F.lit(1)).alias("initial"),
        fault.alias("fault"), F.when(F.col("is_blank"), BLANK).otherwise(DUPLICATE).alias("later"), "copies",
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text, copies`` of ``conversations`` after a fixed rule has damaged them."""
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    rule: Column = F.pmod(F.crc32(key.cast("binary")), F.lit(DAMAGE_MODULUS))
    text = F.coalesce("text", space)
    unended = F.regexp_replace(text, f"[{SENTENCE_END}]", "")
    rows = conversations.select("conv_id", "turn", "role", "text", rule.alias("rule"))
    rows = rows.where(F.col("rule") != 0)
    return rows.select(
        F.col("conv_id").alias("conv"),
        "turn",
        F.when(F.col("rule") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("rule") == 1, "").when(F.col("rule") == 2, unended).otherwise(text).alias("text"),
        F.when(F.col("rule") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function from ordered (conv, role, text) to the SHA-256 of each conversation's lines."""
    conv = digest = kind = None
    for batch in batches:
        kind, done = batch.column(0).type, []
        for key, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if digest is None or key != conv:
                if digest is not None:
                    done.append({"conv": conv, "repaired_sha256": digest.hexdigest()})
                conv, digest = key, hashlib.sha256(f"{role}:{text}".encode())
            else:
                digest.update(f"\n{role}:{text}".encode())
        if done:
            yield _batch(done, kind, [("repaired_sha256", pa.string())])
    if digest is not None:
        rows = [{"conv": conv, "repaired_sha256": digest.hexdigest()}]
        yield _batch(rows, kind, [("repaired_sha256", pa.string())])


def audit_damaged(conversations: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row for every ``conv_id``, damaged by :func:`damaged` and repaired by :func:`repair`:
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Null ids are one conversation, null turns come first, null roles and texts count as one space;
    repeated rows are duplicates, very long texts count whole. A conversation without rows after
    the damage has zeros, an empty audit and the hash of the empty string; an empty table gives an
    empty result. Other columns are ignored. The hash reads a conversation's rows one after
    another, in the stream of one task.
    """
    done = repair(damaged(conversations), piece_rows)
    conv_kind = done.audits.schema["conv"].dataType.simpleString()
    lines = done.rows.where("edit <> 'D'").repartition("conv").sortWithinPartitions("conv", "place", "step")
    hashes = lines.select("conv", "role", "text").mapInArrow(
        hash_rows, f"conv {conv_kind}, repaired_sha256 string"
    )
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    audits, hashes = done.audits.alias("a"), hashes.alias("h")
    joined = ids.join(audits, F.col("id").eqNullSafe(F.col("a.conv")), "left")
    joined = joined.join(hashes, F.col("id").eqNullSafe(F.col("h.conv")), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in AUDIT_COUNTS]
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        F.col("id").alias("conv_id"),
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", empty).alias("repaired_sha256"),
    )
