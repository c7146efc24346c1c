"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pyarrow as pa
import pytest
from featurespark.llm import conversation_repair
from featurespark.llm.conversation_repair import Audits, audit_damaged

SF_DIR = "/root/testdata/sf0.01"
NOT_BLANK = "[^\x20\x09-\x0d]"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        shown = [" " if v is None else v for v in (conv, turn)]
        rule = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        if rule == 1:
            text = ""
        elif rule == 2:
            text = re.sub("[.!?]", "", text)
        elif rule == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(rule, 1)
    return out


def cheapest(rows, insert_cost=5):
    """(cost, audit, repaired rows) of ``role, text, fault``, from the end to the start."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(maxsize=None)
    def best(i, state, inserts):
        found = []

        def add(cost, letter, line, rest):
            found.append((cost + rest[0], letter + rest[1], line + rest[2]))

        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if i < len(rows):
            role, text, fault = rows[i]
            add(2, "D", (), best(i + 1, state, 0))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if (state, role[:1]) in after:
                    add(extra, "K", (f"{role}:{text}",), best(i + 1, after[state, role[:1]], 0))
                for to, name in names.items():
                    if (state, to) in after:
                        add(1 + extra, "R", (f"{name}:{text}",), best(i + 1, to, 0))
        if inserts < 4:
            for to, name in names.items():
                if (state, to) in after:
                    add(insert_cost, "I", (f"{name}:",), best(i, to, inserts + 1))
        return min(found, key=lambda f: f[:2], default=(10**9, "", ()))

    for i in range(len(rows), 0, -100):
        # From the end, so that the recursion stays flat.
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def brute(rows, order):
    """The audit of every conversation; rows of one turn go by ``order(role, text)``."""
    convs = {r[0]: [] for r in rows}
    for r in plain_damage(rows):
        convs[r[0]].append(r)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, order(r[2], r[3]), r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in own:
            letters = re.findall(NOT_BLANK, text)
            if not letters:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if letters[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = {r[1] for r in own if r[1] is not None}
        initials = [r[2][:1] for r in own]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False))
        cost, audit, lines = cheapest([(r[2], r[3], f) for r, f in zip(own, faults, strict=True)])
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rows_of(df):
    found = df.collect()
    assert len(found) == len({r["conv_id"] for r in found})
    names = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return {r["conv_id"]: tuple(r[n] for n in names) for r in found}


def mixes(spark, rows):
    """The order that the operator gives rows of one turn."""
    pairs = list({(" " if r is None else r, " " if t is None else t) for r, t in (x[2:] for x in rows)})
    pairs += [("user", t) for _, t in pairs] + [(r, "") for r, _ in pairs] + [("user", "")]
    pairs += [(r, re.sub("[.!?]", "", t)) for r, t in pairs]
    df = spark.createDataFrame(pairs, "role string, text string")
    known = {(r, t): m for r, t, m in df.selectExpr("role", "text", "xxhash64(role, text)").collect()}
    return lambda role, text: known[role, text]


def wild(n, seed):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "Why", "so it is", "", " \t", None, "Well?", "é. \n", "a?b"]
    for conv in [*range(n), None, -3]:
        for _ in range(rng.randint(1, 9)):
            turn = rng.choice([None, rng.randint(-2, 9), rng.randint(0, 9)])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "sir"])
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.7 else f"t{rng.random()}."))
    return rows + rows[:20]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("piece_rows", [conversation_repair.PIECE_ROWS, 1, 3])
def test_equals_all_edits(spark, piece_rows):
    rows = wild(250, 6)
    want = brute(rows, mixes(spark, rows))
    assert {letter for w in want.values() for letter in w[6]} == set("KRD")
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(audit_damaged(df, piece_rows)) == want


def test_whole_table_equals_all_edits(spark):
    df = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in df.collect()]
    assert rows_of(audit_damaged(df)) == brute(rows, mixes(spark, rows))


def test_a_hot_conversation_is_walked_in_pieces(spark):
    rng = random.Random(3)
    rows = [(7, i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"{i}!", f"{i}"]))
            for i in range(900)]
    rows += [(7, 5, "user", "The same.")] * 400 + [(8, 0, "user", "One."), (8, 1, "assistant", "Two.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows, mixes(spark, rows))
    for piece_rows in (conversation_repair.PIECE_ROWS, 37):
        assert rows_of(audit_damaged(df, piece_rows)) == want


def test_odd_tables(spark):
    extra = "place int, part int, conv int, copies int, edit int, kind int, id int, audit int"
    rows = [(1, 0, "user", "x" * 100_000 + ".", *range(8)), (None, None, None, None, *range(8))]
    df = spark.createDataFrame(rows, f"{SCHEMA}, {extra}")
    plain = [r[:4] for r in rows]
    assert rows_of(audit_damaged(df)) == brute(plain, mixes(spark, plain))
    assert audit_damaged(df.limit(0)).count() == 0


def test_repaired_rows(spark):
    rows = [(1, t, r, x, 1) for t, r, x in [(0, "system", "S."), (1, "user", "Hi."), (2, "user", "And?"),
                                           (3, "assistant", "Yes."), (4, "assistant", "")]]
    done = conversation_repair.repair(spark.createDataFrame(rows, "conv long, turn long, role string, text string, copies long"))
    assert done.audits.select("cost", "audit").collect() == [(4, "KDKKD")]
    kept = done.rows.orderBy("place", "step").collect()
    assert "".join(r["edit"] for r in kept) == done.audits.first()["audit"]
    roles = "".join(r["role"][0] for r in kept if r["edit"] != "D")
    assert re.fullmatch("(s?(ua)+)?", roles)


def test_audits_compare_like_strings(monkeypatch):
    rng = random.Random(2)
    for prime in (conversation_repair.HASH_PRIME, 7):
        # Under a tiny prime nearly all hashes collide.
        monkeypatch.setattr(conversation_repair, "HASH_PRIME", prime)
        audits, strings = Audits(), {0: ""}
        for _ in range(400):
            parent = rng.choice(list(strings))
            letter = rng.choice("DK")
            strings[audits.extend(parent, letter)] = strings[parent] + letter
        assert all(audits.text(n) == s for n, s in strings.items())
        for _ in range(20_000):
            a, b = rng.choices(list(strings), k=2)
            assert audits.less(a, b) == (strings[a] < strings[b])


@pytest.mark.parametrize("piece_rows", [100, 2])
def test_cheap_inserts(monkeypatch, piece_rows):
    """At the contract's costs a row goes rather than that one is inserted; here it is cheaper."""
    monkeypatch.setattr(conversation_repair, "INSERT_COST", 1)
    rng = random.Random(4)
    for conv in range(150):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), f"{i}", rng.choice(["", "", "blank", "truncated"]))
                for i in range(rng.randint(1, 8))]
        cost, audit, lines = cheapest(rows, insert_cost=1)
        faults = {"blank": conversation_repair.BLANK, "truncated": conversation_repair.TRUNCATED}
        light = [(0, i, conv, i, r[:1], faults.get(f, conversation_repair.SOUND), 1, 1) for i, (r, _, f) in enumerate(rows)]
        names = "part place conv turn initial fault later copies".split()
        batch = pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in light])
        pieces = list(conversation_repair.walk_pieces(piece_rows)(iter([batch])))
        found = [r for b in conversation_repair.fold(iter(pieces)) for r in b.to_pylist()]
        assert (found[0]["cost"], found[0]["audit"]) == (cost, audit)
        names = "part place kind at conv start audit role text copies".split()
        merged = [(0, r["place"], 0, r["at"], conv, r["start"], r["audit"], None, None, 0) for r in found[1:]]
        merged += [(0, i, 1, 0, conv, None, None, r, t, 1) for i, (r, t, _) in enumerate(rows)]
        merged = [dict(zip(names, r, strict=True)) for r in sorted(merged, key=lambda r: r[1:4])]
        edited = conversation_repair.apply_edits(iter([pa.RecordBatch.from_pylist(merged)]))
        kept = [r for b in edited for r in b.to_pylist()]
        assert "".join(r["edit"] for r in kept) == audit
        assert tuple(f"{r['role']}:{r['text']}" for r in kept if r["edit"] != "D") == lines
