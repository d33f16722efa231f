"""Conversation repair against a best-first search and a plain reading of each rule."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from orderlens.llm import conversations

PATTERN = re.compile("(s?(ua)+)?")


def best_first(rows):
    """Least (cost, edits) over all edit sequences, by order of cost, then of the edits."""
    heap, seen = [(0, "", "", 0)], set()
    while heap:
        cost, edits, made, i = heapq.heappop(heap)
        state = made if made in ("", "s") else made[-1]     # what may follow hangs on this alone
        if (i, state) in seen:
            continue
        if i == len(rows) and PATTERN.fullmatch(made):
            return cost, edits
        seen.add((i, state))
        nexts = [c for c in "sua" if any(PATTERN.fullmatch(made + c + x) for x in ("", "a", "ua"))]
        for c in nexts:
            if c != "s":
                heapq.heappush(heap, (cost + 5, edits + "I", made + c, i))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 2, edits + "D", made, i + 1))
        initial, wrong = rows[i]
        if wrong != conversations.UNUSABLE:
            more = 5 if wrong else 0
            if initial in nexts:
                heapq.heappush(heap, (cost + more, edits + "K", made + initial, i + 1))
            for c in nexts:
                if c != "s":
                    heapq.heappush(heap, (cost + more + 1, edits + "R", made + c, i + 1))


def test_search():
    rng = random.Random(1)
    for _ in range(1500):
        rows = [(rng.choice("suaux "), rng.choice([0, 0, 0, 1, 2]))
                for _ in range(rng.randint(0, 10))]
        assert conversations.cheapest_edits(rows) == best_first(rows), rows


def test_long_conversations_are_joined_exactly():
    rng, segments = random.Random(2), conversations._Segments()
    for _ in range(60):
        rows = [(rng.choice("suauauax"), rng.choice([0, 0, 0, 1, 2]))
                for _ in range(rng.randint(33, 130))]
        c = conversations._Conversation(1, segments)
        for initial, wrong in rows:
            if len(c.rows) == conversations.SEGMENT:
                c.advance(False)
            c.rows.append((initial, "x"))
            c.kinds.append((initial, wrong))
        assert c.result()[6:8] == best_first(rows)


SPACE = " \t\n\x0b\x0c\r"


def expected(table):
    """Results by the rules, one conversation after another, without Spark."""
    damaged = {}
    for conv, turn, role, text in table:
        rows = damaged.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        rows += [(turn, role, text)] * (2 if hit == 3 else 1)
    out = {}
    for conv, rows in damaged.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, seen, kinds = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in rows:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else \
                "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            kinds.append((role[:1], 0 if fault is None else 1 if fault == "truncated" else 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        cost, audit = best_first(kinds)
        left, made = [], ""
        source = iter(rows)
        for edit in audit:
            wanted = "assistant" if made[-1:] == "u" else "user"
            if edit == "I":
                left.append((wanted, ""))
            else:
                _, role, text = next(source)
                if edit == "D":
                    continue
                left.append((role if edit == "K" else wanted, text))
            made += left[-1][0][:1]
        assert PATTERN.fullmatch(made)
        lines = "\n".join(f"{r}:{t}" for r, t in left)
        out[conv] = (gaps, *counts.values(), illegal, cost, audit,
                     hashlib.sha256(lines.encode()).hexdigest())
    return out


def hostile():
    rng = random.Random(5)
    table = []
    for conv in range(120):
        role = ["user", "assistant"]
        for turn in range(rng.randint(1, 9)):
            table.append((conv, turn * rng.choice([1, 1, 2]), role[turn % 2],
                          rng.choice(["Yes.", "Well then!", "No end", "é?", "same.", " \n", ""])))
    table += [(200, k, ["user", "assistant"][k % 2], f"Row {k}.") for k in range(300)]    # long
    table += [(201, k, "user", "over and over.") for k in range(200)]                      # one text
    table += [(None, k, "user", "lost.") for k in range(5)] + [(None, None, None, None)]
    table += [(202, None, "system", "a."), (202, None, "user", "b."), (202, 3, "", "c.")]
    table += [(203, 1, "user", "twice."), (203, 1, "user", "twice."), (203, 1, "assistant", "x.")]
    table += [(204, 0, "tool", "w" * 300_000 + "."), (205, 1, "sender", "Hi.\n")]
    table += [(300 + k, 0, "user", "gone?") for k in range(60)]     # some lose their only row
    return table


SCHEMA = "conv_id long, turn long, role string, text string, fault string, cost string, " \
         "conv string, hit string, digest string"


def test_repair(spark):
    table = hostile()
    frame = spark.createDataFrame([(*r, *["c"] * 5) for r in table], SCHEMA).repartition(5)
    rows = conversations.damage(conversations.conversation_rows(frame))
    got = conversations.repair_conversations(rows).collect()
    want = expected(table)
    assert len(got) == len(want)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want
    empty = [r for r in got if not r["audit"] and r["cost"] == 0]
    assert any(r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for r in empty)


def test_undamaged_and_empty(spark):
    table = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello!")]
    frame = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    row = conversations.repair_conversations(conversations.conversation_rows(frame)).collect()
    assert [tuple(r)[:8] for r in row] == [(1, 0, 0, 0, 0, 0, 0, "KKK")]
    none = conversations.damage(conversations.conversation_rows(frame.limit(0)))
    assert conversations.repair_conversations(none).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    from orderlens.llm import queries
    table = [tuple(r) for r in spark.read.parquet(
        f"/root/testdata/{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(spark, f"/root/testdata/{sf}").collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == expected(table)
