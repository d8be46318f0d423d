"""Conversation repair against every sequence of edits, and odd conversations."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from metaingest.llm import conversation_repair as cr
from metaingest.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        body = text.strip(SPACE)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_force(turns):
    """Cost, audit and lines of the cheapest edits, by trying all of them."""
    found = faults(turns)
    best = None

    def go(i, cost, audit, lines):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(turns):
            if re.fullmatch("(s?(ua)+)?", "".join(role[:1] or "-" for role, _ in lines)):
                if best is None or (cost, audit) < best[:2]:
                    best = (cost, audit, [f"{role}:{text}" for role, text in lines])
        else:
            _, role, text = turns[i]
            go(i + 1, cost + 3, audit + "D", lines)
            if found[i] not in ("blank", "duplicate"):
                extra = found[i] == "truncated"
                go(i + 1, cost + extra, audit + "K", [*lines, (role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + 2 + extra, audit + "R", [*lines, (new, text)])
        if audit[-3:] != "III":
            for new in ("user", "assistant"):
                go(i, cost + 2, audit + "I", [*lines, (new, "")])

    go(0, 0, "", [])
    return best


def expected(turns):
    turns = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in turns),
        key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()),
    )
    found = faults(turns)
    numbers = [t for t, _, _ in turns if t is not None]
    cost, audit, lines = brute_force(turns)
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        **{fault: found.count(fault) for fault in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def random_conversations(count, seed):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "user", "assistant", None, "", "u", "Üser"]
    texts = ["Yes.", "No!", "Why?", "half a", "", " \n", None, "Same.", "Tail. \t", "né.", "né"]
    return {
        conv: [(draw.choice([None, 0, 1, 2, 3, 9]), draw.choice(roles), draw.choice(texts)) for _ in range(draw.randint(1, 5))]
        for conv in range(count)
    }


def test_report_equals_brute_force(spark):
    conversations = random_conversations(300, 5)
    conversations[None] = [(1, "user", "Yes."), (None, "user", "half")]
    rows = [(conv, *turn) for conv, turns in conversations.items() for turn in turns]
    random.Random(1).shuffle(rows)
    found = {r.conv_id: r.asDict() for r in cr.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(found) == set(conversations)
    for conv, turns in conversations.items():
        assert found[conv] == {"conv_id": conv, **expected(turns)}, turns


def test_giant_conversation_is_spilled_and_carried_over_batches(spark, monkeypatch):
    size = 30_000
    turns = spark.range(size).select(
        F.lit(7).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("say "), "id", F.lit(".")).alias("text"),
    )
    row = cr.report(turns).first()
    assert (row.audit, row.cost, row.illegal, row.gaps) == ("K" * size, 0, 0, 0)
    monkeypatch.setattr(cr, "SPILL", 64)
    program, long = cr._Program(), cr._Conversation("7")
    for i in range(1001):
        long.add(program, i, "user" if i % 2 == 0 else "assistant", f"say {i}.", "truncated" if i == 500 else "")
    assert long.steps._blocks == 1001 // 64
    _, *_, cost, audit, digest = long.report(program)
    lines = [f"{'user' if i % 2 == 0 else 'assistant'}:say {i}." for i in range(1001)] + ["assistant:"]
    assert (cost, audit) == (3, "K" * 1001 + "I")
    assert digest == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_few_states_are_met():
    program, draw = cr._Program(), random.Random(3)
    kinds = [cr.Kind(i, False, t) for i in ("s", "u", "a", "") for t in (False, True)] + [cr.Kind("", True, False)]
    state = cr._START
    for _ in range(200_000):
        state = program.step(state, draw.choice(kinds)).state
    assert len(program.moves) < 2000


def test_repaired_turns_are_what_the_digest_says(spark):
    conversations = random_conversations(60, 8)
    turns = spark.createDataFrame([(c, *t) for c, ts in conversations.items() for t in ts], SCHEMA)
    digests = {r.conv_id: r.repaired_sha256 for r in cr.report(turns).collect()}
    lines = {conv: [] for conv in conversations}
    for row in cr.repaired(turns).orderBy("conv_id", "position").collect():
        assert row.position == len(lines[row.conv_id])
        lines[row.conv_id].append(f"{row.role}:{row.text}")
    for conv, said in lines.items():
        assert hashlib.sha256("\n".join(said).encode()).hexdigest() == digests[conv]


def test_odd_tables(spark):
    rows = [(1, 0, "user", "Long. " * 200_000, "x"), (1, 1, "assistant", "Yes.", "x"), (2, None, None, None, None), (None, None, None, None, None)]
    turns = spark.createDataFrame(rows, SCHEMA + ", key string").withColumn("audit", F.lit(1)).withColumn("place", F.lit(1))
    found = {r.conv_id: r for r in cr.report(turns).collect()}
    assert found[1].audit == "KK" and found[2].audit == "D" and found[None].audit == "D"
    assert (found[2].blank, found[2].gaps, found[2].cost) == (1, 0, 3)
    named = turns.withColumn("conv_id", F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    assert {r.conv_id for r in cr.report(named).collect()} == {"c1", "c2", None}
    assert cr.report(turns.limit(0)).count() == 0 and cr.repaired(turns.limit(0)).count() == 0
    assert cr.damaged(turns.limit(0)).count() == 0


def test_query_keeps_conversations_without_turns(spark, tmp_path):
    import zlib

    dropped = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Gone."), (None, None, None, None), (1000, 0, "user", None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()}
    assert set(found) == {dropped, None, 1000}
    gone = found[dropped]
    assert (gone.gaps, gone.cost, gone.audit, gone.repaired_sha256) == (0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("fault", range(5))
def test_damage(spark, fault):
    import zlib

    conv = next(c for c in range(10_000) if zlib.crc32(f"{c}:3".encode()) % 20 == fault)
    rows = [(r.turn, r.role, r.text) for r in cr.damaged(spark.createDataFrame([(conv, 3, "system", "A. B! C? d")], SCHEMA)).collect()]
    whole = (3, "system", "A. B! C? d")
    assert rows == [[], [(3, "system", "")], [(3, "system", "A B C d")], [whole, whole], [(3, "user", "A. B! C? d")]][fault]
