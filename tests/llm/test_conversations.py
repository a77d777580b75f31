"""Conversation repair against a plain search over edits, in one segment and in many."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from glyphmill.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def plain_repair(rows: list[tuple[str, str]], fault: list[str | None]) -> tuple[int, str, list[str]]:
    """Every state after every row with its cheapest, then ASCII-least, audit."""

    def inserted(best: dict) -> dict:
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                role = "assistant" if state == "u" else "user"
                offer(best, role[0], (cost + 2, audit + "I", out + [f"{role}:"]))
        return best

    def offer(best: dict, state: str, way: tuple) -> None:
        if state not in best or way[:2] < best[state][:2]:
            best[state] = way

    best = inserted({"": (0, "", [])})
    for (role, text), wrong in zip(rows, fault, strict=True):
        after: dict = {}
        for state, (cost, audit, out) in best.items():
            offer(after, state, (cost + 3, audit + "D", out))
            if wrong in ("blank", "duplicate"):
                continue
            cost += wrong == "truncated"
            wanted = "assistant" if state == "u" else "user"
            if role[:1] == wanted[0] or (state == "" and role[:1] == "s"):
                offer(after, role[0], (cost, audit + "K", out + [f"{role}:{text}"]))
            offer(after, wanted[0], (cost + 2, audit + "R", out + [f"{wanted}:{text}"]))
        best = inserted(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda way: way[:2])


def plain_conversation(rows: list[tuple]) -> tuple:
    """What the query returns for the damaged rows ``turn, role, text`` of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        visible = text.rstrip(WHITE)
        faults.append(
            "blank" if not visible else "duplicate" if (role, text) in seen
            else "truncated" if visible[-1] not in ".!?" else None
        )
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, out = plain_repair([r[1:] for r in rows], faults)
    digest = sha256("\n".join(out).encode()).hexdigest()
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, digest)


def plain_damage(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def grouped(rows: list[tuple]) -> dict:
    found: dict = {}
    for conv, *rest in rows:
        found.setdefault(conv, []).append(tuple(rest))
    return found


def random_rows(rng: random.Random, conversation: int | None, n: int) -> list[tuple]:
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "well", " ", "", "Why?\n", "a.b", None, "Good.", "x" * 70 + "1.", "x" * 70 + "2."]
    return [
        (conversation, rng.choice([None, *range(n)]) if rng.random() < 0.2 else turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {turn} {rng.random()}.")
        for turn in range(n)
    ]


@pytest.mark.parametrize("bits", [12, 2])
def test_repair_equals_a_plain_search(spark, bits):
    rng = random.Random(bits)
    rows = [r for c in [None, *range(40)] for r in random_rows(rng, c, rng.choice([1, 2, 3, 8, 30]))]
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    # Rows of one turn with a common head are ordered by digest: leave those out here.
    rows = [r for r in rows if len(r[3]) < 64 or r[1] is not None and r[3].endswith("1.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    edits, summary = conversations.repair(df, "conv_id", "turn", "role", "text", bits)
    found: dict = {}
    for e in edits.orderBy("pos", "nth").collect():
        found.setdefault(e.id, ([], []))[0].append(e.edit)
        if e.role is not None:
            found[e.id][1].append(f"{e.role}:{e.text}")
    got = {}
    for s in summary.collect():
        letters, out = found[s.id]
        digest = sha256("\n".join(out).encode()).hexdigest()
        got[s.id] = (s.gaps, s.blank, s.duplicate, s.truncated, s.illegal, s.cost, "".join(letters), digest)
    assert got == {conv: plain_conversation(own) for conv, own in grouped(rows).items()}


def test_query_equals_plain_damage_and_repair(spark, tmp_path):
    rng = random.Random(7)
    rows = [r for c in [None, *range(150)] for r in random_rows(rng, c, rng.choice([1, 2, 5, 8]))]
    rows = [(c, t, r, x) for c, t, r, x in rows if x is None or len(x) < 64]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("clash"), "pos": F.lit("clash"), "a.b": F.lit("x")})
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in queries.conversation_repair(spark, str(tmp_path)).collect()}
    left = grouped(plain_damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    assert got == {c: plain_conversation(left[c]) if c in left else nothing for c in {r[0] for r in rows}}
    assert nothing in got.values()



def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert queries.conversation_repair(spark, str(tmp_path)).collect() == []


def test_a_long_text_and_one_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(3000)] + [(2, 0, "user", "word " * 200_000)]
    edits, summary = conversations.repair(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text", bits=8)
    assert {(s.id, s.cost, s.truncated) for s in summary.collect()} == {(1, 0, 0), (2, 3, 1)}
    assert edits.filter("id = 1 AND edit = 'K'").count() == 3000
    # Deleting the row costs as much as keeping it and answering.
    assert [e.edit for e in edits.filter("id = 2").orderBy("pos", "nth").collect()] == ["D"]
