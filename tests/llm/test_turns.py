"""Operator 12 against an exhaustive search over edits."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestloom.llm import turn_repair

GOOD = re.compile(r"(s?(ua)+)?")
TURNS = "conv_id bigint, turn bigint, role string, text string"


def cheapest(turns):
    """(cost, audit, lines) of the least edits of (role, text, fault) turns, by trying all, cheapest first."""
    heap, seen = [(0, "", 0, "", ())], set()
    limit = 2 * len(turns) + 4
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if (i, roles, audit) in seen:
            continue
        seen.add((i, roles, audit))
        if i == len(turns) and GOOD.fullmatch(roles):
            return cost, audit, list(lines)
        if len(roles) < limit:
            for r in ("user", "assistant"):
                heapq.heappush(heap, (cost + 3, audit + "I", i, roles + r[0], (*lines, f"{r}:")))
        if i < len(turns):
            role, text, fault = turns[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles, lines))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, roles + (role[:1] or "?"), (*lines, f"{role}:{text}")))
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, roles + r[0], (*lines, f"{r}:{text}")))


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        bare = text.rstrip(" \t\n\x0b\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def figures(turns):
    """Expected row for the (turn, role, text) turns of one conversation, in order."""
    known = faults([t[1:] for t in turns])
    cost, audit, lines = cheapest(known)
    numbers = [t[0] for t in turns if t[0] is not None]
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        *[sum(f == kind for _, _, f in known) for kind in ("blank", "duplicate", "truncated")],
        sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(known, known[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def damaged(turns):
    out = []
    for conv, turn, role, text in turns:
        blank = [" " if x is None else str(x) for x in (conv, turn)]
        fate, role, text = zlib.crc32(":".join(blank).encode()) % 20, " " if role is None else role, " " if text is None else text
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def test_unrolled_edits_are_the_cheapest_and_least():
    rng = random.Random(4)
    for _ in range(120):
        turns = []
        for _ in range(rng.randint(0, 6)):
            turns += [(rng.choice(["system", "user", "assistant", "tool"]), "x", rng.choice(["", "", "blank", "truncated"]))] * rng.choice([1, 1, 1, 2])
        symbols = [0 if f == "blank" else 1 + 2 * "suat".index(r[0]) + (f == "truncated") for r, _, f in turns[:6]]
        edits, state = turn_repair.unroll(*turn_repair.runs_of(np.array(symbols, np.int64)), turn_repair.AT_END, turn_repair.NONE)
        audit = "".join(e[0] for e in edits) + turn_repair.closing(state)[0]
        assert audit == cheapest(turns[:6])[1]


def test_long_runs_advance_by_powers():
    for sym in range(9):
        slow = turn_repair.AT_END
        for count in range(1, 70):
            slow = turn_repair.times(turn_repair.power(sym, 0), slow)
            assert (turn_repair.advance(sym, count, turn_repair.AT_END) == slow).all()


@pytest.mark.parametrize("bits", [12, 1])
def test_conversations_equal_exhaustive_search(spark, monkeypatch, bits):
    monkeypatch.setattr(turn_repair, "PIECE_BITS", bits)  # pieces of two turns: every conversation is cut
    rng = random.Random(8)
    said = ["Yes.", "No!", "Why", "", " \n\t", "Yes. ", "é?", None]
    rows = []
    for conv in range(30):
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, turn * rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"]), rng.choice(said) if rng.random() < 0.6 else f"t{turn}."))
        seen = set()
        rows = [r for r in rows if r[0] != conv or not (r[1] in seen or seen.add(r[1]))]
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (100, None, "user", "q."), (101, 1, "user", "x" * 1_200_000 + "."), (101, 2, "assistant", "a.")]
    df = spark.createDataFrame(rows, TURNS).withColumn("edits", F.lit(1)).withColumn("pos", F.lit("p"))
    got = {r["conv_id"]: tuple(r)[1:] for r in turn_repair.digests(turn_repair.repair(turn_repair.damage(df)), df).collect()}
    left = damaged(rows)
    for conv in {r[0] for r in rows}:
        assert got[conv] == figures(sorted([r[1:] for r in left if r[0] == conv], key=lambda r: (r[0] is not None, r[0] or 0))), conv
    assert len(got) == len({r[0] for r in rows})


def test_repaired_turns_and_equal_rows(spark):
    rows = [(1, 1, "system", "S."), (1, 2, "user", "A."), (1, 2, "user", "A."), (1, 3, "assistant", "B"), (2, 1, "assistant", "C.")]
    done = turn_repair.repair(spark.createDataFrame(rows, TURNS))
    assert sorted((r["conv_id"], r["fault"], r["edits"]) for r in done.collect()) == [(1, "", "K"), (1, "", "K"), (1, "duplicate", "D"), (1, "truncated", "K"), (2, "", "IK")]
    turns = turn_repair.repaired(done).orderBy("conv_id", "pos", "step").select("conv_id", "role", "text").collect()
    assert [tuple(r) for r in turns] == [(1, "system", "S."), (1, "user", "A."), (1, "assistant", "B"), (2, "user", ""), (2, "assistant", "C.")]


def test_one_conversation_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "PIECE_BITS", 3)
    rows = [(5, i, "user" if i % 3 else "assistant", f"t{i}." if i % 7 else "cut") for i in range(400)]
    spread = spark.createDataFrame(rows, TURNS)
    assert turn_repair.digests(turn_repair.repair(spread), spread).collect()[0]["cost"] > 0
    monkeypatch.setattr(turn_repair, "PIECE_BITS", 20)
    one = turn_repair.digests(turn_repair.repair(spread.coalesce(1)), spread).collect()
    monkeypatch.setattr(turn_repair, "PIECE_BITS", 3)
    assert turn_repair.digests(turn_repair.repair(spread), spread).collect() == one


def test_empty_table(spark):
    none = spark.createDataFrame([], TURNS)
    assert turn_repair.digests(turn_repair.repair(turn_repair.damage(none)), none).collect() == []
