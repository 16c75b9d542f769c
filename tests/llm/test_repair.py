"""Turn repair against exhaustive search."""

import random

import pytest

from tickflow.llm import queries as Q
from tickflow.llm import turn_repair

from tests.llm import brute

SCHEMA = "conv_id string, turn long, role string, text string, kind int, n int"
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def talk(seed, conversations=60, longest=9):
    rnd = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rnd.randrange(longest + 1)):
            if rnd.random() < .1:
                continue
            role = rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""])
            text = rnd.choice(["Yes.", "No!", "cut off", "", None, " \t", f"w{rnd.random()}.", "done?", "x. ", "é…"])
            rows.append((f"c{c}", rnd.choice([t, t, t, None, t + 3]), role, text))
            if rnd.random() < .15:
                rows.append(rows[-1])
    return rows + [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, None, None, None)]


def held(df):
    return {r.conv_id: tuple(r[f] for f in FIELDS) for r in df.collect()}


@pytest.mark.parametrize("damage", [True, False])
@pytest.mark.parametrize("portion", [50_000, 2])
def test_against_exhaustive_search(spark, damage, portion):
    rows = talk(7 + damage)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    got = held(turn_repair.repair_turns(docs, damage=damage, portion_rows=portion))
    want = brute.repair(rows, damage)
    assert got.keys() == want.keys()
    assert {c: (got[c], want[c]) for c in want if got[c] != want[c]} == {}


def test_one_conversation_with_all_rows(spark):
    rnd = random.Random(3)
    rows = [("big", t, rnd.choice(["user", "assistant", "system", "tool"]), rnd.choice(["Yes.", f"t{t}.", f"t{t}", ""]))
            for t in range(600)]
    rows += [("big", 700, "user", "again.")] * 50 + [("small", 0, "user", "hello.")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    got = held(turn_repair.repair_turns(docs, portion_rows=90))
    import sys
    old = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)
    try:
        want = brute.repair(rows, damage=False)
    finally:
        sys.setrecursionlimit(old)
    assert got == want


def test_empty_table(spark):
    assert turn_repair.repair_turns(spark.createDataFrame([], SCHEMA), damage=True).count() == 0


def test_query_returns_every_conversation(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert held(Q.op11_turn_repair(spark, sf)) == brute.repair(rows)
