"""Line dedup and periodic runs against plain versions."""

import hashlib
import random

import numpy as np
import pytest

from tickflow.llm import line_dedup, periodic_runs
from tickflow.llm import queries as Q
from tickflow.llm.perfect_hash import PerfectHash
from tickflow.llm.recompression import Grammar

from tests.llm import brute

SF = "/root/testdata/sf0.001"
# extra columns with the names that the operators use themselves
EXTRA = "id string, shard int, n_runs string, doc_id long, text string"


def frame(spark, rows):
    return spark.createDataFrame([("x", 1, "y", *r) for r in rows], EXTRA)


def texts_with_shared_lines():
    rnd = random.Random(5)
    common = ["Subscribe to our newsletter", "  SUBSCRIBE to our Newsletter\t", "short", "ééééééééé", "éééééééééé",
              "a line of some length\r", "", " \x0b", "All rights reserved."]
    rows = [(None, None), (None, "Only without an id, twice"), (None, "Only without an id, twice"), (3, None), (4, ""),
            (4, ""), (9, "repeated in one\nrepeated in one\nrepeated in one"), (9, "repeated in one"),
            (50, "x" * 300_000 + "\n" + "All rights reserved."), (51, ("y " * 200 + "\n") * 500)]
    for i in range(120):
        lines = [rnd.choice(common) if rnd.random() < .5 else f"line {rnd.randrange(150)} of its own" for _ in range(rnd.randrange(12))]
        rows.append((rnd.choice([i, i, 200 - i, None]), "\n".join(lines)))
    return rows + rows[20:30]


@pytest.mark.parametrize("shard_bytes", [16_000_000, 5_000])
def test_line_dedup(spark, shard_bytes):
    rows = texts_with_shared_lines()
    got = line_dedup.dedup_lines(frame(spark, rows).repartition(5), shard_bytes=shard_bytes).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(
        map(repr, ((d, n, k, t) for d, n, k, t in brute.kept_lines(rows))))


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_line_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute.kept_lines(rows)}
    assert {tuple(r) for r in Q.op12_line_dedup(spark, SF).collect()} == want


def test_index_leaves_other_lines_alone(spark):
    docs = spark.createDataFrame([(str(i), f"line number {i % 7} here".encode()) for i in range(40)], "id string, text binary")
    index = line_dedup.build_index(line_dedup.packets(docs, 3))
    other = spark.createDataFrame([("1", b"line number 3 here\nnever seen before\nline number 9 here")], "id string, text binary")
    packed = line_dedup.packets(other, 3).cache()  # names differ between runs of the plan
    got = line_dedup.drop_lines(packed, line_dedup.probe(packed, index)).collect()
    assert [(r.n_lines, r.n_dropped, bytes(r.text)) for r in got] == [(3, 1, b"never seen before\nline number 9 here")]
    packed.unpersist()


def test_perfect_hash():
    rnd = np.random.default_rng(2)
    for n in (0, 1, 2, 5_000):
        a, b = rnd.integers(0, 50, n).astype(np.uint64), np.arange(n, dtype=np.uint64)
        perfect = PerfectHash.unpacked(*PerfectHash.build(a, b).packed())
        assert sorted(perfect.numbers(a, b).tolist()) == list(range(n))


def test_extension_queries():
    rnd = random.Random(4)
    for _ in range(60):
        texts = [[rnd.randrange(rnd.choice([1, 2, 5])) for _ in range(rnd.randrange(1, 90))] for _ in range(3)]
        flat, ends = [], []
        for t in texts:
            flat += t + [0]
            ends.append(len(flat) - 1)
        grammar = Grammar(np.array(flat), np.array(ends))
        marked = list(flat)
        for k, e in enumerate(ends):
            marked[e] = -1 - k
        for _ in range(60):
            a, b = sorted(rnd.sample(range(len(flat)), 2))
            n = 0
            while b + n < len(flat) and marked[a + n] == marked[b + n]:
                n += 1
            assert grammar.lce(a, b) == n


def runs_rows():
    rnd = random.Random(6)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b " * 40), (4, "one " * 23), (5, "one " * 24), (5, "one " * 24),
            (6, "w" * 100_000), (7, "\x0b".join(["x", "y", "z"] * 9)), (8, "no run in these words at all"),
            (9, " ".join(["a"] * 30 + ["b"] * 30 + ["a", "b"] * 20)), (10, "ab " * 2_000)]
    for i in range(60):
        n, size = rnd.choice([30, 80, 300]), rnd.choice([1, 2, 4, 1000])
        w = [f"v{rnd.randrange(size)}" for _ in range(n)]
        s = rnd.randrange(n)
        p = 1 + (n - s) // rnd.choice([2, 3, 4, 7])
        rows.append((100 + i, " ".join(w[:s] + [w[s + k % p] for k in range(n - s)])))
    return rows


def plain_runs(doc, text, plant):
    words = brute.re.findall("[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    tail = periodic_runs.planted_tail(n, None if doc is None else str(doc)) if plant else None
    if tail:
        a, p = tail
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute.periodic_runs(words)
    lines = "".join(f"{s},{k},{p}\n" for s, k, p in runs)
    gone = {i for s, k, p in runs for i in range(s + p, s + k)}
    collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = (None,) * 4
    for s, k, p in sorted(runs, key=lambda r: (r[0], r[2])):
        if best[0] is None or k * best[2] > best[1] * p:
            best = (s, k, p, 1000 * k // p)
    return (doc, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest())


def test_periodic_runs(spark):
    rows = runs_rows()
    for plant in (False, True):
        got = periodic_runs.periodic_runs(frame(spark, rows).repartition(3), plant=plant).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(repr(plain_runs(d, t, plant)) for d, t in rows)
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0


def test_run_outputs(spark):
    got = periodic_runs.periodic_runs(frame(spark, [(1, "begin " + "a b c " * 9 + "end")]), texts=True).first()
    assert (got.n_runs, got.start, got.length, got.period, got.exponent_milli) == (1, 1, 27, 3, 9000)
    assert (got.runs, got.collapsed) == ("1,27,3\n", "begin a b c end")


def test_runs_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    short = {d for d, t in rows if len(t or "") < 20_000}
    got = {r.doc_id: tuple(r) for r in Q.op13_periodic_runs(spark, SF).collect()}
    assert len(got) == len(rows) and sum(r[1] > 0 for r in got.values()) > 5
    assert {d: got[d] for d in short} == {d: plain_runs(d, t, True) for d, t in rows if d in short}
