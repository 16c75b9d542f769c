"""Conversations repaired at least cost: blank, repeated and cut-off turns and
roles out of order.

Rows are dealt by ranges of (conversation, turn) and sorted in each range, so
a conversation streams by in turn order and one that holds a third of all
rows still spreads over many tasks.  ``mapInPandas`` carries a conversation
across Arrow batches.  One that lies whole inside a range is repaired on the
spot: costs to go are worked out from its last row to its first, with one
byte of choices a row, and a walk from the first row takes the least letter
among the cheapest.  What may go on in another range, or grows beyond a
portion, leaves the stream as portions: one byte a row (all that the
repair depends on) beside the rows themselves, in the shared folder.

Portions are put together by joins of small rows: each gives the cost from
every state to every state; costs to go are carried from a conversation's
last portion to its first; every portion then makes its choices, and the
states in which portions begin are carried from the first to the last.

A digest of a split conversation's repaired text has to be taken in order.
Its portions are repaired apart; the digest streams over the repaired blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import stored

# Fixed values of the contract: costs and letters of the edits.
RELABEL, DELETE, INSERT, CUT = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
# Rows and characters of a portion.
PORTION_ROWS = 50_000
PORTION_CHARS = 4_000_000

# States of s?(ua)+ : nothing yet, after s, after u, after a.  A new user or
# assistant turn leads from each state to one other.
NEXT = (2, 2, 3, 2)
KEEP = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
NEVER = 1 << 60
# A row's code: its initial (x: none of s, u, a), a capital where it is cut off, d where it has to go.
CODES = "dsuaxSUAX"
D, I, K, R = 0, 1, 2, 3
LETTERS = "DIKR"


def close(cost: list[int]) -> tuple[int, int, int, int]:
    """Costs to go when turns may also be inserted first."""
    c0, c1, c2, c3 = cost
    c2, c3 = min(c2, c3 + INSERT), min(c3, c2 + INSERT)
    return min(c0, c2 + INSERT), min(c1, c2 + INSERT), c2, c3


# Costs to go behind the last row: only "nothing" and "after a" may end.
END = close([0, NEVER, NEVER, 0])


def _step(code: str) -> Callable:
    """(costs to go, choices) before a row, from the costs to go behind it."""
    if code == "d":
        moves = [((DELETE, s, D),) for s in range(4)]
    else:
        keep = KEEP.get(code.lower(), (-1,) * 4)
        cut = CUT if code.isupper() else 0
        moves = [((DELETE, s, D), *([(cut, keep[s], K)] if keep[s] >= 0 else []), (RELABEL + cut, NEXT[s], R))
                 for s in range(4)]

    def step(after):
        own = [min(c + after[t] for c, t, _ in m) for m in moves]
        cost = close(own)
        choice = 0
        for s in range(4):
            # letters in ASCII order: D, I, K, R
            for c, t, letter in sorted(moves[s] + ((INSERT, -1, I),), key=lambda m: m[2]):
                if (c + cost[NEXT[s]] if letter == I else c + after[t]) == cost[s]:
                    choice |= letter << (2 * s)
                    break
        return cost, choice
    return step


STEPS = {c: _step(c) for c in CODES}


def backward(codes: str, end) -> tuple[tuple, bytearray]:
    """Costs to go before the first row, and a byte of choices for each row."""
    choices = bytearray(len(codes))
    cost = tuple(end)
    for k in range(len(codes) - 1, -1, -1):
        cost, choices[k] = STEPS[codes[k]](cost)
    return cost, choices


def transfer(codes: str) -> list[int]:
    """Cost from every state to every state, row by row: 16 numbers."""
    columns = [backward(codes, [0 if s == t else NEVER for s in range(4)])[0] for t in range(4)]
    return [min(columns[t][s], NEVER) for s in range(4) for t in range(4)]


def walk(codes: str, choices: bytearray, state: int) -> tuple[str, int]:
    """Letters from ``state`` on, and the state behind the last row."""
    out = []
    for k, code in enumerate(codes):
        while True:
            letter = choices[k] >> (2 * state) & 3
            out.append(LETTERS[letter])
            if letter == I or letter == R:
                state = NEXT[state]
            elif letter == K:
                state = KEEP[code.lower()][state]
            if letter != I:
                break
    return "".join(out), state


def ending(state: int) -> tuple[str, int]:
    """Turns inserted behind the last row."""
    out = ""
    while state not in (0, 3):
        out, state = out + "I", NEXT[state]
    return out, state


def repaired(letters: str, rows: list[tuple[str, str]], state: int) -> list[tuple[str, str]]:
    """Role and text of the turns that ``letters`` make of ``rows``."""
    out, at = [], 0
    for letter in letters:
        if letter == "D":
            at += 1
            continue
        made = NEXT[state]
        new = USER if made == 2 else ASSISTANT
        if letter == "I":
            out.append((new, ""))
        else:
            role, text = rows[at]
            if letter == "K":
                made = KEEP[role[:1]][state]
            out.append((role if letter == "K" else new, text))
            at += 1
        state = made
    return out


class Counts:
    """Figures of consecutive rows that can be joined end to end."""

    FIELDS = ("n", "blank", "duplicate", "truncated", "illegal", "turns", "least", "most")

    def __init__(self):
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.first = self.last = None

    def add(self, initial, n, turn, blank, seen, cut) -> None:
        if self.n:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.illegal += n - 1  # rows that are equal
        self.last = initial
        self.n += n
        if blank:
            self.blank += n
        else:
            self.duplicate += n - 1 + seen
            self.truncated += cut and not seen
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn

    def join(self, other: Counts) -> None:
        """``other`` are the rows that follow."""
        if not other.n:
            return
        if self.n:
            self.illegal += self.last + other.first not in ("su", "ua", "au")
        else:
            self.first = other.first
        self.last = other.last
        for name in ("n", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.turns:
            self.turns += other.turns - (self.most == other.least)
            self.least = other.least if self.least is None else self.least
            self.most = other.most

    @property
    def gaps(self) -> int:
        return self.most - self.least + 1 - self.turns if self.turns else 0

    def dump(self) -> str:
        return repr((*(getattr(self, f) for f in self.FIELDS), self.first, self.last))

    @classmethod
    def load(cls, text: str) -> Counts:
        import ast
        c = cls()
        *values, c.first, c.last = ast.literal_eval(text)
        for name, value in zip(cls.FIELDS, values):
            setattr(c, name, value)
        return c


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PORTION = ("range_no long, portion long, counts string, codes string, rows array<struct<role:string,text:string>>")
STREAM = f"conv string, {RESULT}, {PORTION}"


def names_of(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


class Conversation:
    """Rows of one conversation as they stream by."""

    def __init__(self, key, spilled: bool, most_rows: int):
        self.key, self.spilled, self.most_rows, self.portion = key, spilled, most_rows, 0
        self.clear()

    def clear(self) -> None:
        self.counts, self.codes, self.rows, self.chars = Counts(), [], [], 0

    def take(self, role, text, n, turn, blank, seen, cut) -> int:
        """Adds up to n equal rows, as many as the portion holds; returns how many."""
        took = min(n, self.most_rows - len(self.codes))
        initial = role[:1]
        self.counts.add(initial, took, turn, blank, seen, cut)
        low = initial if initial in ("s", "u", "a") else "x"
        gone = blank or seen
        self.codes.append("d" if gone else low.upper() if cut else low)
        self.rows.append((role, "" if gone else text))
        self.codes += "d" * (took - 1)
        self.rows += [(role, "")] * (took - 1)
        self.chars += 0 if gone else len(text)
        return took

    def full(self) -> bool:
        return len(self.codes) >= self.most_rows or self.chars >= PORTION_CHARS

    def result(self) -> tuple:
        c = self.counts
        codes = "".join(self.codes)
        cost, choices = backward(codes, END)
        letters, state = walk(codes, choices, 0)
        letters += ending(state)[0]
        text = "\n".join(f"{r}:{t}" for r, t in repaired(letters, self.rows, 0))
        digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        return (self.key, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, cost[0], letters, digest,
                None, None, None, None, None)

    def portion_row(self, range_no: int) -> tuple:
        row = (self.key, *[None] * 8, range_no, self.portion, self.counts.dump(), "".join(self.codes),
               [{"role": r, "text": t} for r, t in self.rows])
        self.portion += 1
        self.spilled = True
        self.clear()
        return row


def frame_of(rows: list[tuple], schema: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names_of(schema), dtype=object)
    return out


def stream(batches: Iterator[pd.DataFrame], most_rows: int) -> Iterator[pd.DataFrame]:
    """Sorted rows of one range: results of whole conversations, portions of others."""
    range_no = TaskContext.get().partitionId()
    now, first_seen = None, False
    for batch in batches:
        out = []
        for conv, kind, role, text, n, has_turn, turn, blank, cut in batch.itertuples(index=False, name=None):
            if now is None or conv != now.key:
                if now is not None:
                    out.append(now.portion_row(range_no) if now.spilled else now.result())
                # the first one may have begun in the range before
                now = Conversation(conv, now is None, most_rows)
                first_seen = False
            if kind < 2:
                first_seen = kind == 1
                continue
            left, seen = int(n), not first_seen
            first_seen = False
            while left:
                left -= now.take(role, text, left, int(turn) if has_turn else None, blank, seen, cut)
                seen = seen or bool(left)
                if now.full():
                    out.append(now.portion_row(range_no))
        if out:
            yield frame_of(out, STREAM)
    if now is not None:  # the last one may go on in the next range
        yield frame_of([now.portion_row(range_no)], STREAM)


def carried(df: DataFrame, order: list[Column], schema: str, step: Callable) -> DataFrame:
    """Small rows of each conversation in order through ``step(state, row) ->
    (state, output row)``; ``state`` is None before a conversation's first."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, began = None, None, False
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if not began or row.conv != key:
                    key, state, began = row.conv, None, True
                state, made = step(state, row)
                out.append(made)
            if out:
                yield frame_of(out, schema)
    return df.repartition("conv").sortWithinPartitions(F.col("conv"), *order).mapInPandas(rows, schema)


def put_together(portions: DataFrame) -> DataFrame:
    """Results of the conversations that lie in several portions."""
    place = ["conv", "range_no", "portion"]

    def costs(batches):
        for b in batches:
            yield pd.DataFrame({"conv": b["conv"], "range_no": b["range_no"], "portion": b["portion"],
                                "costs": [transfer(c) for c in b["codes"]]})
    light = portions.select(*place, "codes").mapInPandas(
        costs, "conv string, range_no long, portion long, costs array<long>")

    def back(after, row):
        end = END if after is None else after
        m = row.costs
        m = [int(c) for c in m]
        before = [min(min(m[4 * s + t] + end[t] for t in range(4)), NEVER) for s in range(4)]
        return before, (row.conv, row.range_no, row.portion, list(end), after is None)
    later = stored(carried(light, [F.desc("range_no"), F.desc("portion")],
                           "conv string, range_no long, portion long, ends array<long>, final boolean", back), "repair-costs")

    def choose(batches):
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                cost, choices = backward(row.codes, [int(c) for c in row.ends])
                walks = [walk(row.codes, choices, s) if cost[s] < NEVER else ("", s) for s in range(4)]
                if row.final:
                    walks = [(w + ending(t)[0], ending(t)[1]) for w, t in walks]
                out.append((row.conv, row.range_no, row.portion, row.counts, [w for w, _ in walks],
                            [t for _, t in walks], [min(c, NEVER) for c in cost]))
            yield frame_of(out, chosen_schema)
    chosen_schema = ("conv string, range_no long, portion long, counts string, letters array<string>, states array<int>, "
                     "costs array<long>")
    p, q = portions.alias("p"), later.alias("q")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}")) for c in place]
    chosen = stored(p.join(q, same[0] & same[1] & same[2])
                    .select(*[f"p.{c}" for c in place], "p.counts", "p.codes", "q.ends", "q.final")
                    .mapInPandas(choose, chosen_schema), "repair-choices")

    def forward(state, row):
        state = 0 if state is None else state
        return row.states[state], (row.conv, row.range_no, row.portion, state)
    entered = stored(carried(chosen.select(*place, "states"), [F.asc("range_no"), F.asc("portion")],
                             "conv string, range_no long, portion long, state int", forward), "repair-states")

    def write(batches):
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                rows = [(r["role"], r["text"]) for r in row.rows]
                made = repaired(row.letters, rows, int(row.state))
                text = "\n".join(f"{r}:{t}" for r, t in made) if made else None
                out.append((row.conv, row.range_no, row.portion, row.counts, row.cost, row.letters,
                            None if text is None else text.encode("utf-8", "surrogatepass")))
            yield frame_of(out, block_schema)
    block_schema = ("conv string, range_no long, portion long, counts string, cost long, letters string, block binary")

    def matched(left, right):
        return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in place]
    a = matched("p", "c")
    b = matched("p", "e")
    blocks = (portions.alias("p").join(chosen.alias("c"), a[0] & a[1] & a[2]).join(entered.alias("e"), b[0] & b[1] & b[2])
              .select(*[f"p.{c}" for c in place], "p.counts", "p.rows", "e.state",
                      F.col("c.letters")[F.col("e.state")].alias("letters"), F.col("c.costs")[F.col("e.state")].alias("cost"))
              .mapInPandas(write, block_schema))
    blocks = stored(blocks, "repair-blocks")

    def digest(batches):
        now = None
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                if now is None or row.conv != now[0]:
                    if now is not None:
                        out.append(done(now))
                    now = [row.conv, Counts(), row.cost, [], hashlib.sha256(), False]
                now[1].join(Counts.load(row.counts))
                now[3].append(row.letters)
                if row.block is not None:
                    now[4].update(b"\n" * now[5] + bytes(row.block))
                    now[5] = True
            if out:
                yield frame_of(out, f"conv string, {RESULT}")
        if now is not None:
            yield frame_of([done(now)], f"conv string, {RESULT}")

    def done(now):
        conv, c, cost, letters, sha, _ = now
        return conv, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, cost, "".join(letters), sha.hexdigest()
    return (blocks.repartition("conv").sortWithinPartitions("conv", "range_no", "portion")
            .mapInPandas(digest, f"conv string, {RESULT}"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, n) damaged by the hash of their place;
    ``n`` is the number of times a row stands there."""
    code = F.crc32(F.concat(F.coalesce("conv", F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
                   .cast("binary")) % 20
    text = (F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    return (rows.withColumn("_code", code).where("_code <> 0")
            .select("conv", "turn", F.when(F.col("_code") == 4, USER).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.when(F.col("_code") == 3, 2).otherwise(1).alias("n")))


def repair_turns(conversations: DataFrame, damage: bool = False, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", portion_rows: int = PORTION_ROWS) -> DataFrame:
    """One row per conversation id (null is an id): ``gaps``, faulty rows by
    first fault, ``illegal`` neighbours, least ``cost``, the edits' initials
    ``audit`` (ASCII-least among the cheapest) and ``repaired_sha256`` of the
    repaired ``role:text`` lines.

    Rows follow their turn, null first; rows of one turn follow role and MD5
    of the text, so repeated rows are neighbours.  Null roles and texts count as one
    space.  Other columns are not read; an empty table gives no row.
    ``damage`` first damages rows by the hash of ``conv:turn``; a conversation
    that loses all its rows has zeros, an empty audit and the digest of no text.
    ``portion_rows`` bounds what a task holds of one conversation; the result
    does not depend on it.
    """
    raw = conversations.select(F.col(conv_col).cast("string").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                               F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                               F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), F.lit(1).alias("n"))
    # equal rows become one with a number before anything is sorted
    rows = (damaged(raw) if damage else raw).groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    rows = stored(rows.withColumn("h", F.md5(F.col("text").cast("binary"))), "repair-rows")
    tail = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    blank = F.length(tail) == 0
    cut = ~F.substring(tail, -1, 1).isin(".", "!", "?")
    nothing = F.lit(None).cast("string")
    # a mark stands before the first row of each role and text, and one for each conversation before all its rows
    first = (rows.groupBy("conv", "role", "h").agg(F.max(F.col("turn").isNull()).alias("none"), F.min("turn").alias("turn"))
             .select("conv", F.when(~F.col("none"), F.col("turn")).alias("turn"), "role", "h", F.lit(1).alias("kind"),
                     nothing.alias("text"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("blank"), F.lit(False).alias("cut")))
    every = (raw.select("conv").distinct()
             .select("conv", F.lit(None).cast("long").alias("turn"), nothing.alias("role"), nothing.alias("h"),
                     F.lit(0).alias("kind"), nothing.alias("text"), F.lit(0).cast("long").alias("n"),
                     F.lit(False).alias("blank"), F.lit(False).alias("cut")))
    real = rows.select("conv", "turn", "role", "h", F.lit(2).alias("kind"), "text", "n", blank.alias("blank"), cut.alias("cut"))
    both = real.unionByName(first).unionByName(every)
    spread = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (both.repartitionByRange(spread, "conv", "turn", "role", "h")
              .sortWithinPartitions("conv", "turn", "role", "h", "kind")
              .select("conv", "kind", "role", "text", "n", F.col("turn").isNotNull().alias("has_turn"),
                      F.coalesce("turn", F.lit(0)).alias("turn"), "blank", "cut"))
    streamed = stored(ranged.mapInPandas(lambda batches: stream(batches, portion_rows), STREAM), "repair-stream")
    names = names_of(RESULT)
    whole = streamed.where("portion is null").select("conv", *names)
    portions = streamed.where("portion is not null").select("conv", *names_of(PORTION))
    out = whole.unionByName(put_together(portions))
    return out.select(F.col("conv").cast(conversations.schema[conv_col].dataType).alias(conv_col), *names)
