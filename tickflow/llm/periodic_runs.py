"""Periodic runs of the words of a text: stretches that repeat one period at
least three times.

A run of period p and length max(24, 3p) or more holds, on the grid of step
max(24 - p, 2p) // 3, three neighbouring places whose words equal those p
further on.  Summed over all p the grids have about n log n places, tested
for all texts of a batch by flat numpy arrays.  Each candidate left is
extended both ways by exact queries on the run-length grammar of its text and
of the reversed text (``recompression``), built only for texts that have a
candidate.

Rows are independent: a narrow ``mapInPandas`` with no shuffle.  A batch of
rows is worked on in portions of bounded text, grids in portions of bounded
places.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import id_back, id_text
from tickflow.llm.recompression import Grammar

# Fixed values of the contract.
LEAST_LENGTH, LEAST_PERIODS = 24, 3
# Text worked on at once, and grid places tested at once.
PORTION_BYTES = 2_000_000
PORTION_PLACES = 1_000_000
# Candidates kept between the two passes over them; more are made again.
KEPT_PLACES = 4_000_000
# Every HARM_EVERY-th id hash gets a periodic tail in the registered query.
HARM_EVERY = 10


def planted_tail(n: int, doc_id: str | None) -> tuple[int, int] | None:
    """(first word, period) of the tail that the query plants in a text of
    ``n`` words; None where it plants none (also for a null id)."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(doc_id.encode())
    if h % HARM_EVERY:
        return None
    g = h // HARM_EVERY
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def flat_ranges(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... count - 1 for each count, one after another."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def candidates(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, place, period) of all grid places that may lie in a run,
    in portions; places are absolute, sorted within a text and period."""
    most = np.where(size >= LEAST_LENGTH, size // LEAST_PERIODS, 0)
    text = np.repeat(np.arange(len(size)), most)
    period = flat_ranges(most) + 1
    step = np.maximum(1, np.maximum(LEAST_LENGTH - period, (LEAST_PERIODS - 1) * period) // 3)
    # places i with i + period inside the text
    places = -(-(size[text] - period) // step)
    at = 0
    load = np.cumsum(places)
    while at < len(text):
        done = load[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(load, done + PORTION_PLACES, side="right")))
        p, t, s, c = period[at:to], text[at:to], step[at:to], places[at:to]
        number = flat_ranges(c)
        first = np.repeat(start[t], c) + number * np.repeat(s, c)
        equal = words[first] == words[first + np.repeat(p, c)]
        ok = np.flatnonzero(equal[:-2] & equal[1:-1] & equal[2:])
        # the three places belong to one text and period
        ok = ok[number[ok] + 2 < np.repeat(c, c)[ok]]
        if len(ok):
            pair = np.repeat(np.arange(at, to), c)[ok]
            yield text[pair], first[ok], period[pair]
        at = to


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each sequence of word numbers,
    by start and then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    size = np.array([len(t) for t in texts], dtype=np.int64)
    if not size.sum():
        return out
    start = np.cumsum(size) - size
    words = np.concatenate(texts)
    found, having, kept = [], set(), 0
    for portion in candidates(words, start, size):
        having.update(np.unique(portion[0]).tolist())
        kept += len(portion[0])
        if kept <= KEPT_PLACES:
            found.append(portion)
    if kept > KEPT_PLACES:
        found = candidates(words, start, size)  # too many to keep: made again, a portion at a time
    # one grammar over the texts that have candidates, and their reverses, each behind its end mark
    pieces, ends, fore, back, owner, used = [], [], {}, {}, {}, 0
    for t in sorted(having):
        owner[t] = np.full(len(texts[t]), -1, dtype=np.int32)
        for way, turned in ((fore, texts[t]), (back, texts[t][::-1])):
            way[t] = used
            pieces += [turned, np.zeros(1, dtype=np.int64)]
            used += len(turned) + 1
            ends.append(used - 1)
    if not pieces:
        return out
    grammar = Grammar(np.concatenate(pieces), np.array(ends))
    least: dict[tuple[int, int, int], int] = {}
    runs: list[tuple[int, int]] = []
    last, covered = None, -1
    for text, place, period in found:
        for t, i, p in zip(text.tolist(), (place - start[text]).tolist(), period.tolist()):
            if (t, p) != last:
                last, covered = (t, p), -1
            if i < covered:
                continue  # inside the stretch that the place before was extended to
            r = int(owner[t][i])
            if r >= 0 and p % runs[r][1] == 0 and i + p < runs[r][0]:
                covered = runs[r][0] - p  # a multiple of a known run's period has that run's extent
                continue
            n = int(size[t])
            f = grammar.lce(fore[t] + i, fore[t] + i + p)
            # places before i, read backwards: i - 1 is number n - i of the reversed text
            b = grammar.lce(back[t] + n - i - p, back[t] + n - i) if i else 0
            covered = i + f
            length = f + b + p
            if length >= max(LEAST_LENGTH, LEAST_PERIODS * p):
                key = (t, i - b, length)
                # multiples of a period have the same extent: the smallest stays
                least[key] = min(p, least.get(key, p))
                owner[t][i - b:i - b + length] = len(runs)
                runs.append((i - b + length, p))
    for (t, s, length), p in least.items():
        out[t].append((s, length, p))
    for of_text in out:
        of_text.sort(key=lambda r: (r[0], r[2]))
    return out


def portions(ids: list, texts: list) -> Iterator[tuple[list, list]]:
    """Slices of a batch of up to PORTION_BYTES of text (one row at least)."""
    a, held = 0, 0
    for k, t in enumerate(texts):
        size = len(t or b"")
        if k > a and held + size > PORTION_BYTES:
            yield ids[a:k], texts[a:k]
            a, held = k, 0
        held += size
    if a < len(texts):
        yield ids[a:], texts[a:]


def summary(words: list[bytes], runs: list[tuple[int, int, int]]) -> list:
    """Number of runs, the run of greatest exponent, digests, collapsed text."""
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None, None, None)
    if runs:
        stays = np.ones(len(words), dtype=bool)
        for s, n, p in runs:
            stays[s + p:s + n] = False
        words = list(itertools.compress(words, stays.tolist()))
    collapsed = b" ".join(words)
    whole = (None if v is None else str(v) for v in (*best, 1000 * best[1] // best[2] if runs else None))
    return [len(runs), *whole, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed).hexdigest(), lines, collapsed.decode("utf-8", "replace")]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False,
                  texts: bool = False) -> DataFrame:
    """One row per input row: id, ``n_runs``, the run of greatest
    length/period (``start``, ``length``, ``period``, ``exponent_milli``; ties:
    smallest start, then period; null without a run), ``runs_sha256`` over
    all runs and ``collapsed_sha256`` over the words that stay when every run
    keeps its first period.  With ``texts`` also ``runs`` (lines of
    start,length,period) and ``collapsed`` themselves.

    ``plant`` gives every text whose id hash is divisible by HARM_EVERY a
    periodic tail first (``planted_tail``).  A null or empty text has no words
    and no run; a null id stays null and gets no tail; repeated rows give
    repeated results; other columns are not read; an empty table gives none.
    """
    extra = ", runs string, collapsed string" if texts else ""
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
             "runs", "collapsed"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, part in portions(batch.iloc[:, 0].tolist(), batch.iloc[:, 1].tolist()):
                number = defaultdict(itertools.count().__next__)
                split, coded = [], []
                for doc, text in zip(ids, part):
                    words = bytes(text).split() if text else []  # white space of the contract, as it happens
                    tail = planted_tail(len(words), doc) if plant else None
                    if tail:
                        a, p = tail
                        words = words[:a] + [words[a + k % p] for k in range(len(words) - a)]
                    split.append(words)
                    coded.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
                out = [summary(w, r) for w, r in zip(split, find_runs(coded))]
                frame = pd.DataFrame(out, columns=names)
                frame.insert(0, "id", ids)
                yield frame if texts else frame.iloc[:, :8]

    coded = (docs.select(id_text(docs, id_col), docs[text_col].cast("string").cast("binary"))
             .mapInPandas(rows, "id string, n_runs long, start string, length string, period string, "
                                f"exponent_milli string, runs_sha256 string, collapsed_sha256 string{extra}"))
    numbers = ["start", "length", "period", "exponent_milli"]
    return id_back(coded.withColumns({c: F.col(c).cast("long") for c in numbers}), "id", docs, id_col)
