"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut at the special strings (one token each) and by the vocabulary's
word pattern.  Every word starts as its UTF-8 bytes, held as a doubly linked
list; a heap of adjacent pairs, ordered by (rank, position), gives the next
merge.  The count of a word is its number of bytes minus its merges, so no
identifiers are made.  Words repeat, so each Python worker keeps a bounded
memo of word counts.

Rows are independent: the work is a narrow ``mapInPandas`` with no shuffle.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame

from tickflow.llm.common import id_back, id_text

# Fixed value: the word pattern of byte-level BPE vocabularies of this kind,
# its white space spelt out (the Unicode White_Space characters).
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD_PATTERN = ("'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+"
                f"| ?[^{_SPACE}\\p{{L}}\\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")

# Words kept in a worker's memo, and the longest word that is kept.
MEMO_WORDS = 300_000
MEMO_CHARS = 48


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 bytes stand for themselves, the others take the code
    points from 256 on, in byte order."""
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class HeapCounter:
    """Counts the tokens of one text; holds the merges and the word memo."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        number = {s: b for b, s in enumerate(byte_symbols())}
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = number.setdefault(left + right, len(number))
            merges.setdefault((number[left], number[right]), (rank, made))
        self.merges = merges
        special = [t["content"] for t in spec.get("added_tokens", [])]
        special.sort(key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.find = regex.compile(WORD_PATTERN).findall
        self.memo: dict[str, int] = {}

    def word(self, data: bytes) -> int:
        """Number of tokens of one word: its bytes minus the merges made."""
        merges = self.merges
        ids = list(data)
        n = len(ids)
        if n < 2:
            return n
        heap = []
        for i in range(n - 1):
            hit = merges.get((ids[i], ids[i + 1]))
            if hit:
                heap.append((hit[0], i, ids[i], ids[i + 1], hit[1]))
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        left_over = n
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two symbols has been merged since
            ids[i], ids[j] = made, -1
            left_over -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                hit = merges.get((made, ids[k]))
                if hit:
                    heapq.heappush(heap, (hit[0], i, made, ids[k], hit[1]))
            h = before[i]
            if h >= 0:
                hit = merges.get((ids[h], made))
                if hit:
                    heapq.heappush(heap, (hit[0], h, ids[h], made, hit[1]))
        return left_over

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        total = len(parts) - 1
        memo = self.memo
        for part in parts:
            for word, times in Counter(self.find(part)).items():
                n = memo.get(word)
                if n is None:
                    n = self.word(word.encode("utf-8"))
                    if len(word) <= MEMO_CHARS:
                        if len(memo) >= MEMO_WORDS:
                            memo.clear()
                        memo[word] = n
                total += n * times
        return total


_counters: dict[str, HeapCounter] = {}


def counter(path: str) -> HeapCounter:
    """The worker's counter for a vocabulary file, loaded once."""
    if path not in _counters:
        _counters[path] = HeapCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (more than ``limit`` tokens).

    ``vocabulary`` is the path of a byte-level BPE file, readable on every
    worker.  A null or empty text has 0 bytes and 0 tokens; a null id stays
    null; repeated rows give repeated results; other columns are not read, so
    their names cannot clash.
    """
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(vocabulary).count
        for ids, texts in ((b.iloc[:, 0], b.iloc[:, 1].fillna("")) for b in batches):
            n = texts.map(count).astype("int64")
            size = texts.map(lambda t: len(t.encode("utf-8"))).astype("int64")
            yield pd.DataFrame({"id": ids, "n_bytes": size, "n_tokens": n, "over_limit": n > limit})

    counted = (docs.select(id_text(docs, id_col), docs[text_col].cast("string"))
               .mapInPandas(rows, "id string, n_bytes long, n_tokens long, over_limit boolean"))
    return id_back(counted, "id", docs, id_col)
