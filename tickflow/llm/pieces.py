"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The normalised text (spaces become U+2581, one is put in front) is cut into
words where no piece of the model can span: before a space mark that follows
another character, and around characters no multi-character piece contains.
All new words of a batch are laid out in flat numpy arrays.  Each round takes
the smallest pair rank of every word (a segmented minimum), merges its
leftmost occurrence in all words at once and compacts the arrays, until no
pair is left.  Further occurrences of the same rank merge in the same round
when that provably changes nothing: when no pair that the merges create has a
rank as good as the one being merged.

Rows are independent: a narrow ``mapInPandas`` with no shuffle.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame

from tickflow.llm.common import id_back, id_text

SPACE = "▁"
NO_RANK = np.iinfo(np.int64).max
# Fixed value: multiplier of the slot of a pair.
MIX = np.uint64(0x9E3779B97F4A7C15)
# Words kept in a worker's memo, the longest word kept, and the characters of
# text encoded in one go.
MEMO_WORDS = 150_000
MEMO_CHARS = 48
BATCH_CHARS = 400_000


class PairTable:
    """Rank and merged symbol by pair: an open-addressing table in flat
    arrays, at most a quarter full, with an empty slot at its end."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        size = 1 << self.bits
        self.keys = np.full(size + 1, -2, dtype=np.int64)
        self.ranks = np.full(size + 1, NO_RANK, dtype=np.int64)
        self.made = np.full(size + 1, -1, dtype=np.int64)
        _, last = np.unique(keys[::-1], return_index=True)  # of equal pairs the last one counts
        left = len(keys) - 1 - last
        at = self.slot(keys[left])
        while len(left):
            free = self.keys[at] == -2
            slot, first = np.unique(at[free], return_index=True)
            taken = left[free][first]
            self.keys[slot], self.ranks[slot], self.made[slot] = keys[taken], ranks[taken], made[taken]
            again = self.keys[at] != keys[left]
            left, at = left[again], (at[again] + 1) & (size - 1)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """NO_RANK and -1 for a key that is not there or is negative."""
        end = 1 << self.bits
        at = np.where(key >= 0, self.slot(key), end)
        wrong = np.flatnonzero((self.keys[at] != key) & (self.keys[at] != -2))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (end - 1)
            held = self.keys[at[wrong]]
            wrong = wrong[(held != key[wrong]) & (held != -2)]
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), np.where(hit, self.made[at], -1)


class MergeRounds:
    """Encoder and decoder for one model file (only its piece table is read
    through the library; splitting, merging and decoding are done here)."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.size = size
        self.piece = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.ids = {self.piece[i]: i for i in plain}
        self.byte_id = {int(self.piece[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.id_byte = {i: b for b, i in self.byte_id.items()}
        self.unknown = model.unk_id()
        self.control = {i for i in range(size) if model.is_control(i)}
        self.number = [str(i) for i in range(size)]
        ordinary = set(plain)
        # text of a piece; None where it depends on the ids around it
        self.shown = [self.piece[i].replace(SPACE, " ") if i in ordinary else None for i in range(size)]
        self.of_char = np.full(sys.maxunicode + 1, -1, dtype=np.int64)
        for text, i in self.ids.items():
            if len(text) == 1:
                self.of_char[ord(text)] = i
        levels = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        keys, ranks, made, inner, spans = [], [], [], set(), set()
        for i in plain:
            text = self.piece[i]
            if len(text) > 1:
                inner.update(text)
                spans.update(a for a, b in zip(text, text[1:]) if b == SPACE and a != SPACE)
            for cut in range(1, len(text)):
                a, b = self.ids.get(text[:cut]), self.ids.get(text[cut:])
                if a is not None and b is not None:
                    keys.append(a * size + b)
                    ranks.append(levels[model.get_score(i)])
                    made.append(i)
        if spans or not inner <= set(self.ids):
            raise ValueError("pieces that span a word start, or contain a character that is no piece, are not supported")
        self.table = PairTable(np.array(keys, dtype=np.int64), np.array(ranks, dtype=np.int64), np.array(made, dtype=np.int64))
        # a word: space marks, then other characters that pieces can hold; any other character stands alone
        known = "".join(map(re.escape, sorted(inner - {SPACE})))
        self.find = re.compile(f"{SPACE}*[{known}]+|{SPACE}+|[^{known}{SPACE}]").findall
        # words met lately and those before them; the pieces themselves, for good
        self.memo: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}
        whole = [p for p in self.ids if self.find(p) == [p]]
        self.always = dict(zip(whole, self.entries(whole)))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs (NO_RANK where there is none; a
        negative symbol has none)."""
        return self.table.find(np.where((left >= 0) & (right >= 0), left * self.size + right, -1))

    def merge(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All merge rounds over flat symbols; ``word`` numbers each symbol's
        word, ascending.  Words without a pair left leave the working arrays."""
        done_sym, done_word, done_at = [], [], []
        at = np.arange(len(sym))
        while len(sym):
            same = np.append(word[1:] == word[:-1], False)
            nxt = np.append(sym[1:], -1)
            rank, made = self.pairs(sym, np.where(same, nxt, -1))
            start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, start)
            length = np.diff(np.append(start, len(sym)))
            best_of = np.repeat(best, length)
            over = best_of == NO_RANK
            if over.any():
                done_sym.append(sym[over])
                done_word.append(word[over])
                done_at.append(at[over])
                keep = ~over
                sym, word, at, rank, made, best_of = (x[keep] for x in (sym, word, at, rank, made, best_of))
                if not len(sym):
                    break
                start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                length = np.diff(np.append(start, len(sym)))
            hit = rank == best_of
            where = np.flatnonzero(hit)
            # overlapping occurrences: in each run of adjacent hits take every other one, from the left
            run = np.append(True, np.diff(where) != 1)
            first = where[run][np.cumsum(run) - 1]
            where = where[(where - first) % 2 == 0]
            # the first hit of each word merges in any case
            lead = np.append(True, word[where[1:]] != word[where[:-1]])
            if not lead.all():
                good = self.safe(sym, word, where, made, best_of)
                ok = np.ones(len(sym), dtype=bool)
                ok[where] = good
                fine = np.repeat(np.logical_and.reduceat(ok, start), length)
                where = where[lead | fine[where]]
            sym = sym.copy()
            sym[where] = made[where]
            keep = np.ones(len(sym), dtype=bool)
            keep[where + 1] = False
            sym, word, at = sym[keep], word[keep], at[keep]
        if not done_at:
            return sym, word
        at = np.concatenate(done_at)
        order = np.argsort(at, kind="stable")
        return np.concatenate(done_sym)[order], np.concatenate(done_word)[order]

    def safe(self, sym, word, where, made, best_of) -> np.ndarray:
        """Per merge: no pair it creates, before or after its neighbours merge
        too, ranks as good as the merge itself."""
        n = len(sym)
        new = made[where]
        left_at, right_at = where - 1, where + 2
        left = np.where((left_at >= 0) & (word[left_at] == word[where]), sym[left_at], -1)
        r_in = np.minimum(right_at, n - 1)
        right = np.where((right_at < n) & (word[r_in] == word[where]), sym[r_in], -1)
        merged = np.full(n, -1)
        merged[where] = new
        left_new = np.where(left >= 0, merged[np.maximum(where - 2, 0)], -1)
        left_new = np.where(where >= 2, left_new, -1)
        limit = best_of[where]
        good = np.ones(len(where), dtype=bool)
        for a, b in ((left, new), (new, right), (left_new, new)):
            good &= self.pairs(a, b)[0] > limit
        return good

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, all words merged together."""
        flat = "".join(words)
        sym = self.of_char[np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        word = np.repeat(np.arange(len(words)), size)
        outside = [i for i in np.flatnonzero(sym < 0)]
        for i in outside:  # a character that is no piece: a negative mark that points to it
            sym[i] = -2 - i
        out, owner = self.merge(sym, word)
        ends = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        out = out.tolist()
        got = []
        for a, b in zip(ends, ends[1:]):
            row = []
            for s in out[a:b]:
                if s >= 0:
                    row.append(s)
                else:
                    row.extend(self.fallback(flat[-2 - s]))
            got.append(row)
        return got

    def fallback(self, char: str) -> list[int]:
        if not self.byte_id:
            return [self.unknown]
        return [self.byte_id[b] for b in char.encode("utf-8", "surrogatepass")]

    def decode_ids(self, ids: list[int]) -> str:
        """Text of ids, with the space put in front by encoding still there.
        Runs of byte ids are read as UTF-8, each wrong byte as U+FFFD."""
        shown = [self.shown[i] for i in ids]
        if None not in shown:
            return "".join(shown)
        out, run = [], bytearray()
        for i in ids:
            b = self.id_byte.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(utf8(bytes(run)))
                run.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.control:
                out.append(self.piece[i].replace(SPACE, " "))
        if run:
            out.append(utf8(bytes(run)))
        return "".join(out)

    def split(self, text: str) -> list[str]:
        return self.find(SPACE + text.replace(" ", SPACE)) if text else []

    def learn(self, texts: list[list[str]]) -> dict[str, tuple[int, str, str]]:
        """(ids, ids as a string, decoded text) of every word of the batch."""
        memo, older, always = self.memo, self.older, self.always
        got, fresh = {}, []
        for word in {w for words in texts for w in words}:
            entry = always.get(word) or memo.get(word)
            if entry is None:
                entry = older.get(word)
                if entry is None:
                    fresh.append(word)
                    continue
                memo[word] = entry
            got[word] = entry
        for word, entry in zip(fresh, self.entries(fresh)):
            got[word] = entry
            if len(word) <= MEMO_CHARS:
                memo[word] = entry
        if len(memo) > MEMO_WORDS // 2:  # words not met again since the last time are forgotten
            self.older, self.memo = memo, {}
        return got

    def entries(self, words: list[str]) -> list[tuple[int, str, str]]:
        """(ids, ids as a string, decoded text) of each word."""
        return [(len(ids), ",".join([self.number[i] for i in ids]), self.decode_ids(ids)) for ids in (self.encode_words(words) if words else [])]

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_words(self.split(text)) for i in ids] if text else []

    def decode(self, ids: list[int]) -> str:
        """Text of ids, without the space that encoding puts in front."""
        text = self.decode_ids(ids)
        first = next((i for i in ids if i not in self.control), None)
        spaced = first is not None and first not in self.id_byte and self.piece[first].startswith(SPACE)
        return text[1:] if spaced else text


def utf8(data: bytes) -> str:
    """UTF-8 text; every byte outside a valid sequence gives one U+FFFD."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError as e:
        head = data[:e.start].decode("utf-8") + "�"
        return head + utf8(data[e.start + 1:])


_models: dict[str, MergeRounds] = {}


def model(path: str) -> MergeRounds:
    """The worker's encoder for a model file, loaded once."""
    if path not in _models:
        _models[path] = MergeRounds(path)
    return _models[path]


def portions(ids, texts):
    """Rows in portions of about BATCH_CHARS characters, one row at least."""
    a, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= BATCH_CHARS:
            yield ids[a:k + 1], texts[a:k + 1]
            a, size = k + 1, 0
    if a < len(texts):
        yield ids[a:], texts[a:]


def piece_round_trip(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                     keep_ids: bool = False) -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256`` (lower-case hex); with ``keep_ids`` also ``ids`` and
    the ``decoded`` text themselves.

    A null or empty text has no tokens and decodes to an empty text; a null id
    stays null; repeated rows give repeated results; other columns are not
    read.  ``model_file`` must be readable on every worker.
    """
    extra = ", ids array<int>, decoded string" if keep_ids else ""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model(model_file)
        for batch in batches:
            for ids, texts in portions(batch.iloc[:, 0], batch.iloc[:, 1].fillna("").tolist()):
                split = [m.split(t) for t in texts]
                known = m.learn(split)
                out = []
                for words in split:
                    got = [known[w] for w in words]
                    text = "".join([g[2] for g in got])
                    text = text[1:] if text.startswith(" ") else text
                    line = ",".join([g[1] for g in got])
                    row = [sum([g[0] for g in got]), hashlib.sha256(line.encode()).hexdigest(),
                           hashlib.sha256(text.encode("utf-8")).hexdigest()]
                    out.append(row + ([[int(i) for i in line.split(",")] if line else [], text] if keep_ids else []))
                cols = ["n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if keep_ids else [])
                frame = pd.DataFrame(out, columns=cols)
                frame.insert(0, "id", ids.reset_index(drop=True))
                yield frame

    coded = (docs.select(id_text(docs, id_col), docs[text_col].cast("string"))
             .mapInPandas(rows, f"id string, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}"))
    return id_back(coded, "id", docs, id_col)
