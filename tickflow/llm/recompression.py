"""Longest-common-extension queries from a run-length grammar.

Recompression alternates two rounds over an integer sequence.  Block
compression replaces each maximal block of one symbol by a symbol of (symbol,
count).  Pair compression gives every symbol a side by a hash and replaces
each left-right neighbour pair by a symbol of the pair.  Equal stretches get
equal symbols except near their ends, so two positions are compared by
climbing through the rounds while both stand at a symbol's start, and
descending where the symbols differ.

The rounds are flat numpy arrays over any number of texts at once; a text
ends in a symbol of its own that never takes part in a round.
"""

from __future__ import annotations

import numpy as np

# Multipliers of the hash that gives a symbol its side.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
ROUNDS_MAX = 400


def sides(symbols: np.ndarray, salt: int) -> np.ndarray:
    """False (left) or True (right) for every symbol."""
    x = (symbols.astype(np.uint64) + np.uint64(salt + 1)) * MIX_A
    x = (x ^ (x >> np.uint64(29))) * MIX_B
    return (x >> np.uint64(40)) & np.uint64(1) == 1


class Grammar:
    """Rounds over ``symbols`` (int64, not negative); ``ends`` are the places
    of the end marks, which are given symbols that occur once."""

    def __init__(self, symbols: np.ndarray, ends: np.ndarray):
        symbols = symbols.astype(np.int64).copy()
        used = int(symbols.max(initial=0)) + 1
        symbols[ends] = used + np.arange(len(ends))
        used += len(ends)
        is_end = np.zeros(len(symbols), dtype=bool)
        is_end[ends] = True
        at = np.arange(len(symbols) + 1)
        self.symbols, self.at, self.up, self.first, self.block = [], [], [], [], []
        self._level(symbols, at)
        quiet = 0
        for salt in range(ROUNDS_MAX):
            if len(symbols) <= 2 * len(ends) or quiet > 8:
                break
            before = len(symbols)
            for block in (True, False):
                same = ~is_end[1:] & ~is_end[:-1]
                if block:
                    joined = same & (symbols[1:] == symbols[:-1])
                else:
                    right = sides(symbols, salt)
                    joined = same & ~right[:-1] & right[1:]
                if not joined.any():
                    continue
                start = np.flatnonzero(np.append(True, ~joined))
                size = np.diff(np.append(start, len(symbols)))
                made = symbols[start].copy()
                many = np.flatnonzero(size > 1)
                other = size[many] if block else symbols[start[many] + 1]
                key = made[many] * np.int64(max(used, len(symbols) + 1)) + other
                _, name = np.unique(key, return_inverse=True)
                made[many] = used + name
                used += int(name.max()) + 1
                parent = np.repeat(np.arange(len(start)), size)
                self.up.append(parent.data)
                self.block.append(block)
                self.first.append(np.append(start, len(symbols)).data)
                symbols, is_end, at = made, is_end[start], at[np.append(start, len(symbols))]
                self._level(symbols, at)
            quiet = quiet + 1 if len(symbols) == before else 0

    def _level(self, symbols: np.ndarray, at: np.ndarray) -> None:
        # memoryviews: plain Python numbers by index, eight bytes each
        self.symbols.append(symbols.data)
        self.at.append(at.data)

    def lce(self, a: int, b: int) -> int:
        """Number of symbols that agree from the places ``a`` < ``b`` on."""
        x, y, level, top = a, b, 0, len(self.symbols) - 1
        while True:
            s = self.symbols[level]
            if level < top:
                up, first = self.up[level], self.first[level]
                px, py = up[x], up[y]
                if first[px] == x and first[py] == y:
                    level, x, y = level + 1, px, py
                    continue
                if s[x] != s[y]:
                    break
                step = min(first[px + 1] - x, first[py + 1] - y) if self.block[level] else 1
                x, y = x + step, y + step
            elif s[x] == s[y]:
                x, y = x + 1, y + 1
            else:
                break
        while level:
            level -= 1
            first, s = self.first[level], self.symbols[level]
            ex, ey = first[x + 1], first[y + 1]
            x, y = first[x], first[y]
            if s[x] == s[y]:
                step = min(ex - x, ey - y) if self.block[level] else 1
                x, y = x + step, y + step
                # symbols that differ have contents that differ: at the next place at the latest
                while s[x] == s[y]:
                    x, y = x + 1, y + 1
        return x - a
