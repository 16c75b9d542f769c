"""A minimal perfect hash over 128-bit keys, and arrays indexed by it.

Keys are placed level by level: at each level a key whose slot no other key
of that level wants takes it, and the others go on to the next.  A key's
number is the count of taken slots before its own, so n keys have the numbers
0 to n - 1 and the hash itself needs about three bits a key.
"""

from __future__ import annotations

import numpy as np

# Slots a key at each level.
SPREAD = 2
# Multipliers of the mixing of key halves.
MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX_A
    x = (x ^ (x >> np.uint64(33))) * MIX_B
    return x ^ (x >> np.uint64(33))


def slots(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    """Slot of the keys (a, b) among ``size`` at a level."""
    return mixed(a ^ mixed(b + np.uint64(level))) % np.uint64(size)


class PerfectHash:
    """``sizes``: slots of each level; ``taken``: the levels' slots, one flag each."""

    def __init__(self, sizes: np.ndarray, taken: np.ndarray):
        self.sizes, self.taken = sizes, taken
        self.rank = np.cumsum(taken) - taken

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        """Over distinct keys, given as two uint64 halves."""
        sizes, flags = [], []
        while len(a):
            size = SPREAD * len(a)
            at = slots(a, b, len(sizes), size)
            wanted = np.bincount(at.astype(np.int64), minlength=size)
            sizes.append(size)
            flags.append(wanted == 1)
            again = wanted[at.astype(np.int64)] > 1
            a, b = a[again], b[again]
        return cls(np.array(sizes, dtype=np.int64), np.concatenate(flags) if flags else np.zeros(0, dtype=bool))

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of each key; -1, or some key's number, for a key not built in
        (the caller compares fingerprints)."""
        out = np.full(len(a), -1, dtype=np.int64)
        left = np.arange(len(a))
        base = 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = base + slots(a[left], b[left], level, size).astype(np.int64)
            here = self.taken[at]
            out[left[here]] = self.rank[at[here]]
            left = left[~here]
            base += size
        return out

    def packed(self) -> tuple[bytes, bytes]:
        return self.sizes.tobytes(), np.packbits(self.taken).tobytes()

    @classmethod
    def unpacked(cls, sizes: bytes, taken: bytes) -> PerfectHash:
        levels = np.frombuffer(sizes, dtype=np.int64)
        flags = np.unpackbits(np.frombuffer(taken, dtype=np.uint8), count=int(levels.sum())).astype(bool)
        return cls(levels, flags)
