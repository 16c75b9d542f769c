"""Plain, slow versions that the operators are held against."""

from __future__ import annotations

import re


def shingles(text, n):
    """Set of n-word shingles, as word tuples."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0D]+", lowered)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def jaccard_components(rows, n, percent):
    """{row index: (set size, smallest id reachable)} over all pairs of rows."""
    sets = [shingles(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    index = {}
    for i, s in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        counts = {}
        for x in s:
            for j in index[x]:
                if j < i:
                    counts[j] = counts.get(j, 0) + 1
        for j, both in counts.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if sets[i] and doc is not None:
            r = root(i)
            least[r] = min(least.get(r, doc), doc)
    return [(doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def periodic_runs(words):
    """(start, length, period) of every run, by trying every period at every word."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(24, 3 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, k, p) for (s, k), p in found.items()), key=lambda r: (r[0], r[2]))


def kept_lines(rows):
    """{row index: (lines before, dropped, kept text)} for rows (id, text)."""
    def key(line):
        k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
        return k if len(k) >= 10 else None

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if key(line) is not None and doc is not None:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) is None or not holders.get(key(x)) or doc == min(holders[key(x)])]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def repair(rows, damage=True):
    """{conv: result tuple} for rows (conv, turn, role, text)."""
    import hashlib
    import zlib
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        kept += [(turn, role, text)] * (2 if code == 3 else 1)
    return {c: _repair_one(sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).hexdigest())))
            for c, r in convs.items()}


def _repair_one(rows):
    import hashlib
    from functools import lru_cache
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, fault = set(), []
    for _, role, text in rows:
        last = re.findall("[^\x20\x09-\x0D]", text)
        fault.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    forward = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def best(i, state, inserted):
        """Least (cost, letters, turns) from row i on."""
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            new = "a" if state == "u" else "u"
            c, w, t = memo(i, new, inserted + 1)
            options.append((c + 5, "I" + w, (({"u": "user", "a": "assistant"}[new], ""),) + t))
        if i < len(rows):
            _, role, text = rows[i]
            c, w, t = memo(i + 1, state, 0)
            options.append((c + 2, "D" + w, t))
            if fault[i] not in ("blank", "duplicate"):
                cut = 5 if fault[i] == "truncated" else 0
                if initials[i] in forward[state]:
                    c, w, t = memo(i + 1, initials[i], 0)
                    options.append((c + cut, "K" + w, ((role, text),) + t))
                new = "a" if state == "u" else "u"
                c, w, t = memo(i + 1, new, 0)
                options.append((c + cut + 1, "R" + w, (({"u": "user", "a": "assistant"}[new], text),) + t))
        return min(options, key=lambda o: o[:2]) if options else (10 ** 9, "", ())
    memo = lru_cache(None)(best)
    cost, letters, made = memo(0, "", 0)
    return (gaps, fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), illegal, cost, letters,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
