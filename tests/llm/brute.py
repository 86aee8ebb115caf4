"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
import zlib

WORD = re.compile("[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


class Union:
    def __init__(self):
        self.p = {}

    def find(self, x):
        while self.p.setdefault(x, x) != x:
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.p[max(a, b)] = min(a, b)


def near_duplicates(rows, k, pct):
    """{id: (set size, component)} for unique ids."""
    s = {i: shingles(t, k) for i, t in rows}
    u, ids = Union(), sorted(s)
    for n, a in enumerate(ids):
        u.find(a)
        for b in ids[n + 1:]:
            both = len(s[a] & s[b])
            if both and 100 * both >= pct * (len(s[a]) + len(s[b]) - both):
                u.join(a, b)
    return {i: (len(s[i]), u.find(i)) for i in ids}


def covered(texts, length):
    """Per text (in order) the mask of bytes that a string with an earlier start covers."""
    seen, out = set(), []
    for t in texts:
        m = bytearray(len(t))
        for s in range(len(t) - length + 1):
            x = t[s:s + length]
            if x in seen:
                m[s:s + length] = b"\x01" * length
            seen.add(x)
        out.append(m)
    return out


def base_counts(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = {x for x in win if win.count(x) > 1} if len(win) < 3000 else {x for x, n in __import__("collections").Counter(win).items() if n > 1}
    inside = {i + k for i, x in enumerate(win) if x in many for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))


def water(sizes, weights, budget, most):
    """Targets by sharing again and again: {source: target} of [(source, size)] in weighing order."""
    w = {s: weights[i % len(weights)] for i, (s, _) in enumerate(sizes)}
    cap = {s: most * n for s, n in sizes}
    total, capped = budget * sum(n for _, n in sizes), set()
    while True:
        free = [s for s, _ in sizes if s not in capped]
        left = total - sum(cap[s] for s in capped)
        t = {s: left * w[s] / sum(w[f] for f in free) for s in free}
        over = {s for s in free if t[s] > cap[s]}
        if not over:
            return {s: cap[s] if s in capped else t[s] for s, _ in sizes}
        capped |= over


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
