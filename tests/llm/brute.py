"""Plain single-process versions that the operators are compared with."""

from __future__ import annotations

import re
from collections import defaultdict


class Union:
    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def ascii_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingle_set(text, size):
    w = ascii_words(text)
    if not w:
        return frozenset()
    k = min(size, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near_groups(rows, size, percent):
    """doc_id -> smallest linked doc_id."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    u = Union()
    at = defaultdict(set)
    for i, s in sets.items():
        u.find(i)
        seen = defaultdict(int)
        for g in s:
            for j in at[g]:
                seen[j] += 1
            at[g].add(i)
        for j, both in seen.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                u.join(i, j)
    return {i: u.find(i) for i in sets}, sets


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]
