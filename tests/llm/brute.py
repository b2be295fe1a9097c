"""Plain single-process versions of the operators, for small inputs."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def shingle_set(text, k):
    words = WORD.findall((text or "").translate(LOW))
    if not words:
        return frozenset()
    width = min(k, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def jaccard_groups(rows, k, num, den):
    """[(id, n_shingles, component_id)] of (id, text) rows."""
    sets, union = [shingle_set(t, k) for _, t in rows], Union(len(rows))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                union.join(i, j)
    members = {}
    for i, (doc, _) in enumerate(rows):
        members.setdefault(union.root(i), []).append(doc)
    least = {r: min((d for d in m if d is not None), default=None) for r, m in members.items()}
    return [(doc, len(sets[i]), least[union.root(i)]) for i, (doc, _) in enumerate(rows)]


def repeated_strings(texts, length):
    """[(n_bytes, spans, kept bytes)] by comparing every window."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans, i = [], 0
        while i < len(d):
            j = i
            while j < len(d) and gone[j]:
                j += 1
            if j > i:
                spans.append((i, j))
            i = max(j, i + 1)
        out.append((len(d), spans, bytes(x for x, g in zip(d, gone) if not g)))
    return out


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


def best_fit(lengths, capacities, cost):
    """Bins as lists of lengths with their final capacity, by looking at every bin."""
    bins = []
    for n in lengths:
        fits = [b for b in bins if b["free"] >= n]
        if fits:
            b = min(fits, key=lambda b: (b["free"], b["at"]))
        else:
            c = min((c for c in capacities if c >= n), key=lambda c: (cost(c) / c, c))
            b = {"free": c, "items": [], "at": len(bins)}
            bins.append(b)
        b["free"] -= n
        b["items"].append(n)
    return [(b["items"], min(c for c in capacities if c >= sum(b["items"]))) for b in bins]
