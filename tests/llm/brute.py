"""Plain versions of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    data = (text or "").encode()
    return (data.translate(LOWER) if lower else data).split()


class Sets:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def union(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, width):
    w = words(text)
    if len(w) >= width:
        return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def components(docs, width=4, percent=85):
    """id -> (number of shingles, smallest linked id); all pairs are compared."""
    sets = {i: shingles(t, width) for i, t in docs}
    joined = Sets(sets)
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b:
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    joined.union(i, j)
    return {i: (len(sets[i]), joined.find(i)) for i in ids}


def without_repeats(docs, length=400):
    """id -> (bytes, removed, spans, sha256 of the rest)."""
    seen = Counter()
    texts = {i: (t or "").encode() for i, t in docs}
    for b in texts.values():
        seen.update(b[p:p + length] for p in range(len(b) - length + 1))
    out = {}
    for i, b in texts.items():
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\x01" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), sum(1 for run in bytes(gone).split(b"\x00") if run),
                  hashlib.sha256(rest).hexdigest())
    return out


def measures(text):
    text = text or ""
    w = words(text, lower=False)
    windows = defaultdict(list)
    for i in range(len(w) - 4):
        windows[tuple(w[i:i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines, duplicates = set(), 0
    for line in text.split("\n"):
        if words(line):
            duplicates += line in lines
            lines.add(line)
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered))


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def unigram(docs):
    """id -> (tokens, known, training tokens, base score)."""
    tokens = {i: words(t) + [b" end"] for i, t in docs}
    counts = Counter(w for i, t in tokens.items() if not held_out(i) for w in t)
    total, distinct = sum(counts.values()), len(counts)
    return {i: (len(t), sum(w in counts for w in t), total, sum(
        math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t)) for i, t in tokens.items()}


def targets(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    """source -> target, by resharing what exceeds the limits until nothing does."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, capped = budget * sum(sizes.values()), {}
    while True:
        open_sources = [s for s in order if s not in capped]
        rest = goal - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_sources) for s in open_sources}
        over = {s: float(most * sizes[s]) for s in open_sources if share[s] > most * sizes[s]}
        if not over:
            return capped | share
        capped |= over
