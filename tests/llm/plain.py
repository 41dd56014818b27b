"""The contracts in plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low_words(text):
    return (text or "").encode().translate(LOWER).split()


def shingles(text, width=4):
    w = low_words(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def components(n, links):
    """The set of each of n things."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def least(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def repeated_words(texts, window):
    """Per text whether each of its words is under a window that occurs elsewhere."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((w, gone))
    return out


class Ppm:
    """Prediction by partial matching, byte by byte."""

    def __init__(self, order, texts):
        self.order, self.seen = order, [defaultdict(Counter) for _ in range(order + 1)]
        for t in texts:
            x = self.stream(t)
            for p in range(order, len(x)):
                for k in range(order + 1):
                    self.seen[k][x[p - k : p]][x[p]] += 1

    def stream(self, text):
        w = low_words(text)
        return b"\n" * self.order + b" ".join(w) + b"\n"

    def probability(self, context, byte):
        gone, p = set(), 1.0
        for k in range(self.order, -1, -1):
            left = {b: c for b, c in self.seen[k].get(context[len(context) - k :], {}).items() if b not in gone}
            total = sum(left.values())
            if byte in left:
                return p * (left[byte] - 0.5) / total
            if total:
                p *= len(left) * 0.5 / total
                gone |= set(left)
        return p / (256 - len(gone))
