"""Plain Python versions of what the operators compute."""

import hashlib
from collections import Counter, defaultdict

import numpy as np


def text_of(t):
    return t or ""


def shingles(text, size=5):
    w = text_of(text).encode().lower().split()
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near_components(rows, percent=75):
    """{doc_id: (set size of each row, component)}; rows sharing an id are one document."""
    sets = [(i, shingles(t)) for i, t in rows]
    inverted = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            inverted[x].append(k)
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, n in Counter(j for x in s for j in inverted[x] if j > k).items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = find(i), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for i, s in sets)


def without_repeats(rows, length=50):
    """Sorted (doc_id, n_bytes, n_removed, n_spans, sha256 of what is left)."""
    data = [(i, text_of(t).encode()) for i, t in rows]
    first = {}
    for i, b in data:
        for p in range(len(b) - length + 1):
            k = b[p:p + length]
            first[k] = min(i, first.get(k, i))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = True
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()),
                    hashlib.sha256(left).hexdigest()))
    return sorted(out)


def without_lines(rows, least_chars=40, least_docs=5):
    """Sorted (doc_id, n_lines, n_dropped, sha256 of what is left)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(lower)

    holders = defaultdict(set)
    for i, t in rows:
        for line in text_of(t).split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = text_of(t).split("\n")
        kept = [x for x in lines if len(key(x)) < least_chars or len(holders[key(x)]) < least_docs
                or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)
