"""Plain versions of the operators, for tests on small tables."""

from __future__ import annotations

import re

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\r\x0b\x0c"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, n):
    w = words(text)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def components(rows, n, percent):
    """{id: (size, component)} of (id, text) rows with distinct ids."""
    sets = {k: shingles(t, n) for k, t in rows}
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = root(a), root(b)
                up[max(u, v)] = min(u, v)
    return {k: (len(sets[k]), root(k)) for k in ids}


def dedup_lines(rows, window=3):
    """{id: (text, removed positions)} of (id, text) rows with distinct ids."""
    first, out = {}, {}
    for k, t in sorted(rows, key=lambda r: r[0]):
        lines = [(i, x.strip(BLANK)) for i, x in enumerate((t or "").split("\n"))]
        lines = [(i, x) for i, x in lines if x]
        gone = set()
        for j in range(len(lines) - window + 1):
            w = tuple(x for _, x in lines[j:j + window])
            if w in first:
                gone.update(i for i, _ in lines[j:j + window])
            else:
                first[w] = (k, j)
        if not gone:
            out[k] = (t, [])
            continue
        kept = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
        out[k] = (kept if kept.strip(BLANK + "\n") else "", sorted(gone))
    return out
