"""Plain counterparts of the training-data operators, for small inputs."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)


def shingle_set(text, n):
    w = words((text or "").translate(ASCII_LOWER))
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def components(rows, n=4, percent=85):
    """(doc_id, set size, smallest linked id) of every row."""
    sets = [shingle_set(t, n) for _, t in rows]
    groups = Groups()
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                groups.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        g = groups.find(i)
        least[g] = min(least.get(g, d), d)
    return sorted((d, len(s), least[groups.find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def without_windows(rows, window=20):
    """(doc_id, words, removed, digest) with distinct ids."""
    seen, out = set(), []
    for d, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((d, len(w), len(w) - len(kept), sha(" ".join(kept))))
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
