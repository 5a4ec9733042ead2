"""Fixtures and brute-force counterparts for the tests of the subpackage."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return _WORD.findall((text or "").translate(LOWER))


def shingle_classes(rows, width, percent):
    """{id: (set size, smallest id reachable)} by comparing all pairs that share a shingle."""
    sets = {}
    for i, text in rows:
        w = words(text)
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    users, overlap, parent = defaultdict(list), Counter(), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            users[x].append(i)
    for ids in users.values():
        overlap.update(itertools.combinations(sorted(ids), 2))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in overlap.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeats(rows, span):
    """{id: (bytes, removed, runs, digest of the rest)} by remembering every string of ``span`` bytes."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - span + 1):
            s = data[p : p + span]
            if s in seen:
                gone[p : p + span] = b"\1" * span
            seen.add(s)
        rest = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


def terms(text):
    return Counter(w for w in re.split(r"[ \n\t\r]", text) if w)


def generalised_jaccard(one, other):
    keys = set(one) | set(other)
    most = sum(max(one[k], other[k]) for k in keys)
    return sum(min(one[k], other[k]) for k in keys) / most if most else 1.0
