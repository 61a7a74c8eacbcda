"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
from itertools import combinations


def words(text):
    return (text or "").encode().split()


def kept_words(docs, window):
    """Brute force of the substring dedup: {doc_id: (n_words, n_removed, sha)}."""
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k: k + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k: k + window])] < i:
                gone.update(range(k, k + window))
        rest = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(rest)).hexdigest())
    return out


def shingles(text, width):
    w = [x.lower() for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[k: k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def components(docs, width, percent=80):
    """{doc_id: (size of the set, least id reachable)}."""
    sets = {i: shingles(t, width) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in sets}


def edit_distance_within(probe, text):
    """Fewest edits of the probe against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(probe, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
