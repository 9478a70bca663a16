"""Plain definitions the operators are held against."""

import hashlib
import re

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def substring_dedup(rows, window=13):
    least = {}
    for i, t in rows:
        w = words(t)
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if i is not None:
                least[k] = min(least.get(k, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and least[tuple(w[s:s + window])] < i:
                gone.update(range(s, s + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, k):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_duplicates(rows, k, percent):
    """(doc_id, n_shingles, component_id) by comparing every two sets that share a shingle."""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    seen = set()
    for group in where.values():
        if len(group) > 1:
            for a in range(len(group)):
                for b in range(a):
                    seen.add((group[b], group[a]))
    for a, b in seen:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return [(i, len(sets[i]), find(i)) for i in sets]
