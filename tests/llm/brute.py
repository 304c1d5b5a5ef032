"""Plain versions of the operators' definitions, for small tables."""

from __future__ import annotations

import collections
import re


def near_groups(rows, k, percent):
    """{doc_id: (set size, smallest linked doc_id)}"""

    def shingles(text):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        if 0 < len(words) < k:
            return {tuple(words)}
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}

    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                u, v = root(a), root(b)
                parent[max(u, v)] = min(u, v)
    return {i: (len(sets[i]), root(i)) for i in ids}


def water(names, weight, cap, budget):
    """Raise the level until a child is full, again and again."""
    given, full = dict.fromkeys(names, 0), set()
    while True:
        weights = sum(weight[n] for n in names if n not in full)
        new = [n for n in names if n not in full and cap[n] * weights <= budget * weight[n]]
        if not new:
            break
        n = min(new, key=lambda n: (cap[n] / weight[n], n))
        full.add(n)
        given[n] = cap[n]
        budget -= cap[n]
    rest = sorted(n for n in names if n not in full)
    weights = sum(weight[n] for n in rest)
    for n in rest:
        given[n] = budget * weight[n] // weights
    short = budget - sum(given[n] for n in rest)
    for n in rest[:short]:
        given[n] += 1
    return given


def word_counts(rows, train):
    counts = collections.Counter()
    tokens = {}
    for i, text in rows:
        tokens[i] = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [b""]
        if train(i):
            counts.update(tokens[i])
    return tokens, counts
