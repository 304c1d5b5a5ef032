"""Periodic runs of words: a suffix automaton whose suffix-link tree is accessed as a link-cut tree.

The tree's paths carry the last end of the words they spell. Appending word i accesses the path from
the new prefix to the root: it meets segments of one colour j (the last earlier end) each, whose
deepest node spells the longest suffix that also ends at j, of length L. If d = i - j <= L, the L + d
words up to i have smallest period d and cannot be extended to the left, so they hold a square of d;
then the path is recoloured to i. The last i of each (start, d) is the run's end.

Only stretches that can hold a run reach the automaton. Every word of a run of 12 words or more lies
in a passage of six words that occurs twice within the run: with a period below six each passage
recurs one period away, otherwise both halves are covered by passages that recur in the other half.
So words outside repeated passages separate the text into stretches, again until nothing changes;
equal passages have equal hashes, so a collision can only keep a stretch, never lose a run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread
from .common import binary_values, mix64, ship_code, whole_text

LEAST = 12  # words of a run, and at least two periods
_GRAM = 6
_WORDS_AT_ONCE = 1 << 20
Run = tuple[int, int, int]  # start, length, period

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)


def suffix_tree(word: list) -> tuple[list[int], list[int], list[int]]:
    """The automaton's suffix links and longest lengths, and the node of each prefix. Node 0 spells
    nothing and links to -1."""
    link, length, arcs, at = [-1], [0], [{}], []
    last = 0
    for c in word:
        node = len(link)
        link.append(0)
        length.append(length[last] + 1)
        arcs.append({})
        p = last
        while p >= 0 and c not in arcs[p]:
            arcs[p][c] = node
            p = link[p]
        if p >= 0:
            q = arcs[p][c]
            if length[q] == length[p] + 1:
                link[node] = q
            else:
                copy = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                arcs.append(arcs[q].copy())
                while p >= 0 and arcs[p].get(c) == q:
                    arcs[p][c] = copy
                    p = link[p]
                link[q] = link[node] = copy
        at.append(node)
        last = node
    return link, length, at


class LastEnds:
    """The link tree cut into paths of one colour, each held in a splay tree ordered by depth."""

    def __init__(self, link: list[int]):
        n = len(link)
        self.up = link[:]  # parent in the splay tree, or the path's parent in the link tree
        self.above = [-1] * n  # left child: nearer to the root
        self.below = [-1] * n
        self.colour = [-1] * n  # valid at the root of each splay tree

    def _rotate(self, x: int) -> None:
        up, above, below = self.up, self.above, self.below
        y = up[x]
        z = up[y]
        if above[y] == x:
            moved = above[y] = below[x]
            below[x] = y
        else:
            moved = below[y] = above[x]
            above[x] = y
        if moved >= 0:
            up[moved] = y
        up[y], up[x] = x, z
        if z >= 0:
            if above[z] == y:
                above[z] = x
            elif below[z] == y:
                below[z] = x

    def _splay(self, x: int) -> None:
        up, above, below = self.up, self.above, self.below
        while True:
            y = up[x]
            if y < 0 or (above[y] != x and below[y] != x):
                return
            z = up[y]
            if z < 0 or (above[z] != y and below[z] != y):
                self.colour[x] = self.colour[y]
                self._rotate(x)
                return
            w = up[z]
            if w < 0 or (above[w] != z and below[w] != z):
                self.colour[x] = self.colour[z]
            self._rotate(y if (above[z] == y) == (above[y] == x) else x)
            self._rotate(x)

    def access(self, node: int, new: int) -> list[tuple[int, int]]:
        """Recolour the path from the root to ``node``; (deepest node, old colour) of its segments."""
        met, deeper, x = [], -1, node
        up, below, colour = self.up, self.below, self.colour
        while x >= 0:
            self._splay(x)
            met.append((x, colour[x]))
            cut = below[x]
            if cut >= 0:
                colour[cut] = colour[x]  # what lies deeper stays a path of the old colour
            below[x] = deeper
            deeper = x
            x = up[x]
        colour[deeper] = new
        return met


def runs_of(word: list) -> list[Run]:
    """All runs of at least LEAST words, by start, then period."""
    link, length, at = suffix_tree(word)
    paths = LastEnds(link)
    end: dict[tuple[int, int], int] = {}
    for i, node in enumerate(at):
        for x, j in paths.access(node, i):
            d = i - j
            if j >= 0 and d <= length[x] and d + length[x] >= LEAST:
                end[i + 1 - length[x] - d, d] = i
    return sorted((s, i + 1 - s, d) for (s, d), i in end.items())


def stretches(key: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, end) of the maximal stretches of words that may hold a run: ``key`` is a hash of each
    word, ``group`` its text; texts follow each other."""
    hashed = mix64(key.astype(np.uint64))
    gram = np.zeros(max(len(hashed) - _GRAM + 1, 0), np.uint64)
    for j in range(_GRAM):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + hashed[j : len(hashed) - _GRAM + 1 + j]
    place = np.arange(len(gram))
    part = group.astype(np.int64)
    held = -1
    while len(place):
        # Passages within one part whose like occurs in the same part again.
        place = place[part[place] == part[place + _GRAM - 1]]
        mine = mix64(gram[place] ^ mix64(part[place].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(mine, kind="stable")
        same = mine[order[1:]] == mine[order[:-1]]
        twice = np.zeros(len(place), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        place = place[twice]
        # Words under them, numbered anew by stretch; a stretch ends where its part does.
        change = np.zeros(len(key) + 1, np.int64)
        np.add.at(change, place, 1)
        np.add.at(change, place + _GRAM, -1)
        covered = np.cumsum(change[:-1]) > 0
        first = covered.copy()
        first[1:] &= ~covered[:-1] | (part[1:] != part[:-1])
        starts = np.flatnonzero(first)
        numbered = np.cumsum(first) - 1
        size = np.bincount(numbered[covered], minlength=len(starts))
        keep = size >= LEAST
        covered &= keep[numbered] if len(starts) else False
        if covered.sum() == held:
            yield from zip(starts[keep].tolist(), (starts + size)[keep].tolist(), strict=True)
            return
        held = int(covered.sum())
        part = np.where(covered, numbered, -1 - np.arange(len(key)))


def repeat_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of every tenth document (by checksum of its id) with a periodic tail; a null id
    changes nothing."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * -(-(n - a) // p))[: n - a]


def result(doc_id: int | None, words: list[bytes], runs: list[Run]) -> tuple:
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for s, n, p in runs:
            drop[s + p] += 1
            drop[s + n] -= 1
        kept = (np.cumsum(drop[:-1]) == 0).tolist()
        words = [w for w, k in zip(words, kept, strict=True) if k]
        s, n, p = min(runs, key=lambda r: (-r[1], r[0], r[2]))
        longest = (s, n, p, 1000 * n // p)
    else:
        longest = (None, None, None, None)
    return (
        doc_id, len(runs), *longest, hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(words)).hexdigest(),
    )


def _decided(texts: list[tuple[int | None, list[bytes]]]) -> Iterator[tuple]:
    """Result rows of a block of (doc_id, words)."""
    size = [len(w) for _, w in texts]
    begin = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    found: list[list[Run]] = [[] for _ in texts]
    if begin[-1] >= LEAST:
        key = np.fromiter((hash(w) for _, words in texts for w in words), np.int64, begin[-1])
        group = np.repeat(np.arange(len(texts)), size)
        for first, end in stretches(key, group):
            t = int(group[first])
            base = int(begin[t])
            piece = texts[t][1][first - base : end - base]
            found[t] += [(s + first - base, n, p) for s, n, p in runs_of(piece)]
    for (doc_id, words), runs in zip(texts, found, strict=True):
        yield result(doc_id, words, runs)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_runs, the longest run (start, length, period, exponent_milli; nulls
    without one), runs_sha256 and collapsed_sha256, with every tenth text's tail made periodic first.

    A run is a maximal stretch of at least 12 words and two smallest periods; collapsing keeps its
    first period. A null text is empty: no runs, both digests of nothing. Repeated rows and null ids
    come once per row (a null id leaves its text as it is). Empty input gives no rows; other columns
    are not read. Texts stay where they lie, there is no shuffle; a task holds a block of about a
    million words or one longer text, and the automaton one stretch at a time.
    """
    ship_code(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[int | None, list[bytes]]] = []
            total = 0
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), binary_values(batch, "text"), strict=True):
                words = repeat_tail(text.split(), doc_id)
                held.append((doc_id, words))
                total += len(words)
                if total >= _WORDS_AT_ONCE:
                    out += _decided(held)
                    held, total = [], 0
            out += _decided(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[i] for r in out], pa.int64() if i < 6 else pa.string())
                    for i in range(8)
                ],
                [f.split()[0] for f in SCHEMA.split(", ")],
            )

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return spread(texts).mapInArrow(rows, SCHEMA)
