"""Word shingles as sorted sets of 64-bit hashes, computed with numpy over many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from .common import chunks_of_texts, mix64

_BLOCK = 1 << 17
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POSITIONS = 1 << 12


def _odd(n: int, salt: int) -> np.ndarray:
    seeds = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt)
    return mix64(seeds * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_BYTE = _odd(256, 1 << 32)
_PLACE = _odd(_POSITIONS, 1 << 40)
_WORD = _odd(64, 1 << 48)
_SHORT = _odd(64, 1 << 56)


def _word_hashes(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of each whitespace-separated word."""
    data = np.frombuffer(block, np.uint8)
    space = _SPACE[data]
    start = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(start):
        return start, np.zeros(0, np.uint64)
    end = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
    length = end - start
    inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    place = _PLACE[inner & (_POSITIONS - 1)]
    if length.max() > _POSITIONS:  # later stretches of a huge word get other factors
        place = place * mix64((inner // _POSITIONS + 1).astype(np.uint64))
    values = _BYTE[data[~space]] * place
    first = np.cumsum(length) - length
    return start, mix64(np.add.reduceat(values, first) + length.astype(np.uint64))


def _pieces(text: bytes) -> Iterator[bytes]:
    """A very long text in blocks that end at white space."""
    at = 0
    while at < len(text):
        to = at + _BLOCK
        while to < len(text) and not _SPACE[text[to]]:
            to += 1
        yield text[at:to]
        at = to


def words_of(texts: Iterable[bytes]) -> Iterator[np.ndarray]:
    """The word hashes of each text, ASCII letters lower-cased, in order."""
    for run in chunks_of_texts(texts, _BLOCK):
        if len(run) == 1:
            parts = [_word_hashes(p.lower())[1] for p in _pieces(run[0])]
            yield np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            continue
        start, hashes = _word_hashes(b" ".join(run).lower())
        ends = np.cumsum([len(t) + 1 for t in run])
        yield from np.split(hashes, np.searchsorted(start, ends[:-1]))


def shingle_sets(texts: Iterable[bytes], k: int) -> Iterator[np.ndarray]:
    """Each text's distinct k-word shingles as a sorted uint64 array; without words, empty.

    Fewer than k words count as one shingle of the whole sequence.
    """
    if not 1 <= k <= len(_WORD):
        raise ValueError("k out of range")
    for words in words_of(texts):
        n = len(words)
        if n == 0:
            yield words
        elif n < k:
            yield mix64(np.sum(words * _WORD[:n], keepdims=True) + _SHORT[n])
        else:
            total = np.zeros(n - k + 1, np.uint64)
            for i in range(k):
                total += words[i : n - k + 1 + i] * _WORD[i]
            yield np.unique(mix64(total))
