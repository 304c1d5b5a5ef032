"""Token ids of whole texts by a tokenizers file, exact but with repeated chunks encoded once.

A text is cut where the tokenizer's own rules never join anything, so the ids of the chunks in order
are the ids of the text. Arrow splits the texts and finds the distinct chunks of a run of documents;
chunks seen before come from a bounded table in the worker, the others go to the tokenizer.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 23
KEPT_CHUNKS = 400_000
ENCODED_AT_ONCE = 2048
EXPANDED_AT_ONCE = 1 << 16

_W = r" \t\n\r\x0b\f"
_SPACED = re.compile(rf" ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]+")
# White space beyond ASCII's, for which cutting between words is not proven to keep the ids.
_WIDE = r"\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WIDE_SPACE = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), _WIDE) + "]")
# Texts that are not words with one space or line end between them take the slower way.
_UNEVEN = rf"[\t\r\x0b\f\x01\x02{_WIDE}]|[ \n][ \n]|\A[ \n]|[ \n]\z|\A\z"
_FIRST, _LINE = "\x02", "\x01"


def tokenizer_file(name: str) -> str:
    """A path as it is, or the name of one of the installed public vocabularies."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _runs(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Slices of about ``size`` bytes; a longer text comes alone."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, before + size, "right")), at + 1)
        yield texts.slice(at, to - at)
        at = to


class Encoder:
    """ids(texts) gives the ids of each text of an Arrow string array without nulls."""

    def __init__(self, name: str, kept: int = KEPT_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = tokenizer_file(name)
        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        self._special = [t["content"] for t in rules.get("added_tokens") or []]
        small = self._tokenizer.get_vocab_size() <= 1 << 16
        self._code, self.dtype = ("H", np.dtype("<u2")) if small else ("I", np.dtype("<u4"))
        self._way = self._rule(rules)
        self._kept = kept
        self._seen: dict[str, bytes] = {}

    @staticmethod
    def _rule(rules: dict) -> str:
        """How texts may be cut: "words" where white space is dropped, "spaced" where one space
        belongs to the word behind it, "whole" where the file's rules are not known to allow it."""
        pre = rules.get("pre_tokenizer") or {}
        if rules.get("post_processor") is None and pre.get("type") == "Sequence":
            first = pre["pretokenizers"][0]
            pattern = first.get("pattern", {}).get("Regex", "")
            normal = (rules.get("normalizer") or {}).get("normalizers", [])
            if (
                first.get("behavior") == "Removed" and first.get("invert") and r"[^\s" in pattern
                and {n["type"] for n in normal} <= {"NFC", "Replace", "Lowercase"}
            ):
                return "words"
        if (
            rules.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and pre.get("use_regex") and not pre.get("add_prefix_space")
        ):
            return "spaced"
        return "whole"

    def _cut(self, text: str) -> list[str]:
        if self._way == "whole" or any(s in text for s in self._special) or _WIDE_SPACE.search(text):
            return [text]
        return _SPACED.findall(text)

    def _split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All chunks of the texts, and where each text's chunks begin (and the last end)."""
        if self._way == "words":
            parts = pc.ascii_split_whitespace(texts)
        elif self._way == "spaced":
            uneven = pc.match_substring_regex(texts, _UNEVEN)
            for special in self._special:
                uneven = pc.or_(uneven, pc.match_substring(texts, special))
            uneven = uneven.to_numpy(zero_copy_only=False)
            lines = pc.replace_substring(texts, "\n", " " + _LINE)
            parts = pc.split_pattern(pc.binary_join_element_wise(_FIRST, lines, ""), " ")
            if uneven.any():
                odd = texts.filter(pa.array(uneven))
                cut = [pa.array([[_FIRST + c for c in self._cut(t.as_py())]], parts.type) for t in odd]
                place = np.where(uneven, len(parts) + np.cumsum(uneven) - 1, np.arange(len(parts)))
                parts = pa.concat_arrays([parts, *cut]).take(pa.array(place))
        else:
            parts = pa.array([[t] for t in texts.to_pylist()], pa.list_(pa.string()))
        return parts.flatten(), parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()

    def _chunk(self, key: str) -> str:
        """The piece of text that a split part stands for."""
        if self._way != "spaced":
            return key
        if key.startswith(_FIRST):
            return key[1:]
        return "\n" + key[1:] if key.startswith(_LINE) else " " + key

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if isinstance(texts, pa.LargeStringArray):
            texts = pa.concat_arrays(pa.chunked_array([texts.cast(pa.string())]).chunks)
        for run in _runs(texts, RUN_BYTES):
            yield from self._encoded(run)

    def _encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        parts, begin = self._split(texts)
        coded = parts.dictionary_encode()
        del parts
        keys, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        seen = self._seen
        found = list(map(seen.get, keys))
        new = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(new), ENCODED_AT_ONCE):  # an encoding takes far more room than its ids
            some = new[at : at + ENCODED_AT_ONCE]
            encoded = self._tokenizer.encode_batch_fast(
                [self._chunk(keys[i]) for i in some], add_special_tokens=False
            )
            for i, one in zip(some, encoded, strict=True):
                found[i] = array(self._code, one.ids).tobytes()
        for i in new[: max(0, self._kept - len(seen))]:
            seen[keys[i]] = found[i]
        flat = np.frombuffer(b"".join(found), self.dtype)
        length = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        first = np.cumsum(length) - length
        del keys, found
        at = 0
        while at < len(begin) - 1:  # texts with about so many chunks; a longer one comes alone
            to = max(int(np.searchsorted(begin, begin[at] + EXPANDED_AT_ONCE, "right")) - 1, at + 1)
            own = which[begin[at] : begin[to]]
            many = length[own]
            ends = np.cumsum(many)
            total = int(ends[-1]) if len(ends) else 0
            out = flat[np.repeat(first[own] - (ends - many), many) + np.arange(total)]
            bounds = np.concatenate(([0], ends))[begin[at : to + 1] - begin[at]].tolist()
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                yield out[a:b]
            at = to


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """The worker's encoder for this vocabulary; its table lives as long as the worker."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]
