from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tables import documents as documents
from pricing_audit.llm import files, packing, token_files, tokens
from pricing_audit.session import scratch_path
from tokenizers import Tokenizer

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"
ODD = [
    "", " ", "\n", "a  b", "a \n b\xa0c", "\xa0\xa0 x", "  <|endoftext|>  x", "x<|startoftext|> y", " lead",
    "trail  ", "é ́x", "I'M don't 123 45", "\x1c a\x1cb", "ΟΔΟΣ Σ", "a b　c", "\x01\x02 a\n\x01",
    "a\r\nb\t\tc", "İstanbul ſ", "line\nnext line\n\nthird\n", "\U0001F600\U0001F600 ok", "x" * 30_000,
]


def library(name, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", [WORDS, BYTES])
@pytest.mark.parametrize("kept", [0, 50, 100_000])
def test_chunked_ids_equal_the_library(name, kept, monkeypatch):
    monkeypatch.setattr(tokens, "RUN_BYTES", 200)
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choices(["a", "Bc", " ", "\n", "'s", "é", "7", "!", "\xa0", "_"], k=40)) for _ in range(400)]
    encoder = tokens.Encoder(name, kept)
    for _ in range(2):
        assert [x.tolist() for x in encoder.ids(pa.array(texts, pa.string()))] == library(name, texts)


@pytest.mark.parametrize("name", [WORDS, BYTES])
def test_encoding_many_texts_takes_little_memory(name):
    """Room follows a block of texts, not all that are encoded together."""
    words = pa.array(["a bc d e f g h i " * 2500] * 300 + ["", "z" * 10 + " z" * 300_000])
    encoder = tokens.Encoder(name)
    tracemalloc.start()
    found = [(len(ids), zlib.crc32(ids.tobytes())) for ids in encoder.ids(words)]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ids = [np.array(i, encoder.dtype) for i in library(name, [words[0].as_py(), words[-1].as_py()])]
    first, last = [(len(i), zlib.crc32(i.tobytes())) for i in ids]
    assert found == [first] * 300 + [(0, 0), last]
    assert most < 50 << 20


@pytest.mark.parametrize("highest", [1, 300, 70_000, 1 << 24, (1 << 32) - 1])
def test_blocks_round_trip(highest):
    rng = np.random.default_rng(highest)
    for n in (1, 3, 4, 5, 5000):
        ids = (rng.random(n) ** 3 * highest).astype("<u4")
        assert (token_files.decode_block(token_files.encode_block(ids)) == ids).all()


def test_frequent_ids_take_one_byte():
    ids = np.array([60_000] * 1000 + [5] * 10 + list(range(100, 500)), "<u4")
    block = token_files.encode_block(ids)
    spare = 12 + 4 * len(set(ids.tolist())) + -(-len(ids) // 4)
    assert len(block) - spare == len(ids) + len(set(ids.tolist())) - 256


def test_documents_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 7)
    path = scratch_path(spark, "token-test") + "/x.frv"
    docs = [(3, [1] * 20), (None, []), (9, list(range(6))), (9, [70_000, 2])]
    writer = token_files.Writer(path)
    for name, ids in docs:
        writer.add(name, np.array(ids, "<u4"))
    assert writer.close() == (path, 4, 28)
    read = [(name, [i for part in parts for i in part.tolist()]) for name, parts in token_files.read_file(path)]
    assert read == docs
    with files.open_write(path + "2") as f:
        f.write(b"FRV1" + b"x" * 30)
    with pytest.raises(ValueError):
        list(token_files.read_file(path + "2"))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_table_equals_the_library(documents):
    rows = [(i * 7 % 100, t) for i, t in enumerate(ODD)] + [(50, None), (None, "last one"), (50, "again")]
    got = [tuple(r) for r in token_files.token_table(documents(rows), WORDS, 1).collect()]
    ids = library(WORDS, [t or "" for _, t in rows])
    assert len(got) == len(rows)
    by_place = sorted(got, key=lambda r: r[1])
    names = [r[0] for r in by_place]
    assert names == sorted((i for i, _ in rows if i is not None)) + [None]
    assert [r[1] for r in by_place] == np.cumsum([0] + [r[2] for r in by_place[:-1]]).tolist()
    assert sorted((r[0] is None, r[0] or 0, r[2], r[3]) for r in got) == sorted(
        (i is None, i or 0, len(x) + 1, crc([*x, 1])) for (i, _), x in zip(rows, ids, strict=True)
    )


def test_hot_and_null_ids_are_dealt_over_files(documents, monkeypatch):
    monkeypatch.setattr(token_files, "BYTES_PER_FILE", 200)
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"text number {i}") for i in range(120)]
    folder = scratch_path(documents([]).sparkSession, "token-hot")
    written = token_files.write_tokens(documents(rows), folder, WORDS, 1)
    assert max(r["docs"] for r in written.collect()) <= 40
    got = token_files.read_tokens(written).collect()
    assert len(got) == 120 and sorted(r["start"] for r in got)[0] == 0


def test_empty_table(documents):
    assert token_files.token_table(documents([])).count() == 0
    assert packing.pack_documents(documents([])).count() == 0


def test_cut_points():
    assert packing.cut_points(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut_points(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut_points(4, 4) == [(0, 4)]
    assert packing.cut_points(1, 4) == [(0, 1)]


def slow_squares(lengths, capacity):
    """The same rule with all choices spelled out."""
    gaps, where, offset = [], [], []
    for size in lengths:
        best = None
        for gap in sorted({g for g in gaps if g >= size}):
            after = gaps.copy()
            after[after.index(gap)] -= size
            cost = sum(after.count(g) ** 2 for g in set(after) - {0})
            if best is None or cost < best[0]:
                best = (cost, gap)
        if best is None:
            gaps.append(capacity)
            at = len(gaps) - 1
        else:
            at = max(i for i, g in enumerate(gaps) if g == best[1])
        where.append(at)
        offset.append(capacity - gaps[at])
        gaps[at] -= size
    return gaps


def test_sum_of_squares_follows_the_rule():
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 30, 200))[::-1]
    where, offset = packing.sum_of_squares(lengths, 32)
    left = np.full(where.max() + 1, 32)
    for w, o, n in zip(where, offset, lengths, strict=True):
        assert o == 32 - left[w]
        left[w] -= n
    assert (left >= 0).all()
    assert sorted(left.tolist()) == sorted(slow_squares(lengths.tolist(), 32))


def test_packing_places_every_token_once(spark, documents):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "x"]) for _ in range(rng.randint(0, 120)))) for i in range(200)]
    rows += [(5, "again"), (None, None), (300, "long " * 5000)]
    pieces = packing.pieces(documents(rows), BYTES, 2, 64, with_ids=True)
    packed = packing.pack(pieces, 64)
    got = packed.collect()
    want = []
    for (i, _), ids in zip(rows, library(BYTES, [t or "" for _, t in rows]), strict=True):
        ids = [*ids, 2]
        for n, (at, size) in enumerate(packing.cut_points(len(ids), 64)):
            want.append((i is None, i or 0, n, at, size, crc(ids[at : at + size])))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(places) <= -(-total // 64) * 1.02 + 1
    for row in packing.sequences(packed).limit(5).collect():
        assert len(row.ids) == 4 * sum(length for _, length in places[row.sequence_id])
