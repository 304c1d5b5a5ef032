from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pricing_audit.llm import files, warc
from pricing_audit.session import scratch_path

SCHEMA = "page_id long, url string, html string, payload string"
LONG = "<p>equal payload</p>" * 10
PAGES = [
    (5, "http://a/5", LONG, "x"), (2, "http://a/2", LONG, "x"), (9, None, LONG, "x"), (None, "http://a/n", LONG, "x"),
    (1, "u\r\nEvil: 1", "short", "x"), (3, "u3", "short", "x"), (4, "u4", None, "x"), (6, "u6", "é" * 60, "x"),
    (7, "u7", "WARC/1.1\r\nWARC-Type: fake\r\n\r\n\r\n\r\n" * 20, "x"), (8, "u8", "big " * 200_000, "x"), (8, "u8", "big " * 200_000, "x"),
]


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, compress):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    written = warc.write_archives(pages, scratch_path(spark, "warc-test"), compress)
    rows = warc.read_archives(written).collect()
    assert not [r.gap for r in rows if r.gap] and len(rows) == len(PAGES)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)
    want, seen = [], set()
    for i, _, html, _ in PAGES:
        data = (html or "").encode()
        first = min((p for p, _, h, _ in PAGES if h == html and p is not None), default=None)
        again = len(data) >= 100 and (i != first or i in seen)
        seen.add(i)
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=str)
    texts = {(r.page_id, r.payload.decode()) for r in rows if r.record_type == "response"}
    assert (6, "é" * 60) in texts and (4, "") in texts
    assert {r.url for r in rows if r.page_id == 1} == {"u%0D%0AEvil: 1"}


@pytest.mark.parametrize("compress", [True, False])
def test_urls_of_any_length(spark, compress):
    urls = {1: "data:" + "x" * 3_000_000, 2: "data:" + "\n" * 1_000_000, 3: "u3"}
    pages = spark.createDataFrame([(i, u, LONG, "x") for i, u in urls.items()], SCHEMA)
    rows = warc.read_archives(warc.write_archives(pages, scratch_path(spark, "warc-url"), compress)).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in rows) == [
        (1, "response", None), (2, "revisit", 1), (3, "revisit", 1)]
    assert {r.page_id: r.url for r in rows} == {i: u.replace("\n", "%0A") for i, u in urls.items()}


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert warc.archive_table(pages).count() == 0


def archive(compress, n=30):
    rng = random.Random(n)
    made = [
        warc.record("response", f"<urn:x:{i}>", rng.randbytes(rng.randint(0, 3000)), page_id=i, url=f"http://x/{i}")
        for i in range(n)
    ]
    if compress:
        def member(x):
            c = zlib.compressobj(6, zlib.DEFLATED, 31)
            return c.compress(x) + c.flush()
        made = [member(x) for x in made]
    return made


def read(data):
    found = list(warc.salvage(warc._Bytes(data)))
    gaps = [x for x in found if isinstance(x, tuple)]
    ids = [x.head.get("x-page-id", "") for x in found if not isinstance(x, tuple)]
    return [int(i) if i.isdigit() else None for i in ids], gaps


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("window", [64, 1 << 18])
def test_salvage(compress, window, monkeypatch):
    monkeypatch.setattr(warc, "WINDOW", window)
    made = archive(compress)
    data = b"".join(made)
    assert read(data) == (list(range(30)), [])
    start = [sum(map(len, made[:i])) for i in range(31)]
    rng = random.Random(7)

    k = max(range(1, 29), key=lambda i: len(made[i]))
    broken = bytearray(data)  # some bytes of the longest record's payload changed
    for at in rng.sample(range(start[k + 1] - 1000, start[k + 1] - 8), 12):
        broken[at] ^= 0x55
    ids, gaps = read(bytes(broken))
    assert ids == [i for i in range(30) if i != k]
    assert [(a, n) for a, n, _ in gaps] == [(start[k], len(made[k]))]

    ids, gaps = read(data[: start[29] + 100])  # cut in the last record
    assert ids == list(range(29)) and [(a, n) for a, n, _ in gaps] == [(start[29], 100)]

    noise = b"\x1f\x8b\x08 noise WARC/1.1\r\n more"
    ids, gaps = read(noise + data[: start[5]] + noise + data[start[5]:])
    assert ids == list(range(30)) and [(a, n) for a, n, _ in gaps] == [(0, len(noise)), (start[5] + len(noise), len(noise))]

    late = start[10] - 30
    ids, gaps = read(data[: start[4] + 40] + data[late:])  # a stretch is lost
    assert ids == [0, 1, 2, 3, *range(10, 30)] and len(gaps) == 1
    assert sum(n for _, n, _ in gaps) + sum(len(made[i]) for i in ids) == start[4] + 40 + start[30] - late


def test_random_damage_never_stops_the_reader():
    rng = random.Random(1)
    for compress in (True, False):
        data = bytearray(b"".join(archive(compress, 12)))
        for _ in range(40):
            hurt = bytearray(data)
            for _ in range(rng.randint(1, 6)):
                hurt[rng.randrange(len(hurt))] = rng.randrange(256)
            ids, gaps = read(bytes(hurt))
            assert len(ids) >= 4 and sum(n for _, n, _ in gaps) < len(hurt)
    assert read(b"") == ([], []) and read(b"no archive at all")[1] == [(0, 17, "header end")]


def test_gaps_are_logged_as_rows(spark):
    folder = scratch_path(spark, "warc-gap")
    made = archive(True, 6)
    with files.open_write(f"{folder}/a.warc.gz") as f:
        f.write(made[0] + made[1][:-20] + b"".join(made[2:]))
    rows = warc.read_archives(spark.createDataFrame([(f"{folder}/a.warc.gz",)], "path string")).collect()
    assert sorted(r.page_id for r in rows if r.gap is None) == [0, 2, 3, 4, 5]
    assert [(r.offset, r.length) for r in rows if r.gap] == [(len(made[0]), len(made[1]) - 20)]


def one_member(parts):
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(b"".join(parts)) + c.flush()


def words(n, size=2000, digest=True):
    rng = random.Random(n)
    made = [
        warc.record("response", f"<urn:x:{i}>", " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=size)).encode(), page_id=i)
        for i in range(n)
    ]
    return made if digest else [m.replace(b"WARC-Block-Digest: sha256:", b"WARC-Other: ") for m in made]


@pytest.mark.parametrize("held", [64, 1 << 22])
@pytest.mark.parametrize("window", [256, 1 << 18])
def test_bad_record_inside_a_member(window, held, monkeypatch):
    monkeypatch.setattr(warc, "WINDOW", window)
    monkeypatch.setattr(warc, "HELD", held)
    monkeypatch.setattr(warc, "INFLATE_STEP", 5000)
    monkeypatch.setattr(warc, "MARKS", 4)
    parts = words(20)
    assert read(one_member(parts)) == (list(range(20)), [])
    for bad in (0, 7, 19):
        hurt = list(parts)
        hurt[bad] = hurt[bad][:-100] + b"#" + hurt[bad][-99:]
        data = one_member(hurt)
        ids, gaps = read(data)
        begin = sum(map(len, parts[:bad]))
        assert ids == [i for i in range(20) if i != bad]
        assert gaps == [(0, len(data), f"block digest (inflated bytes {begin} to {begin + len(parts[bad])})")]
    several = parts[:2] + [b"noise"] + parts[2:4] + [b"more"] + parts[4:]
    ids, gaps = read(one_member(several) + one_member(parts[:3]))
    assert ids == [*range(20), 0, 1, 2] and len(gaps) == 2


@pytest.mark.parametrize("held", [64, 1 << 22])
@pytest.mark.parametrize("window", [256, 1 << 18])
def test_member_that_breaks_off(window, held, monkeypatch):
    monkeypatch.setattr(warc, "WINDOW", window)
    monkeypatch.setattr(warc, "HELD", held)
    parts = words(20)
    data = one_member(parts)
    for cut in (300, len(data) // 2, len(data) - 10):
        left = data[:-cut]
        whole = len(zlib.decompressobj(31).decompress(left))
        good = max(i for i in range(21) if sum(map(len, parts[:i])) <= whole)
        ids, gaps = read(left)
        saved = f"cut short ({good} records saved)" if good else "cut short"
        assert ids == list(range(good)) and gaps == [(0, len(left), saved)]
        ids, gaps = read(left + one_member(parts[:1]))
        assert ids == [*range(good), 0] and [g[:2] for g in gaps] == [(0, len(left))]


def test_error_in_the_compressed_bytes():
    parts = words(20)
    data = bytearray(one_member(parts))
    data[len(data) // 2] ^= 0xFF
    ids, gaps = read(bytes(data) + one_member(parts[:1]))
    assert len(ids) > 9 and ids[:9] == list(range(9)) and ids[-1] == 0 and len(gaps) == 1
    bare = words(20, digest=False)  # nothing vouches for records of a damaged member but their digests
    data = one_member(bare)
    assert read(data) == (list(range(20)), [])
    ids, gaps = read(data[:-300])
    assert ids == [] and gaps == [(0, len(data) - 300, "cut short")]


def test_stored_records_are_not_read_twice():
    rng = random.Random(3)
    parts = [warc.record("response", f"<urn:x:{i}>", rng.randbytes(2000), page_id=i) for i in range(10)]
    c = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = c.compress(b"".join(parts)) + c.flush()
    ids, gaps = read(data[:-900])
    assert ids == list(range(9)) and len(gaps) == 1


def test_random_damage_inside_members():
    rng = random.Random(2)
    data = one_member(words(8, 300)) + one_member(words(6, 300))
    for _ in range(60):
        hurt = bytearray(data)
        for _ in range(rng.randint(1, 3)):
            hurt[rng.randrange(len(hurt))] = rng.randrange(256)
        ids, gaps = read(bytes(hurt))
        assert len(ids) <= 14 and (len(ids) == 14 or gaps)


def test_lost_pages_are_an_error(spark):
    folder = scratch_path(spark, "warc-lost")
    made = archive(True, 6)
    with files.open_write(f"{folder}/a.warc.gz") as f:
        f.write(made[0] + made[1][:-20] + b"".join(made[2:]))
    with files.open_write(f"{folder}/b.warc.gz") as f:
        f.write(b"".join(made))
    for name in "ab":
        named = spark.createDataFrame([(f"{folder}/{name}.warc.gz", 7)], "path string, records long")
        with pytest.raises(Exception, match="can't be read|not the 7 written"):
            warc.read_archives(named, complete=True).collect()


def test_archive_table_of_odd_rows(spark):
    pages = spark.createDataFrame(
        [(i, u, h, "x", "y", 1) for i, u, h, _ in PAGES], "page_id long, url string, html string, path string, gap string, records long"
    )
    rows = warc.archive_table(pages).collect()
    assert len(rows) == len(PAGES)
    assert sorted((r.page_id, r.payload_bytes) for r in rows if r.page_id) == sorted((i, len((h or "").encode())) for i, _, h, _ in PAGES if i)
    assert [(r.record_type, r.refers_to) for r in rows if r.page_id is None] == [("revisit", 2)]
