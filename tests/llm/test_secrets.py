from __future__ import annotations

import base64
import hashlib
import math
import random
import re

from tables import documents as documents
from pricing_audit.llm import secrets
from pyspark.sql import functions as F

ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def joined(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def natural(rng, n):
    return "".join(rng.choice(["the", "ing", "on", "er", "tion", "st"]) for _ in range(n))


def test_base_spans_equal_python(spark, documents):
    rng = random.Random(3)
    parts = ["token", "api_key", "APIKEY", "passwd", "=", ":", " ", "'", '"', "abcdef", "x1", "AKIA",
             "ABCDEFGH12345678", "0123456789ab", "é", "\U0001F600", "\n", "secret", "ſecret=abcdefg"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "token = a " * 700 + "token = abcdefg " * 700)]
    got = {r.doc_id: r for r in secrets.secret_table(documents(rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = base(text)
        assert got[i].base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest(), text
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(
            sum(k == kind for _, k, _ in want) for kind in range(3)
        )


def plain_battery(text):
    """ln of the language p-value, and whether the battery lets the string pass."""
    s = text.rstrip("=").replace("-", "+").replace("_", "/")
    alphabet = next(a for p, a in secrets.ENCODINGS if re.fullmatch(p, s))
    a, n, codes = len(alphabet), len(s), [alphabet.index(c) for c in s]
    kind = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in s]
    squares = sum(s.count(c) ** 2 for c in set(s))
    middle = (a - 1) / 2
    chi = a / n * squares - n
    runs = 1 + sum((x > middle) != (y > middle) for x, y in zip(codes, codes[1:], strict=False))
    serial = sum((x - middle) * (y - middle) for x, y in zip(codes, codes[1:], strict=False))
    z = [
        (chi - (a - 1)) / math.sqrt(2 * (a - 1) * (n - 1) / n),
        (runs - 1 - (n - 1) / 2) / math.sqrt((n - 1) / 4),
        serial / ((a * a - 1) / 12 * math.sqrt(n - 1)),
    ]
    upper = lambda x: math.log(math.erfc(x / math.sqrt(2)) / 2) if x < 37 else -700.0
    random_like = upper(max(map(abs, z))) + math.log(6) > math.log(secrets.REJECT)
    pair, triple, change = secrets.LANGUAGE_PAIR, secrets.LANGUAGE_TRIPLE, secrets.LANGUAGE_CHANGE
    pairs = n * (n - 1) / 2
    varies = pairs * pair * (1 - pair) + n * (n - 1) * (n - 2) * (triple - pair**2)
    changes = sum(x != y for x, y in zip(kind, kind[1:], strict=False))
    q = upper(-((squares - n) / 2 - pairs * pair) / math.sqrt(varies))
    q += upper((changes - (n - 1) * change) / math.sqrt((n - 1) * change * (1 - change)))
    q += n * math.log(secrets.LANGUAGE_HEX) if alphabet.lower() == "0123456789abcdef" else 0
    return q + math.log(1 - q + q * q / 2), random_like


def test_battery_equals_plain_formulas(spark):
    rng = random.Random(9)
    values = [base64.b64encode(rng.randbytes(rng.randint(18, 60))).decode() for _ in range(60)]
    values += [rng.randbytes(16).hex(), rng.randbytes(16).hex().upper(), "1" * 25, "A" * 30, "ABCDE23457" * 3]
    values += [natural(rng, rng.randint(8, 12)) for _ in range(40)] + ["get-user_by/long-path-of-words"]
    table = spark.createDataFrame([(v,) for v in values], "v string")
    for v, b in table.select("v", secrets._battery(F.col("v"))).collect():
        ln, random_like = plain_battery(v)
        assert abs(b[0] - ln) <= 0.01 + 0.005 * abs(ln), v
        assert b[1] == random_like, v


def test_discoveries_follow_benjamini_hochberg(spark):
    """Against the plain procedure on p-values rounded up to their bins."""
    rng = random.Random(1)
    found = [(rng.randrange(5), int(rng.expovariate(1 / 60))) for _ in range(4000)]
    table = spark.createDataFrame([([(0, 30, c, b, True, 0)],) for c, b in found], f"found {secrets._FOUND}")
    got = secrets.discovery_bins(table)
    for c in range(5):
        bins = sorted((b for x, b in found if x == c), reverse=True)
        passing = [
            b for k, b in enumerate(bins, 1)
            if 10 ** (-b / secrets.BINS) <= secrets.FALSE_DISCOVERIES * k / len(bins) * (1 + 1e-12)
        ]
        assert got.get(c) == (min(passing) if passing else None)


def test_keys_found_words_left_alone(documents):
    rng = random.Random(5)
    rows = [(i, f"see {base64.b64encode(rng.randbytes(33)).decode()} ok") for i in range(40)]
    rows += [(100 + i, " ".join(natural(rng, 9) for _ in range(30))) for i in range(100)]
    rows += [(300, "deadbeef" * 3)]
    got = {r.doc_id: r for r in secrets.secret_table(documents(rows)).collect()}
    assert sum(got[i].n_random for i in range(40)) >= 38
    assert not any(got[100 + i].n_random for i in range(100))
    assert got[0].spans.startswith("random:4:")
    assert got[300].spans == "hex:0:24"  # a span inside a base span is not repeated


def test_uniform_keys_of_any_alphabet_pass(spark):
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    rng, n = random.Random(11), 100
    kinds = [lower + digits, upper + digits, lower + "234567", upper + "234567", lower, upper, lower + upper]
    values = [
        (i, "".join(rng.choices(letters, k=size)))
        for i, letters in enumerate([*kinds, lower + upper + digits]) for size in (32, 48, 64, 100) for _ in range(n)
    ]
    table = spark.createDataFrame(values, "i int, v string")
    passed = table.groupBy("i", F.length("v").alias("size")).agg(F.sum(secrets._battery(F.col("v"))["random"].cast("int")).alias("k"))
    assert all(r.k >= 0.95 * n for r in passed.collect())


def test_keys_between_separators(documents):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    path = "/static/assets/download/file/"
    rows = [(i, f"see {path}{''.join(rng.choices(letters, k=40))} ok") for i in range(30)]
    rows += [(100 + i, "k_" + "".join(rng.choices(letters[:26] + letters[52:], k=48))) for i in range(30)]
    got = {r.doc_id: r for r in secrets.secret_table(documents(rows)).collect()}
    end = 4 + len(path) + 40
    assert sum(any(s.endswith(f":{end}") for s in got[i].spans.split(",")) for i in range(30)) >= 27
    assert sum(got[100 + i].n_random == 1 for i in range(30)) >= 27


def test_empty_table(documents):
    assert secrets.secret_table(documents([])).count() == 0


def test_prefix_sums_of_long_arrays(spark):
    n = 3000
    row = spark.range(1).select(secrets.prefix_sums(F.sequence(F.lit(1), F.lit(n))).alias("s")).first()
    assert row.s == [i * (i + 1) // 2 for i in range(n)]


def test_covered_equals_all_comparisons(spark):
    rng, rows = random.Random(8), []
    for i in range(300):
        groups = []
        for _ in range(3):
            cuts = sorted(rng.sample(range(60), 2 * rng.randint(0, 8)))
            groups.append(list(zip(cuts[::2], cuts[1::2], strict=True)))
        start = rng.randrange(60)
        rows.append((i, groups, (start, start + rng.randint(1, 9))))
    spans = "struct<start: bigint, end: bigint>"
    table = spark.createDataFrame(rows, f"i int, g array<array<{spans}>>, c {spans}")
    got = table.select(
        "i", secrets.covered(F.col("g"), 3, F.col("c")).alias("any"),
        secrets.covered(F.col("g"), 3, F.col("c"), longer=True).alias("longer"),
    ).collect()
    flat = [(i, [d for g in groups for d in g], c) for i, groups, c in rows]
    over = {i: [d for d in spans if d[0] <= c[0] and c[1] <= d[1]] for i, spans, c in flat}
    size = {i: c[1] - c[0] for i, _, c in flat}
    assert {r.i: r.any for r in got} == {i: bool(x) for i, x in over.items()}
    assert {r.i: r.longer for r in got} == {i: any(b - a > size[i] for a, b in x) for i, x in over.items()}


def test_many_keys_in_one_text_and_odd_rows(documents):
    rng, n = random.Random(9), 3000
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    key = lambda: "".join(rng.choices(letters, k=40))
    full = " ".join(key() for _ in range(n))
    mixed = " ".join(f"token={key()} /{key()}" for _ in range(500))
    rows = [(1, full), (1, full), (None, full), (2, mixed), (3, None), (3, ""), (None, None)]
    got = sorted((str(r.doc_id), r.n_assign, r.n_random, r.spans) for r in secrets.secret_table(documents(rows)).collect())
    assert [g[:2] for g in got] == [("1", 0), ("1", 0), ("2", 500), ("3", 0), ("3", 0), ("None", 0), ("None", 0)]
    assert got[0] == got[1] and got[0][2] >= 0.95 * n and got[6][2:] == got[0][2:]
    assert got[2][2] >= 0.95 * 500 and got[2][3].count("assign") == 500
    assert got[3][2:] == got[4][2:] == got[5][2:] == (0, "")
