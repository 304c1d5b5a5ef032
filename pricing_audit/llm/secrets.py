"""Secrets in texts: fixed patterns, and a battery of randomness tests with false-discovery control.

Everything is column expressions over the row, so no text is shuffled and no Python runs.

Battery. Every run of 20 or more key characters is a candidate, and so are the parts of that length
between its separators. The encoding is inferred from the kinds of characters present (decimal,
hexadecimal, base 32, letters, base 36, base 62, base 64), and three tests ask whether it
looks like uniform symbols of that alphabet: chi-squared on the symbol counts, the runs test on symbols
below and above the alphabet's middle, and the serial correlation of neighbouring symbols. A candidate
that any of them rejects (Bonferroni over the three, at ``REJECT``) is not random.

Evidence. A short word can look uniform by chance, so each candidate also gets a p-value under the
opposite hypothesis, that it is written language or an identifier: repeats of symbols as frequent as in
language, few changes between letter cases, digits and signs, and, for hexadecimal, letters that happen
to stay below g. The three are joined by Fisher's rule. Within each class of lengths the procedure of
Benjamini and Hochberg, over all candidates of the corpus, decides which are discoveries, so
the many short words don't cost the long keys their power. It works on binned logarithms (``BINS`` a
decade, rounded towards 1, so never bolder than the plain procedure), which keeps its table small.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import spread, stage
from .common import whole_text

#: Kinds in their order, with the pattern of each; a match must also pass its test below.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"


def _part(inner: str, separators: str, ending: str = "") -> str:
    """Whole runs of 20 or more characters with a separator on at least one side."""
    run = f"[{inner}]{{20,}}+{ending}"
    return f"(?<=[{separators}]){run}|(?<![A-Za-z0-9+/_-]){run}(?=[{separators}])"


#: Parts of a candidate, with a character each must have: so no part comes twice.
PARTS = (
    (_part("A-Za-z0-9", "+/_-"), ""),
    (_part("A-Za-z0-9_-", "+/"), "[_-]"),
    (_part("A-Za-z0-9+/", "_-", "={0,2}"), "[+/]"),
)

REJECT = 1e-3  # of the battery
FALSE_DISCOVERIES = 0.01
BINS, LAST_BIN = 50, 15_000
LENGTHS = (20, 24, 32, 48, 64)  # first length of each class
#: Written language: chance that two letters agree, that three agree, that the next character is of
#: another kind (identifiers included), and that a character is a digit or one of a to f.
LANGUAGE_PAIR, LANGUAGE_TRIPLE, LANGUAGE_CHANGE, LANGUAGE_HEX = 0.066, 0.0057, 0.15, 0.3
#: Alphabets in code order, by the pattern of the strings that use nothing else.
ENCODINGS = (
    ("[0-9]+", "0123456789"),
    ("[0-9a-f]+", "0123456789abcdef"),
    ("[0-9A-F]+", "0123456789ABCDEF"),
    ("[A-Z]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("[a-z]+", "abcdefghijklmnopqrstuvwxyz"),
    ("[A-Z2-7]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("[a-z2-7]+", "abcdefghijklmnopqrstuvwxyz234567"),
    ("[A-Z0-9]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("[a-z0-9]+", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("[A-Za-z]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("[A-Za-z0-9]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    (".*", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
_BLOCK = 256
_SPANS = "array<struct<start: bigint, kind: int, end: bigint>>"
_FOUND = "array<struct<start: bigint, end: bigint, lengths: int, bin: int, random: boolean, family: int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def prefix_sums(values: Column) -> Column:
    """For each element the sum of those before it; in blocks, so long arrays stay cheap."""

    def running(numbers: Column) -> Column:
        return F.aggregate(
            numbers, F.array(F.lit(0).cast("long")),
            lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)),
        )

    def joined(blocks: Column) -> Column:
        before = running(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return F.flatten(
            F.zip_with(
                blocks, F.slice(before, F.lit(1), F.size(blocks)),
                lambda b, at: F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda x: x + at),
            )
        )

    starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int"))
    blocks = F.transform(starts, lambda i: running(F.slice(values, i * _BLOCK + 1, F.lit(_BLOCK))))
    empty = F.array().cast("array<bigint>")
    return F.when(F.size(values) > 0, let(blocks, joined)).otherwise(empty)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points."""

    def place(x: Column) -> Column:
        gaps = F.transform(x["parts"], lambda p: F.length(p))
        sizes = F.transform(x["hits"], lambda h: F.length(h))
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(sizes)), sizes, lambda g, s: g + s)
        return F.zip_with(
            F.zip_with(prefix_sums(steps), F.slice(gaps, F.lit(1), F.size(sizes)), lambda b, g: b + g),
            x["hits"],
            lambda start, hit: F.struct(
                start.cast("long").alias("start"), (start + F.length(hit)).cast("long").alias("end"),
                hit.alias("value"),
            ),
        )

    both = F.struct(
        F.split(text, pattern, -1).alias("parts"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
    )
    empty = F.array().cast("array<struct<start: bigint, end: bigint, value: string>>")
    return F.when(text.rlike(pattern), let(both, place)).otherwise(empty)


def base_spans(text: Column) -> Column:
    """The pattern spans by start, then kind."""

    def of(kind: int, pattern: str, passes: Callable[[Column], Column] | None = None) -> Column:
        found = matches(text, pattern)
        if passes is not None:
            found = F.filter(found, lambda m: passes(m["value"]))
        return F.transform(
            found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
        )

    return F.array_sort(
        F.concat(
            of(0, ASSIGN, lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= 6),
            of(1, ACCESS), of(2, HEX),
        )
    ).cast(_SPANS)


def _ln_upper(z: Column) -> Column:
    """Natural logarithm of the normal distribution's upper tail, within 0.3 % of the tail."""

    def tail(x: Column) -> Column:
        return -x * x / 2 - math.log(math.sqrt(2 * math.pi)) - F.log(
            0.661 * x + 0.339 * F.sqrt(x * x + 5.51)
        )

    return F.when(z >= 0, tail(F.abs(z))).otherwise(F.log1p(-F.exp(F.least(tail(F.abs(z)), F.lit(-1e-12)))))


def _tests(codes: Column, kinds: Column, alphabet: Column, hexadecimal: Column) -> Column:
    """struct<ln_language, random> of a candidate given its symbols' places in the alphabet."""
    middle, spread_ = (alphabet - 1) / 2, (alphabet * alphabet - 1) / 12

    def squares(x: Column) -> Column:
        start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0).cast("long").alias("sum"))
        return F.aggregate(
            F.array_sort(x), start,
            lambda a, v: let(
                F.when(a["last"] == v, a["run"]).otherwise(0) + 1,
                lambda run: F.struct(
                    v.alias("last"), run.alias("run"), (a["sum"] + 2 * run - 1).cast("long").alias("sum")
                ),
            ),
            lambda a: a["sum"],
        )

    def in_order(x: Column) -> Column:
        start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("runs"), F.lit(0.0).alias("serial"))
        return F.aggregate(
            x, start,
            lambda a, v: F.struct(
                v.alias("last"),
                (
                    a["runs"] + F.when((a["last"] >= 0) & ((a["last"] > middle) == (v > middle)), 0).otherwise(1)
                ).alias("runs"),
                (
                    a["serial"] + F.when(a["last"] < 0, 0.0).otherwise((a["last"] - middle) * (v - middle))
                ).alias("serial"),
            ),
        )

    def judged(s: Column) -> Column:
        n, sums, order, changes = s["n"], s["sums"], s["order"], s["changes"]
        chi = alphabet / n * sums - n
        z_chi = (chi - (alphabet - 1)) / F.sqrt(2 * (alphabet - 1) * (n - 1) / n)
        z_runs = (order["runs"] - 1 - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        z_serial = order["serial"] / (spread_ * F.sqrt(n - 1))
        worst = F.greatest(F.abs(z_chi), F.abs(z_runs), F.abs(z_serial))
        random = _ln_upper(worst) + math.log(2 * 3) > math.log(REJECT)
        pairs = n * (n - 1) / 2
        varies = (
            pairs * LANGUAGE_PAIR * (1 - LANGUAGE_PAIR)
            + n * (n - 1) * (n - 2) * (LANGUAGE_TRIPLE - LANGUAGE_PAIR**2)
        )
        repeats = _ln_upper(-((sums - n) / 2 - pairs * LANGUAGE_PAIR) / F.sqrt(varies))
        switch = LANGUAGE_CHANGE * (1 - LANGUAGE_CHANGE)
        switches = _ln_upper((changes - (n - 1) * LANGUAGE_CHANGE) / F.sqrt((n - 1) * switch))
        letters = n * F.when(hexadecimal, math.log(LANGUAGE_HEX)).otherwise(0.0)
        q = F.least(repeats + switches + letters, F.lit(0.0))
        return F.struct((q + F.log(1 - q + q * q / 2)).alias("ln_language"), random.alias("random"))

    changes = F.aggregate(
        kinds, F.struct(F.lit("").alias("last"), F.lit(-1).alias("n")),
        lambda a, k: F.struct(k.alias("last"), (a["n"] + F.when(a["last"] == k, 0).otherwise(1)).alias("n")),
        lambda a: a["n"],
    )
    return let(
        F.struct(
            F.size(codes).cast("double").alias("n"), squares(codes).alias("sums"),
            in_order(codes).alias("order"), changes.alias("changes"),
        ),
        judged,
    )


def _battery(value: Column) -> Column:
    """struct<ln_language, random> of one candidate string."""
    plain = F.translate(F.rtrim(value, F.lit("=")), "-_", "+/")
    letters = F.array(*[F.lit(alphabet) for _, alphabet in ENCODINGS])

    def encoding(s: Column) -> Column:
        chosen = F.when(s.rlike(f"^(?:{ENCODINGS[0][0]})$"), 1)
        for i, (pattern, _) in enumerate(ENCODINGS[1:], 2):
            chosen = chosen.when(s.rlike(f"^(?:{pattern})$"), i)
        return chosen

    def tested(x: Column) -> Column:
        signs = F.split(x["s"], "")
        kinds = F.transform(
            signs,
            lambda c: F.when(c.between("0", "9"), "d").when(c.between("A", "Z"), "u")
            .when(c.between("a", "z"), "l").otherwise("s"),
        )
        codes = F.transform(signs, lambda c: F.call_function("locate", c, x["alphabet"]) - 1)
        hexadecimal = F.lower(x["alphabet"]) == ENCODINGS[1][1]
        return _tests(codes, kinds, F.length(x["alphabet"]).cast("double"), hexadecimal)

    named = let(
        plain, lambda s: F.struct(s.alias("s"), F.element_at(letters, encoding(s)).alias("alphabet"))
    )
    return let(named, tested)


def candidates(text: Column) -> Column:
    """Each candidate's place, length class, binned evidence and whether the battery lets it pass."""

    def judged(m: Column) -> Column:
        size = m["end"] - m["start"]
        lengths = sum((F.when(size >= first, 1).otherwise(0) for first in LENGTHS[1:]), F.lit(0))
        return let(
            _battery(m["value"]),
            lambda t: F.struct(
                m["start"].alias("start"), m["end"].alias("end"), lengths.cast("int").alias("lengths"),
                F.least(
                    F.floor(-t["ln_language"] / math.log(10) * BINS + 1e-9), F.lit(LAST_BIN)
                ).cast("int").alias("bin"),
                t["random"].alias("random"), m["family"].alias("family"),
            ),
        )

    found = []
    for family, (pattern, needed) in enumerate(((CANDIDATE, ""), *PARTS)):
        hits = matches(text, pattern)
        if needed:
            hits = F.filter(hits, lambda m: m["value"].rlike(needed))  # noqa: B023
        found.append(F.transform(hits, lambda m: m.withField("family", F.lit(family))))  # noqa: B023
    return F.transform(F.concat(*found), judged).cast(_FOUND)


def discovery_bins(found: DataFrame) -> dict[int, int]:
    """Per length class the least bin of evidence that is a discovery; classes without any are left
    out. ``found`` has a column of ``candidates``; five rows at most come back."""
    binned = found.select(F.explode("found").alias("c")).groupBy("c.lengths", "c.bin").count()
    by_class = Window.partitionBy("lengths")
    above = by_class.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = binned.select(
        "lengths", "bin", F.sum("count").over(above).alias("k"), F.sum("count").over(by_class).alias("m")
    )
    passed = ranked.filter(
        -F.col("bin") / BINS <= math.log10(FALSE_DISCOVERIES) + F.log10(F.col("k") / F.col("m"))
    )
    rows = passed.groupBy("lengths").agg(F.min("bin").alias("bin")).collect()
    return {r["lengths"]: r["bin"] for r in rows}


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )


def covered(spans: Column, groups: int, c: Column, longer: bool = False) -> Column:
    """Whether one of ``spans`` (an array of as many arrays as ``groups``) covers ``c``, with ``longer``
    whether a longer one does. Each group is sorted and without overlaps, so only its last span that starts
    no later can; it is found by halving, however many spans a text has."""

    def last(own: Column) -> Column:
        most = F.ceil(F.log2(F.size(own) + 1)).cast("int")
        steps = F.transform(F.sequence(most, F.lit(0)), lambda i: F.call_function("shiftleft", F.lit(1), i))
        started = F.aggregate(
            steps, F.lit(0),
            lambda n, step: F.when(F.get(own, n + step - 1)["start"] <= c["start"], n + step).otherwise(n),
        )
        return F.get(own, started - 1)

    def covers(d: Column) -> Column:
        found = d["end"] >= c["end"]
        if longer:
            found = found & (d["end"] - d["start"] > c["end"] - c["start"])
        return F.coalesce(found, F.lit(False))

    return reduce(Column.__or__, [let(last(spans[i]), covers) for i in range(groups)])


def _grouped(spans: str, group: str, groups: int) -> Column:
    return F.array(*[F.filter(spans, lambda s: s[group] == i) for i in range(groups)])  # noqa: B023


def secret_spans(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, base and spans (arrays of start, kind, end; kinds numbered as ``KINDS``).

    ``spans`` has the base spans and the random ones that lie in no base span and no longer random
    one. A null or empty text
    has none. Every row gets a row, repeated ids and null ids too; a repeated row counts as a candidate
    as often as it occurs. Empty input gives no rows. Only doc_id and text are read.
    """
    texts = spread(docs.select("doc_id", "text")).select("doc_id", whole_text().alias("text"))
    found = stage(
        texts.select("doc_id", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("found")),
        "secret-candidates",
    )
    least = discovery_bins(found)

    kinds, families = 3, 1 + len(PARTS)

    def passes(c: Column) -> Column:
        bars = F.array(*[F.lit(least.get(i, LAST_BIN + 1)) for i in range(len(LENGTHS))])
        return c["random"] & (c["bin"] >= F.element_at(bars, c["lengths"] + 1))

    passed = found.select(
        "doc_id", "base", F.filter("found", passes).alias("passed"),
        _grouped("base", "kind", kinds).alias("kinds"),
    )
    passed = passed.withColumn(
        "passed", F.filter("passed", lambda c: ~covered(F.col("kinds"), kinds, c))
    ).withColumn("families", _grouped("passed", "family", families))
    random = F.transform(
        F.filter("passed", lambda c: ~covered(F.col("families"), families, c, longer=True)),
        lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")),
    ).cast(_SPANS)
    return passed.select("doc_id", "base", F.array_sort(F.concat("base", random)).alias("spans"))


def secret_table(docs: DataFrame) -> DataFrame:
    """Per document: counts per base kind, the digest of the base spans, and all spans as text."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return secret_spans(docs).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == 3)).cast("long").alias("n_random"),
    )
