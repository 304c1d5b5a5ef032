"""Quality rules on a text by itself, and on its lines against all other documents of its host.

Every line is normalised and hashed; a line that stands in more than a limited number of different
documents of one host (``source``) is boilerplate. Boilerplate lines are removed, and a document that
loses more than half of its words by this is rejected as depleted.

All of it is column expressions and joins. Texts stay where they lie: what is moved is one hash per
different line and document. Lines are counted after rows that agree in line and text have become one,
so a line that a third of all rows share is spread over all tasks by its texts first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage
from .common import WORD_SPACE, sized_join, whole_text
from .secrets import let

LINE_LIMIT = 10  # different documents of one host that may share a line
LEAST_WORDS = 50
SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0000000000"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WORD_SPACE), lambda w: w != "")


def lines_of(text: Column) -> Column:
    """The lines that hold a word, in order."""
    return F.filter(F.split(text, "\n"), lambda x: F.translate(x, _SPACE, "") != "")


def normal_line(line: Column) -> Column:
    """Lower-case A-Z, digits as zero, one space between words."""
    return F.translate(F.trim(F.regexp_replace(line, WORD_SPACE, " ")), _UPPER, _LOWER)


def repeat_words(words: Column) -> Column:
    """How many words stand in three-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hashes within one text: sorted with their places, equal neighbours
    are repeats; each repeated window adds the words that the repeated window before it did not hold.
    """

    def window(w: Column, i: Column) -> Column:
        return F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i"))

    def repeated(s: Column) -> Column:
        def is_twice(x: Column, k: Column) -> Column:
            before, after = F.get(s, k - 1)["h"], F.get(s, k + 1)["h"]
            return x["h"].eqNullSafe(before) | x["h"].eqNullSafe(after)

        twice = F.filter(s, is_twice)
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            places, start,
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")
            ),
            lambda acc: acc["n"],
        )

    def counted(w: Column) -> Column:
        windows = F.sort_array(
            F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: window(w, i))
        )
        return F.when(F.size(w) < 3, 0).otherwise(let(let(windows, repeated), covered))

    return let(words, counted)


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` (with a ``text``) and the rules that need no other document, in one column ``base``."""
    text = whole_text()
    removed = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    counts = let(
        words_of(text), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("repeat"))
    )
    repeats = let(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return docs.withColumn("base", F.struct(
        F.length(F.translate(text, _SPACE, "")).cast("long").alias("word_chars"),
        removed.cast("long").alias("n_symbols"), repeats.cast("long").alias("n_dup_lines"),
        counts.alias("words"),
    ))


def line_keys(host: Column, text: Column) -> Column:
    """(key, words) of each line of the text; the key is the hash of host and normalised line."""
    prefix = F.concat(F.coalesce(F.concat(F.lit("host "), host), F.lit("no host")), F.lit("\n"))
    return F.transform(
        lines_of(text),
        lambda line: F.struct(
            F.unhex(F.md5(F.concat(prefix, normal_line(line)))).alias("key"),
            F.size(words_of(line)).alias("words"),
        ),
    )


def frequent_lines(keyed: DataFrame, limit: int = LINE_LIMIT) -> DataFrame:
    """(key) of the lines that stand in more than ``limit`` different texts of one host; ``keyed`` has
    the columns ``lines`` and ``copy`` (the text's digest)."""
    return (
        keyed.select("copy", F.explode("lines.key").alias("key")).distinct()
        .groupBy("key").agg(F.count("*").alias("n_texts")).filter(F.col("n_texts") > limit)
        .select(F.col("key").alias("frequent"))
    )


def _measured(docs: DataFrame, host: str) -> DataFrame:
    """Per row of ``docs``: __row, doc_id, base, lines and copy, written once."""
    text = whole_text()
    rows = docs.select("__row", "doc_id", F.col(host).cast("string").alias("__host"), "text")
    return stage(
        base_rules(rows).select(
            "__row", "doc_id", "base", line_keys(F.col("__host"), text).alias("lines"),
            F.unhex(F.md5(text)).alias("copy"),
        ),
        "line-keys",
    )


def _judged(docs: DataFrame, host: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """The verdict on each row, and the keys of the boilerplate lines."""
    rows = _measured(docs, host)
    frequent = stage(frequent_lines(rows, limit), "frequent-lines")
    lines = rows.select("__row", F.explode("lines").alias("line")).select("__row", "line.*")
    lost = (
        sized_join(lines, frequent, [F.col("key") == F.col("frequent")], "left_semi")
        .groupBy("__row").agg(F.sum("words").alias("lost"))
    )
    n, repeat = F.col("base.words.n").cast("long"), F.col("base.words.repeat").cast("long")
    failed = (n < LEAST_WORDS) | (100 * repeat > 50 * n)
    removed = F.coalesce("lost", F.lit(0)).cast("long")
    verdict = rows.join(lost, "__row", "left").select(
        "__row", "doc_id", n.alias("n_words"), "base.word_chars", "base.n_symbols", "base.n_dup_lines",
        repeat.alias("n_repeat_words"), failed.alias("base_failed"),
        (~failed & (2 * removed <= n)).alias("kept"), removed.alias("n_removed_words"),
    )
    return verdict, frequent


def _numbered(docs: DataFrame) -> DataFrame:
    return stage(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")


def judge_documents(docs: DataFrame, host: str = "source", limit: int = LINE_LIMIT) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept and n_removed_words (words in boilerplate lines).

    A row is kept if it passes the base rules and at least half of its words stand in other lines.
    Documents of one host with equal texts count as one, so exact copies alone make no boilerplate; a
    null host is a host of its own. A null or empty text has no words and fails. Every row gets a row,
    repeated and null ids too. Empty input gives no rows. Other columns are not read.
    """
    numbered = docs.select("doc_id", host, "text").withColumn("__row", F.monotonically_increasing_id())
    return _judged(numbered, host, limit)[0].drop("__row")


def clean_documents(docs: DataFrame, host: str = "source", limit: int = LINE_LIMIT) -> DataFrame:
    """The kept rows of ``docs`` with its columns, boilerplate lines removed from ``text``.

    Texts without a boilerplate line stay as they are; the others keep their other lines in order.
    """
    rows = _numbered(docs)
    verdict, frequent = _judged(rows, host, limit)
    kept = verdict.filter("kept").select(F.col("__row").alias("__kept"), "n_removed_words")
    kept = rows.join(kept, F.col("__row") == F.col("__kept"))
    whole = kept.filter("n_removed_words = 0").select(docs.columns)
    cut = kept.filter("n_removed_words > 0")
    lines = cut.select(
        "__row", F.col(host).cast("string").alias("__host"), F.posexplode(F.split("text", "\n")).alias("at", "line")
    )
    keys = lines.select(
        "__row", "at", "line", F.get(line_keys(F.col("__host"), F.col("line")), F.lit(0))["key"].alias("key")
    )
    left = (
        sized_join(keys, frequent, [F.col("key") == F.col("frequent")], "left_anti")
        .groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("lines"))
        .select(F.col("__row").alias("__cut"), F.array_join(F.col("lines.line"), "\n").alias("__text"))
    )
    mended = cut.join(left, F.col("__row") == F.col("__cut")).withColumn("text", F.col("__text"))
    return whole.unionByName(mended.select(docs.columns))
