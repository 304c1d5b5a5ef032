"""Documents to page rows: splitting, the parse-once cache, keyword and token-budget filters."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join

# Page keywords per table and method, and the model allow-list.
STORAGE_WORDS = {
    "A": ("storage", "ambient", "refrigerat", "nitrogen", "-80", "cu.ft"),
    "B": ("storage", "ambient", "refrigerat", "nitrogen", "-80"),
}
FEE_WORDS = {
    "A": ("project initiation", "registration", "retrieval", "professional services",
          "lab services", "sample management"),
    "B": ("project initiation", "registration", "retrieval", "professional services",
          "lab services"),
}
MODELS = (
    "mistral-large2", "llama3.3-70b", "claude-4-sonnet", "llama4-maverick",
    "mistral-large", "llama3.1-70b", "llama4-scout",
)
SMALLEST_CONTEXT = 4096

PAGE_COLUMNS = ("filename", "customer_id", "page_index", "page_text", "total_pages", "parsed_at")


def split_pages(
    docs: DataFrame, lines_per_page: int = 5, parsed_at: Column | None = None
) -> DataFrame:
    """(filename, customer_id, text) to one row per page of ``lines_per_page`` lines.

    Empty lines, also trailing ones, belong to a page; a document without text has no pages. The
    whole split happens inside the row. (A filter on the text would make Spark work it out twice
    where it is computed, as from HTML; exploding NULL drops the row just as well.)
    """
    lines = F.split("text", "\n", -1)
    total = F.ceil(F.size("lines") / F.lit(lines_per_page)).cast("int")
    page_texts = F.transform(
        F.sequence(F.lit(0), F.col("total_pages") - 1),
        lambda i: F.array_join(
            F.slice("lines", i * lines_per_page + 1, F.lit(lines_per_page)), "\n"
        ),
    )
    return (
        docs.select("filename", "customer_id", lines.alias("lines"))
        .withColumn("total_pages", total)
        .select("filename", "customer_id", "total_pages",
                F.posexplode(page_texts).alias("page_index", "page_text"))
        .withColumn("parsed_at", F.current_timestamp() if parsed_at is None else parsed_at)
        .select(*PAGE_COLUMNS)
    )


def parse_files(
    files: DataFrame, parser: Callable[[bytes], Sequence[str]], parsed_at: Column | None = None
) -> DataFrame:
    """(filename, customer_id, content) to page rows through a parser of binary documents.

    The parser turns the bytes of one document into its page texts. A document it fails on gives
    one row without text, with the reason in ``error``.
    """
    schema = "filename string, customer_id string, pages array<string>, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, errors = [], []
            for content in batch["content"]:
                try:
                    texts.append([str(page) for page in parser(bytes(content))])
                    errors.append(None)
                except Exception as failure:
                    texts.append([None])
                    errors.append(f"{type(failure).__name__}: {failure}")
            yield pd.DataFrame({
                "filename": batch["filename"], "customer_id": batch["customer_id"],
                "pages": pd.Series(texts, index=batch.index, dtype=object),
                "error": pd.Series(errors, index=batch.index, dtype=object),
            })

    parsed = files.select("filename", "customer_id", "content").mapInPandas(run, schema)
    return parsed.select(
        "filename", "customer_id", F.size("pages").alias("total_pages"), "error",
        F.posexplode("pages").alias("page_index", "page_text"),
    ).withColumn("parsed_at", F.current_timestamp() if parsed_at is None else parsed_at).select(
        *PAGE_COLUMNS, "error"
    )


def html_text(html: Column) -> Column:
    """Visible text of an HTML page, one block per line."""
    no_code = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", "")
    no_notes = F.regexp_replace(no_code, r"(?s)<!--.*?-->", "")
    blocks = F.regexp_replace(no_notes, r"(?i)</?(p|br|h[1-6]|li|div|title|article|footer)[^>]*>",
                              "\n")
    bare = F.regexp_replace(blocks, r"(?s)<[^>]*>", " ")
    packed = F.regexp_replace(bare, r"[ \t]*\n[ \t\n]*", "\n")
    return F.regexp_replace(packed, r"^[ \t\n]+|[ \t\n]+$", "")


def split_html_pages(
    pages: DataFrame, lines_per_page: int = 5, parsed_at: Column | None = None
) -> DataFrame:
    """(filename, customer_id, html) to page rows of the visible text."""
    docs = pages.select("filename", "customer_id", html_text(F.col("html")).alias("text"))
    return split_pages(docs, lines_per_page, parsed_at)


def content_hash(text: str = "text") -> Column:
    return F.xxhash64(text)


def uncached(docs: DataFrame, cache: DataFrame, by_content: bool = False) -> DataFrame:
    """Documents still to be parsed.

    By default a cached file name is enough to skip a document. ``by_content`` also re-parses
    changed texts; the cache then carries ``content_hash``.
    """
    if not by_content:
        return lookup_join(docs, cache.select("filename").distinct(), ["filename"], "left_anti")
    keyed = docs.withColumn("content_hash", content_hash())
    seen = cache.select("filename", "content_hash").distinct()
    return lookup_join(keyed, seen, ["filename", "content_hash"], "left_anti")


def keyword_pages(
    pages: DataFrame, words: Sequence[str], text: str = "page_text"
) -> DataFrame:
    """Pages holding any of the literal words, whatever their case."""
    pattern = "|".join(re.escape(w.lower()) for w in words)
    return pages.filter(F.lower(text).rlike(pattern))


def token_estimate(text: str = "page_text") -> Column:
    return F.ceil(F.length(text) / F.lit(4)).cast("int")


def with_token_budget(
    pages: DataFrame, limit: int = SMALLEST_CONTEXT, text: str = "page_text"
) -> DataFrame:
    """Adds ``tokens`` and whether the page fits ``limit``."""
    return pages.withColumn("tokens", token_estimate(text)).withColumn(
        "fits", F.col("tokens") <= limit
    )


def within_token_budget(
    pages: DataFrame, limit: int = SMALLEST_CONTEXT, text: str = "page_text"
) -> DataFrame:
    return pages.filter(token_estimate(text) <= limit)


def check_model(name: str, context_tokens: int | None = None) -> None:
    """Refuse models outside the allow-list and those whose window cannot hold a dense page."""
    if context_tokens is not None and context_tokens <= SMALLEST_CONTEXT:
        raise ValueError(
            f"{name} has a {context_tokens} token window for input and output together; "
            f"use one of {', '.join(MODELS)}"
        )
    if name not in MODELS:
        raise ValueError(f"unsupported model {name!r}; supported: {', '.join(MODELS)}")


def page_cache_status(pages: DataFrame) -> DataFrame:
    return pages.groupBy("filename", "customer_id").agg(
        F.count("*").alias("page_count"),
        F.max("total_pages").alias("total_pages"),
        F.min("parsed_at").alias("parsed_at"),
    )
