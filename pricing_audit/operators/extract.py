"""Page text to structured rows.

Two shapes of extraction result exist: a struct of parallel arrays (one array per column) and JSON
text with an array of objects. Rules built from regular expressions produce both inside Spark; a
custom extractor plugs in through ``mapInPandas`` and is opened once per partition.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order of the extraction results.
PRICE_FIELDS = (
    "temperature", "sample_size_label", "min_sample_ml", "max_sample_ml", "cubic_foot_max",
    "qty_tier_label", "min_qty", "max_qty", "price_usd", "price_eur", "price_sgd", "region",
)
FEE_FIELDS = (
    "fee_category", "fee_name", "price_usd", "price_eur", "price_sgd", "unit", "description",
)
RATE_LINE_FIELDS = (
    "temperature", "container_size", "tier_label", "volume_tier_min", "volume_tier_max", "unit_price",
)
RATE_FIELDS = ("temperature", "container_size", "volume_tier_min", "volume_tier_max", "unit_price")

# A factory opens the client and returns a function from page texts to one result per text. A
# result is a mapping, or the exception that stopped this page.
Extractor = Callable[[], Callable[[Sequence[str]], Sequence[object]]]


def arrays_type(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.ArrayType(T.StringType())) for f in fields])


def rows_type(root: str, fields: Sequence[str]) -> T.StructType:
    row = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return T.StructType([T.StructField(root, T.ArrayType(row))])


def _run_extractor(
    pages: DataFrame, extractor: Extractor, text: str, output: str, as_json: bool,
    fields: Sequence[str],
) -> DataFrame:
    result_type = T.StringType() if as_json else arrays_type(fields)
    schema = T.StructType([
        *pages.schema.fields,
        T.StructField(output, result_type),
        T.StructField("error", T.StringType()),
    ])

    def convert(result: object) -> object:
        if as_json:
            return result if isinstance(result, str) else json.dumps(result)
        return {
            f: None if result.get(f) is None
            else [None if v is None else str(v) for v in result[f]]
            for f in fields
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, broken = None, None
        try:
            client = extractor()
        except Exception as failure:
            broken = failure

        def asked(texts: list) -> list:
            found = list(client(texts))
            if len(found) != len(texts):
                raise ValueError(f"{len(found)} results for {len(texts)} pages")
            return found

        def one(page) -> object:
            try:
                return asked([page])[0]
            except Exception as failure:
                return failure

        for batch in batches:
            pages_of_batch = batch[text].tolist()
            if broken is not None:
                results = [broken] * len(pages_of_batch)
            else:
                try:
                    results = asked(pages_of_batch)
                except Exception:  # page by page, so that only the failing ones are lost
                    results = [one(page) for page in pages_of_batch]
            values, errors = [], []
            for result in results:
                try:
                    if isinstance(result, Exception):
                        raise result
                    values.append(convert(result))
                    errors.append(None)
                except Exception as failure:
                    values.append(None)
                    errors.append(f"{type(failure).__name__}: {failure}")
            yield batch.assign(**{output: pd.Series(values, index=batch.index, dtype=object),
                                  "error": pd.Series(errors, index=batch.index, dtype=object)})

    return pages.mapInPandas(run, schema)


def _rule_arrays(rules: Mapping[str, tuple[str, int] | Column], text: str) -> list[Column]:
    columns = []
    for name, rule in rules.items():
        if isinstance(rule, Column):
            columns.append(rule.alias(name))
        else:
            pattern, group = rule
            columns.append(
                F.regexp_extract_all(text, F.lit(pattern), group).alias(name)
            )
    return columns


def extract_arrays(
    pages: DataFrame,
    rules: Mapping[str, tuple[str, int] | Column] | None = None,
    extractor: Extractor | None = None,
    fields: Sequence[str] = PRICE_FIELDS,
    text: str = "page_text",
    output: str = "extraction",
) -> DataFrame:
    """Adds a struct of parallel arrays, and ``error`` (always NULL for rules).

    A rule is (pattern, group), matched over the whole text, or an array column.
    """
    if extractor is not None:
        return _run_extractor(pages, extractor, text, output, False, fields)
    return pages.withColumns({
        output: F.struct(*_rule_arrays(rules, text)),
        "error": F.lit(None).cast("string"),
    })


def extract_json(
    pages: DataFrame,
    rules: Mapping[str, tuple[str, int] | Column] | None = None,
    extractor: Extractor | None = None,
    root: str = "storage_rows",
    text: str = "page_text",
    output: str = "result_json",
) -> DataFrame:
    """Adds JSON text ``{"<root>": [{...}, ...]}``, and ``error``."""
    if extractor is not None:
        return _run_extractor(pages, extractor, text, output, True, ())
    rows = F.arrays_zip(*_rule_arrays(rules, text))
    return pages.withColumns({
        output: F.to_json(F.struct(rows.alias(root)), {"ignoreNullFields": "false"}),
        "error": F.lit(None).cast("string"),
    })


def extraction_prompt(
    fields: Sequence[str], root: str, text: str = "page_text"
) -> Column:
    """Instruction text for a prompt-driven extractor, followed by the page."""
    return F.concat(
        F.lit(
            f"Return one JSON object with the key {root}: an array with one object per row of the "
            f"page's table, each with exactly these keys: {', '.join(fields)}. Use null for "
            f"missing values and an empty array if there is no such table. JSON only."
        ),
        F.char(F.lit(10)), F.char(F.lit(10)), F.lit("PAGE CONTENT:"), F.char(F.lit(10)),
        F.col(text),
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error").isNull()).drop("error")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error").isNotNull())


def zip_flatten(
    df: DataFrame, struct_col: str, lead: str, cols: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Parallel arrays to rows, one per element of the lead array.

    Shorter arrays give NULL, surplus elements are ignored, and a NULL or empty lead gives no row.
    """
    others = [c for c in cols if c != lead]
    positioned = df.select(
        *keep, F.col(struct_col).alias("__arrays"),
        F.posexplode(f"{struct_col}.{lead}").alias("row_index", lead),
    )
    values = [F.get(F.col(f"__arrays.{c}"), F.col("row_index")).alias(c) for c in others]
    return positioned.select(*keep, "row_index", lead, *values)


def flatten_rows(
    df: DataFrame,
    json_col: str,
    root: str,
    fields: Sequence[str],
    keep: Sequence[str] = (),
    required: str | None = None,
    null_counts: bool = False,
) -> DataFrame:
    """JSON array of objects to rows; malformed text and empty lists give no row.

    All fields are read as text. ``required`` names a field that must not be missing or null; with
    ``null_counts`` an explicit JSON null is enough and only a missing key drops the row.
    """
    if null_counts:
        return _flatten_variants(df, json_col, root, fields, keep, required)
    parsed = F.from_json(json_col, rows_type(root, fields), {"mode": "PERMISSIVE"})
    rows = _each(df.select(*keep, parsed[root].alias("__rows")), keep).select(
        *keep, *[F.col(f"__row.{f}").alias(f) for f in fields]
    )
    return rows if required is None else rows.filter(F.col(required).isNotNull())


def _each(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Elements of ``__rows``. The outer form parses the text once; the plain one would first filter
    on the array and parse it again."""
    exploded = df.select(*keep, F.posexplode_outer("__rows").alias("__pos", "__row"))
    return exploded.filter(F.col("__pos").isNotNull())


def _flatten_variants(df, json_col, root, fields, keep, required):
    rows = F.try_variant_get(F.try_parse_json(json_col), f"$.{root}", "array<variant>")
    each = _each(df.select(*keep, rows.alias("__rows")), keep)
    if required is not None:
        each = each.filter(F.try_variant_get("__row", f"$.{required}", "variant").isNotNull())
    return each.select(
        *keep, *[F.try_variant_get("__row", f"$.{f}", "string").alias(f) for f in fields]
    )


def json_path(json_col: str, path: str, kind: str = "string") -> Column:
    """Value at ``path`` of JSON text; NULL for malformed text, missing paths and wrong types."""
    return F.try_variant_get(F.try_parse_json(json_col), path, kind)


# Pricing prose: "Temperature -80C, Vial: Tier 1 (1-100 units) $2.50/vial, Tier 2 (101+) $2.10."
_TIER = r"Tier [0-9]+ \(([0-9,]+)(?:-([0-9,]+)|\+)(?: units)?\) \$([0-9]+(?:\.[0-9]+)?)(?:/[a-z]+)?"
_TIER_BARE = _TIER.replace("([0-9,]+)(?:-([0-9,]+)", "[0-9,]+(?:-[0-9,]+").replace(
    r"\$([0-9]+(?:\.[0-9]+)?)", r"\$[0-9]+(?:\.[0-9]+)?"
)
_CLAUSE = rf"([A-Za-z0-9#-]+)\)?,? ([A-Za-z]+): ((?:{_TIER_BARE}(?:, )?)+)"
# Fixed value: upper bound of an open-ended tier in the rate card.
RATE_OPEN_END = 99999


def parse_clauses(sections: DataFrame, content: str = "content") -> DataFrame:
    """Contract prose to rate rows (temperature, container, tier bounds, unit price)."""
    carried = [c for c in sections.columns if c != content]
    clauses = sections.select(
        *carried, F.explode(F.regexp_extract_all(content, F.lit(_CLAUSE), 0)).alias("clause")
    )
    parts = clauses.select(
        *carried,
        F.regexp_extract("clause", _CLAUSE, 1).alias("temperature"),
        F.upper(F.regexp_extract("clause", _CLAUSE, 2)).alias("container_size"),
        F.struct(
            F.regexp_extract_all("clause", F.lit(_TIER), 1).alias("low"),
            F.regexp_extract_all("clause", F.lit(_TIER), 2).alias("high"),
            F.regexp_extract_all("clause", F.lit(_TIER), 3).alias("price"),
        ).alias("tiers"),
    )
    flat = zip_flatten(
        parts, "tiers", "low", ("low", "high", "price"),
        keep=(*carried, "temperature", "container_size"),
    )

    def whole(name: str) -> Column:
        return F.replace(F.col(name), F.lit(","), F.lit("")).try_cast("int")

    return flat.select(
        *carried, "temperature", "container_size",
        whole("low").alias("volume_tier_min"),
        F.coalesce(whole("high"), F.lit(RATE_OPEN_END)).alias("volume_tier_max"),
        F.col("price").try_cast("double").alias("unit_price"),
    )
