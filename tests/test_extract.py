from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pricing_audit.functions.labels import customer_from_filename, label_bounds
from pricing_audit.functions.numbers import round_half, text_to_date, text_to_double, text_to_whole
from pricing_audit.operators import extract, normalize, pages
from pricing_audit.sources import sample


def one(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_sections_give_the_rate_card(spark):
    found = extract.parse_clauses(sample.sections(spark))
    columns = ("contract_id", "temperature", "container_size", "volume_tier_min",
               "volume_tier_max", "unit_price")
    want = sorted(one(sample.rates(spark), *columns))
    assert sorted(one(found, *columns)) == want and len(want) == 38


def test_ragged_arrays(spark):
    df = spark.createDataFrame(
        [(1, (["a", "b", "c"], ["x"])), (2, (["d"], ["y", "surplus"])), (3, ([], ["z"])),
         (4, (None, ["z"])), (5, (["e", None], None))],
        "id int, arrays struct<lead:array<string>, other:array<string>>",
    )
    flat = extract.zip_flatten(df, "arrays", "lead", ("lead", "other"), keep=("id",))
    assert sorted(one(flat, "id", "row_index", "lead", "other"), key=str) == sorted([
        (1, 0, "a", "x"), (1, 1, "b", None), (1, 2, "c", None), (2, 0, "d", "y"),
        (5, 0, "e", None), (5, 1, None, None)], key=str)


def test_json_rows(spark):
    texts = [
        (1, '{"fee_rows":[{"fee_category":"a","fee_name":"n","price_usd":1.5}]}'),
        (2, '{"fee_rows":[{"fee_category":"a","fee_name":null},{"fee_name":"m"}]}'),
        (3, '{"fee_rows":[]}'),
        (4, '{"fee_rows":[{"fee_name":"cut"'),
        (5, "not json"),
        (6, '{"other":1}'),
        (7, None),
    ]
    df = spark.createDataFrame(texts, "id int, result_json string")
    rows = extract.flatten_rows(
        df, "result_json", "fee_rows", extract.FEE_FIELDS, ("id",), "fee_name")
    assert sorted(one(rows, "id", "fee_name", "price_usd"), key=str) == [
        (1, "n", "1.5"), (2, "m", None)]
    every = extract.flatten_rows(df, "result_json", "fee_rows", extract.FEE_FIELDS, ("id",))
    assert every.count() == 3
    values = df.select(
        "id", extract.json_path("result_json", "$.fee_rows[0].price_usd", "double").alias("p"))
    assert [r.p for r in values.orderBy("id").collect()] == [1.5] + [None] * 6


def test_rules_agree_in_both_shapes(spark):
    df = spark.createDataFrame([(1, "a=1 b=2"), (2, "none"), (3, "c=3")], "id int, page_text string")
    rules = {"name": (r"(\w)=(\d)", 1), "value": (r"(\w)=(\d)", 2)}
    arrays = extract.zip_flatten(
        extract.accepted(extract.extract_arrays(df, rules)), "extraction", "name",
        ("name", "value"), ("id",))
    objects = extract.flatten_rows(
        extract.extract_json(df, rules, root="rows"), "result_json", "rows",
        ("name", "value"), ("id",))
    want = [(1, "a", "1"), (1, "b", "2"), (3, "c", "3")]
    assert sorted(one(arrays, "id", "name", "value")) == want
    assert sorted(one(objects, "id", "name", "value")) == want


def test_plugged_extractor_keeps_errors_apart(spark):
    df = spark.createDataFrame(
        [(1, "good"), (2, "bad"), (3, "good too"), (4, None)], "id int, page_text string")

    def open_client():
        def client(texts):
            results = []
            for text in texts:
                if text is None or text == "bad":
                    results.append(ValueError("unreadable page"))
                else:
                    results.append({"temperature": [text], "price_usd": [1, None]})
            return results
        return client

    done = extract.extract_arrays(df, extractor=open_client)
    assert sorted(one(extract.rejected(done), "id", "error")) == [
        (2, "ValueError: unreadable page"), (4, "ValueError: unreadable page")]
    rows = extract.zip_flatten(
        extract.accepted(done), "extraction", "temperature", extract.PRICE_FIELDS, ("id",))
    assert sorted(one(rows, "id", "temperature", "price_usd", "region")) == [
        (1, "good", "1", None), (3, "good too", "1", None)]

    def open_json():
        return lambda texts: [{"storage_rows": [{"temperature": t}]} for t in texts]

    made = extract.extract_json(df.filter("id < 3"), extractor=open_json)
    assert sorted(json.loads(r.result_json)["storage_rows"][0]["temperature"]
                  for r in made.collect()) == ["bad", "good"]

    def broken():
        def client(texts):
            raise RuntimeError("no service")
        return client

    assert extract.rejected(extract.extract_json(df, extractor=broken)).count() == 4


def test_prompt(spark):
    df = spark.createDataFrame([("TEXT",)], "page_text string")
    prompt = df.select(extract.extraction_prompt(("a", "b"), "rows").alias("p")).first().p
    assert "rows" in prompt and "a, b" in prompt and prompt.endswith("PAGE CONTENT:\nTEXT")


def test_labels(spark):
    labels = ["<=1.4mL", "5-10mL", ">6000mL", "1-500,000", ">3,000,000", "1001+", "per request",
              None, "SBS tube <=1.4mL"]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    low, high = label_bounds(F.col("label"))
    assert one(df.select(low.alias("l"), high.alias("h")), "l", "h") == [
        (0.0, 1.4), (5.0, 10.0), (6000.0, 999999999.0), (1.0, 500000.0),
        (3000000.0, 999999999.0), (1001.0, 999999999.0), (None, None), (None, None), (0.0, 1.4)]


def test_numbers(spark):
    texts = ["1.5", "1,000", "$5", "per request", "1.5f", "", " 2.5 ", "1e3", "-2.5", None]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    got = df.select(text_to_double(F.col("t")).alias("d"), text_to_whole(F.col("t")).alias("w"))
    assert [r.d for r in got.collect()] == [
        1.5, None, None, None, None, None, 2.5, 1000.0, -2.5, None]
    assert [None if r.w is None else int(r.w) for r in got.collect()] == [
        2, None, None, None, None, None, 3, 1000, -3, None]
    ties = spark.createDataFrame([(1.005,), (-1.005,), (2.675,), (None,)], "x double")
    assert [r.x for r in ties.select(round_half(F.col("x"), 2).alias("x")).collect()] == [
        1.01, -1.01, 2.68, None]
    days = spark.createDataFrame([("2025-02-28",), ("2025-02-30",), ("soon",)], "t string")
    assert [str(r.d) for r in days.select(text_to_date(F.col("t")).alias("d")).collect()] == [
        "2025-02-28", "None", "None"]
    names = spark.createDataFrame([("My Big MSA.pdf",)], "f string")
    assert names.select(customer_from_filename(F.col("f")).alias("c")).first().c == "My_Big_MSA"


PRICE_ROW = ("f.pdf", "ACME", "RT", "5-10mL", "5", "10", None, "1-500,000", "1", "500,000")


def test_normalize_prices(spark):
    def row(region, usd="1.00", eur="2.00", sgd="3.00", temperature="RT"):
        base = list(PRICE_ROW)
        base[2] = temperature
        return (*base, usd, eur, sgd, region)

    schema = "filename string, customer_id string, " + ", ".join(
        f"{f} string" for f in extract.PRICE_FIELDS)
    df = spark.createDataFrame([
        row(None), row("Europe"), row("Griesheim"), row("Singapore"), row("Beijing"),
        row("Griesheim", eur=None), row("Europe", usd=None), row("X", temperature=None),
    ], schema)
    columns = ("region", "currency", "price", "price_currency_actual")
    a = one(normalize.normalize_prices(df, show_currency_used=True), *columns)
    assert a == [
        ("North America", "USD", "1.00", "USD"), ("Europe", "EUR", "2.00", "EUR"),
        ("Griesheim", "EUR", "2.00", "EUR"), ("Singapore", "SGD", "3.00", "SGD"),
        ("Beijing", "USD", "1.00", "USD"), ("Griesheim", "EUR", "1.00", "USD")]
    b = normalize.normalize_prices(df, method="B", model="m").collect()
    assert [(r.currency, r.price) for r in b][1] == ("EUR", "1.00")
    assert b[0].extraction_method == "AI_PARSE+AI_COMPLETE_m"
    assert (b[0].min_quantity_tier, b[0].max_quantity_tier, b[0].max_sample_size) == (1, None, 10.0)


def test_normalize_fees_and_rates(spark):
    schema = "filename string, customer_id string, " + ", ".join(
        f"{f} string" for f in extract.FEE_FIELDS)
    df = spark.createDataFrame([
        ("f", "ACME", "Lab", "a", "1", "2", "3", "each", "d"),
        ("f", "ACME", "Lab", "b", None, None, "3", "each", "d"),
        ("f", "ACME", "Lab", None, "1", None, None, "each", "d"),
    ], schema)
    assert one(normalize.normalize_fees(df), "fee_name", "price", "currency") == [
        ("a", "1", "USD"), ("b", "3", "USD")]
    assert one(normalize.normalize_fees(df, "B"), "fee_name", "price") == [("a", "1"), ("b", None)]
    raw = spark.createDataFrame(
        [("C", "ACME", "RT", "BOX", "1", "10", "2.5", "2025-01-01", "someday")],
        "contract_id string, customer_name string, temperature string, container_size string, "
        "volume_tier_min string, volume_tier_max string, unit_price string, "
        "effective_date string, expiry_date string")
    rate = normalize.normalize_rates(raw).first()
    assert (rate.volume_tier_max, rate.unit_price, rate.expiry_date) == (10, 2.5, None)


def test_pages(spark):
    docs = spark.createDataFrame(
        [("a", "x", "\n".join(str(i) for i in range(11)) + "\n"), ("b", "x", ""),
         ("c", "x", None)], "filename string, customer_id string, text string")
    rows = pages.split_pages(docs).orderBy("filename", "page_index").collect()
    assert [(r.filename, r.page_index, r.page_text, r.total_pages) for r in rows] == [
        ("a", 0, "0\n1\n2\n3\n4", 3), ("a", 1, "5\n6\n7\n8\n9", 3), ("a", 2, "10\n", 3),
        ("b", 0, "", 1)]
    html = spark.createDataFrame([(
        "u", "x", "<html><script>var a='<p>no</p>';</script><!-- c --><h1>Head</h1>"
        "<p>One <b>two</b></p><ul><li>L</li></ul></html>")],
        "filename string, customer_id string, html string")
    assert pages.split_html_pages(html).first().page_text == "Head\nOne  two\nL"
    status = pages.page_cache_status(pages.split_pages(docs)).filter("filename = 'a'").first()
    assert (status.page_count, status.total_pages) == (3, 3)


def test_page_filters(spark):
    df = spark.createDataFrame(
        [("Cold STORAGE here",), ("price per cu.ft",), ("price per cuxft",), (None,), ("-80C",)],
        "page_text string")
    assert pages.keyword_pages(df, pages.STORAGE_WORDS["A"]).count() == 3
    assert pages.keyword_pages(df, pages.STORAGE_WORDS["B"]).count() == 2
    wide = spark.createDataFrame([("x" * 16,), ("x" * 17,)], "page_text string")
    assert pages.within_token_budget(wide, 4).count() == 1
    assert [r.tokens for r in pages.with_token_budget(wide, 4).collect()] == [4, 5]
    pages.check_model("mistral-large2")
    for name, window in (("unheard-of", None), ("mistral-large2", 4096)):
        with pytest.raises(ValueError):
            pages.check_model(name, window)


def test_parse_once(spark):
    docs = spark.createDataFrame(
        [("a", "x", "one"), ("b", "x", "two"), ("c", "x", "three")],
        "filename string, customer_id string, text string")
    cache = spark.createDataFrame([("a",), ("a",), ("b",)], "filename string")
    assert one(pages.uncached(docs, cache), "filename") == [("c",)]
    hashed = docs.select("filename", pages.content_hash().alias("content_hash"))
    changed = docs.withColumn("text", F.when(F.col("filename") == "b", "2").otherwise(F.col("text")))
    assert one(pages.uncached(changed, hashed, by_content=True), "filename") == [("b",)]
