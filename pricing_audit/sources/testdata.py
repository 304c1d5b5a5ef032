"""The given tables with declared schemas, and the billing relations derived from them.

Every derivation is a plain DataFrame expression over whole tables. Nothing here is marked for
broadcast: Spark decides from table sizes, and adaptive execution splits skewed keys.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import round_half
from ..operators.joins import fits_broadcast

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Quantity tiers with price factors, and contract validity windows.
TIERS = ((1, 10, "1.00"), (11, 25, "0.90"), (26, 40, "0.80"))
WINDOWS = (
    ("MSA1", "1995-01-01", "1997-12-31", "1.00"),
    ("MSA2", "1998-01-01", "2000-12-31", "1.00"),
    ("SOW1", "1997-07-01", "1998-06-30", "0.95"),
)
OVERLAP_PREFIX, OVERLAP_SEGMENT = "SOW1", "BUILDING"
ZERO_RATE_BRAND, NO_RATE_BRAND = 24, 25
REGION_OF_SEGMENT = {
    "AUTOMOBILE": "North America",
    "BUILDING": "Griesheim",
    "FURNITURE": "Singapore",
    "HOUSEHOLD": "Beijing",
}
BILLED_FACTORS = ("1.100", "0.850", "1.005", "1.010")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a file stream. The pattern matches just the table's own path; given as a pattern
    the source also accepts a table that is a single file."""
    pattern = f"{sf_dir}/[{name[0]}]{name[1:]}.parquet"
    return spark.readStream.schema(SCHEMAS[name]).parquet(pattern)


# Payload up to which a table is sent to every task.
SMALL_BYTES = 8 * 1024 * 1024


def _sized(df: DataFrame) -> DataFrame:
    """``df`` as the right side of a join, broadcast only if its measured payload is small: by the size of
    its files Spark would send tables of millions of rows, of which the driver holds every row."""
    return F.broadcast(df) if fits_broadcast(df, SMALL_BYTES) else df.hint("merge")


def _decimal(text: str) -> Column:
    return F.lit(Decimal(text))


def _money(col: Column) -> Column:
    return col.cast("decimal(18,2)")


def _size_class(size: str = "p_size") -> Column:
    return F.when(F.col(size) <= 25, "SMALL").otherwise("LARGE")


def _brand_no(brand: str) -> Column:
    return F.substring(brand, 7, 10).cast("int")


def rate_base(part: DataFrame) -> DataFrame:
    """Lowest retail price per service type, temperature and container."""
    return part.groupBy(
        F.col("p_type").alias("service_type"),
        F.col("p_brand").alias("temperature"),
        _size_class().alias("container_size"),
    ).agg(F.min(_money(F.col("p_retailprice"))).alias("base_price"))


def rate_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = (
        table(spark, sf_dir, "customer")
        .agg(F.collect_set("c_mktsegment").alias("segments"))
        .scalar()
    )
    tiers = F.expr("array(%s)" % ", ".join(
        f"struct({lo} AS lo, {hi} AS hi, {f} AS f)" for lo, hi, f in TIERS
    ))
    windows = F.expr("array(%s)" % ", ".join(
        f"struct('{p}' AS prefix, DATE'{a}' AS start, DATE'{b}' AS end, {f} AS f)"
        for p, a, b, f in WINDOWS
    ))
    brand = _brand_no("temperature")
    price = F.when(brand == ZERO_RATE_BRAND, F.lit(0.0)).otherwise(
        _money(F.col("base_price") * F.col("tier.f") * F.col("window.f")).cast("double")
    )
    return (
        rate_base(table(spark, sf_dir, "part"))
        .filter(brand != NO_RATE_BRAND)
        .withColumn("customer_name", F.explode(segments))
        .withColumn("tier", F.explode(tiers))
        .withColumn("window", F.explode(windows))
        .filter(
            (F.col("window.prefix") != OVERLAP_PREFIX)
            | (F.col("customer_name") == OVERLAP_SEGMENT)
        )
        .select(
            F.concat_ws("-", "window.prefix", "customer_name").alias("contract_id"),
            "customer_name", "service_type", "temperature", "container_size",
            F.col("tier.lo").alias("volume_tier_min"),
            F.col("tier.hi").alias("volume_tier_max"),
            price.alias("unit_price"),
            F.col("window.start").alias("effective_date"),
            F.col("window.end").alias("expiry_date"),
        )
    )


def _billed_prices() -> Column:
    """Billed price for every tier and every kind of drift (by the order key's last digit).

    Worked out once per base price, so transactions only look their price up.
    """
    free = len(BILLED_FACTORS)  # the digit at which the zero-rate brand is billed nothing
    prices = []
    for _, _, factor in TIERS:
        tier_price = f"CAST(base_price * {factor} AS DECIMAL(18,2))"
        for digit, kind in enumerate((*BILLED_FACTORS, "1.000", "1.000")):
            price = f"CAST(CAST({tier_price} * {kind} AS DECIMAL(18,2)) AS DOUBLE)"
            if digit == free:
                price = f"IF(substring(temperature, 7) = '{ZERO_RATE_BRAND}', 0D, {price})"
            prices.append(price)
    return F.expr(f"array({', '.join(prices)})")


def billing(
    spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None
) -> DataFrame:
    """Billing transactions; pass a streaming ``lineitem`` to get them as a stream.

    Orders and line items grow together, so that join always shuffles: neither side is broadcast
    just because its pruned columns look small, and the work after it runs in parallel.
    """
    if lineitem is None:
        lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    bases = rate_base(part).withColumn("billed_prices", _billed_prices()).drop("base_price")
    priced = part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_type").alias("service_type"),
        F.col("p_brand").alias("temperature"),
        _size_class().alias("container_size"),
    )
    ordered = (
        table(spark, sf_dir, "orders")
        .join(
            _sized(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("c_mktsegment").alias("customer_name"),
            F.when(F.col("o_orderstatus") == "P", "PRE_ERP")
            .when(F.col("o_orderstatus") == "O", "APPROVED")
            .otherwise("INVOICED")
            .alias("erp_status"),
        )
    )
    quantity = F.col("l_quantity")
    tier = F.when(quantity <= TIERS[0][1], 0).when(quantity <= TIERS[1][1], 1).otherwise(2)
    drift = F.least(F.col("l_orderkey") % 10, F.lit(len(BILLED_FACTORS) + 1)).cast("int")
    price = F.get("billed_prices", tier * (len(BILLED_FACTORS) + 2) + drift)
    return (
        lineitem.join(ordered.hint("merge"), "l_orderkey")
        .join(_sized(priced), "l_partkey")
        .join(_sized(bases), ["service_type", "temperature", "container_size"])
        .select(
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), "l_linenumber", F.lit("-"),
                     "l_partkey", F.lit("-"), "l_suppkey").alias("txn_id"),
            "customer_name",
            F.col("l_shipdate").cast("date").alias("txn_date"),
            "service_type", "temperature", "container_size",
            quantity.cast("int").alias("quantity"),
            price.alias("billed_unit_price"),
            "erp_status",
        )
        .withColumn(
            "total_amount", round_half(F.col("quantity") * F.col("billed_unit_price"), 2)
        )
    )


def extracted_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows as two extraction methods would report them, prices as text."""
    rates = rate_card(spark, sf_dir)
    region = F.lit("Global")
    for segment, name in REGION_OF_SEGMENT.items():
        region = F.when(F.col("customer_name") == segment, name).otherwise(region)
    price = (
        F.when(F.col("brand_no") % 7 == 4, "per request")
        .when((F.col("extraction_method") == "B") & (F.col("brand_no") % 5 == 1), "1.00")
        .otherwise(_money(F.col("unit_price")).cast("string"))
    )
    return (
        rates.withColumn("extraction_method", F.explode(F.array(F.lit("A"), F.lit("B"))))
        .withColumn("brand_no", _brand_no("temperature"))
        .filter(~((F.col("extraction_method") == "B") & (F.col("brand_no") % 5 == 0)))
        .select(
            F.concat(F.lower("customer_name"), F.lit(".txt")).alias("filename"),
            "extraction_method",
            region.alias("region"),
            F.col("customer_name").alias("customer_id"),
            "temperature",
            F.concat_ws(
                "/", "service_type", "container_size", F.substring("contract_id", 1, 4)
            ).alias("sample_size"),
            F.concat_ws("-", "volume_tier_min", "volume_tier_max").alias("quantity_tier"),
            F.col("volume_tier_min").alias("min_quantity_tier"),
            F.col("volume_tier_max").alias("max_quantity_tier"),
            "brand_no",
            price.alias("price"),
            F.lit("USD").alias("currency"),
        )
    )


def truth_prices(extracted: DataFrame) -> DataFrame:
    """Ground truth with exact, near, one-percent, wrong and missing prices, by brand number."""
    amount = _money(F.col("price").try_cast("decimal(18,2)"))
    kind = F.col("brand_no") % 7
    price = (
        F.when(kind == 1, (amount + _decimal("0.00005")).cast("decimal(18,5)").cast("string"))
        .when(kind == 2, _money(amount * _decimal("1.005")).cast("string"))
        .when(kind == 3, _money(amount * _decimal("1.200")).cast("string"))
        .when(kind == 5, "per request")
        .otherwise(F.col("price"))
    )
    return extracted.filter((F.col("extraction_method") == "A") & (kind != 0)).select(
        "customer_id",
        F.lower("temperature").alias("temperature"),
        F.lower("sample_size").alias("sample_size"),
        "quantity_tier",
        F.upper("region").alias("region"),
        price.alias("price"),
    )


def raw_price_rows(part: DataFrame) -> DataFrame:
    """Extraction output before normalisation: prices in three currencies, all as text."""
    number = F.col("p_partkey")
    regions = F.array(*[
        F.lit(r) for r in
        (None, "North America", "Griesheim", "Europe", "Singapore", "Beijing", "Global")
    ])
    amount = _money(F.col("p_retailprice"))
    return part.select(
        F.concat(F.lower("p_type"), F.lit(".txt")).alias("filename"),
        F.col("p_type").alias("customer_id"),
        F.when(number % 10 != 9, F.col("p_brand")).alias("temperature"),
        F.concat_ws("/", "p_name", "p_partkey").alias("sample_size_label"),
        F.when(number % 4 != 3, F.col("p_size").cast("string"))
        .otherwise(F.concat(F.lit("<"), F.col("p_size"))).alias("min_sample_ml"),
        (F.col("p_size") + 5).cast("string").alias("max_sample_ml"),
        F.when(number % 6 == 5, F.concat("p_size", F.lit(".5"))).alias("cubic_foot_max"),
        F.concat(F.lit("1-"), F.format_number(F.col("p_size") * 1000, 0)).alias("qty_tier_label"),
        F.lit("1").alias("min_qty"),
        F.when(number % 3 == 0, F.format_number(F.col("p_size") * 1000, 0))
        .otherwise((F.col("p_size") * 1000).cast("string")).alias("max_qty"),
        F.when(number % 11 != 10, amount.cast("string")).alias("price_usd"),
        F.when(number % 4 != 1, _money(amount * _decimal("0.90")).cast("string"))
        .alias("price_eur"),
        F.when(number % 4 != 2, _money(amount * _decimal("1.35")).cast("string"))
        .alias("price_sgd"),
        F.get(regions, (number % 7).cast("int")).alias("region"),
    )


def raw_fee_rows(part: DataFrame) -> DataFrame:
    """Fee lines before normalisation; one line per part, some without a USD price or a name."""
    number = F.col("p_partkey")
    amount = _money(F.col("p_retailprice"))
    return part.select(
        F.concat(F.lower("p_brand"), F.lit(".txt")).alias("filename"),
        F.col("p_brand").alias("customer_id"),
        F.col("p_type").alias("fee_category"),
        F.when(number % 17 != 16, F.concat_ws(" ", "p_name", "p_partkey")).alias("fee_name"),
        F.when(number % 3 != 2, amount.cast("string")).alias("price_usd"),
        F.when(number % 5 != 4, _money(amount * _decimal("0.90")).cast("string"))
        .alias("price_eur"),
        _money(amount * _decimal("1.35")).cast("string").alias("price_sgd"),
        F.lit("per sample").alias("unit"),
        F.concat(F.lit("Fee for "), F.col("p_name")).alias("description"),
    )


def truth_fees(fees: DataFrame) -> DataFrame:
    """Expected fees: half a cent off for rings, a unit off for widgets, unknown for gizmos."""
    amount = F.col("price").try_cast("decimal(18,2)")
    name = F.col("fee_name")
    price = (
        F.when(name.contains("ring"),
               (amount + _decimal("0.005")).cast("decimal(18,3)").cast("string"))
        .when(name.contains("widget"), _money(amount + _decimal("1.00")).cast("string"))
        .otherwise(F.col("price"))
    )
    return fees.filter(
        (F.col("extraction_method") == "A") & ~name.contains("gizmo")
    ).select(
        "customer_id",
        F.lower("fee_category").alias("fee_category"),
        F.upper("fee_name").alias("fee_name"),
        price.alias("price"),
    )


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as (filename, customer_id, text) with the document id kept."""
    return table(spark, sf_dir, "documents").select(
        F.concat_ws("/", "source", "doc_id").alias("filename"),
        F.col("lang").alias("customer_id"),
        "text", "doc_id",
    )


def clause_sections(part: DataFrame) -> DataFrame:
    """One pricing section of contract prose per part, holding two clauses with tiers."""
    def usd(factor: str) -> Column:
        return _money(_money(F.col("p_retailprice")) * _decimal(factor)).cast("string")

    text = F.concat(
        F.lit("EXHIBIT A: PRICING SCHEDULE. All prices in USD. Temperature "), F.col("p_brand"),
        F.lit(", Vial: Tier 1 (1-"), F.col("p_size").cast("string"), F.lit(" units) $"),
        usd("1.00"), F.lit("/vial, Tier 2 ("), (F.col("p_size") + 1).cast("string"),
        F.lit("+ units) $"), usd("0.90"),
        F.lit("/vial. Liquid Nitrogen (LN2), Box: Tier 1 (1-1,000) $"), usd("2.00"),
        F.lit(", Tier 2 (1,001+) $"), usd("1.80"),
        F.lit(". Annual price escalation: CPI + 1%, maximum 4% per year."),
    )
    return part.select(
        F.concat(F.lit("MSA-"), F.col("p_partkey")).alias("contract_id"),
        F.col("p_type").alias("customer_name"),
        text.alias("content"),
    )


def rate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate card as contract texts, one per item of a contract: two dates, then a line per tier.
    Some prices are words, and the tier bounds stand in labels only."""
    amount = _money(F.col("unit_price")).cast("string")
    price = F.when(_brand_no("temperature") % 7 == 4, "on request").otherwise(amount)
    line = F.concat_ws(
        "|", "temperature", "container_size",
        F.concat("volume_tier_min", F.lit("-"), "volume_tier_max", F.lit(" units")), price,
    )
    item = ("contract_id", "customer_name", "service_type", "temperature", "container_size",
            "effective_date", "expiry_date")
    lines = rate_card(spark, sf_dir).groupBy(*item).agg(
        F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("lines"))
    text = F.concat(
        F.lit("Storage agreement\nEffective: "), F.col("effective_date").cast("string"),
        F.lit("\nExpires: "), F.col("expiry_date").cast("string"), F.lit("\n"), F.col("lines"),
    )
    return lines.select("contract_id", "customer_name", "service_type", text.alias("text"))


def contract_documents(part: DataFrame) -> DataFrame:
    """One contract text per part: a storage table on its first page, a fee table on its second."""
    amount = _money(F.col("p_retailprice"))
    region = F.when(F.col("p_size") > 40, "Griesheim").when(F.col("p_size") > 30, "Singapore")
    text = F.concat(
        F.lit("Storage rates\n"), F.col("p_brand"), F.lit("|"), F.col("p_name"), F.lit("|1-"),
        F.col("p_size").cast("string"), F.lit("|"), amount.cast("string"), F.lit("|"),
        F.coalesce(region, F.lit("")), F.lit("|"),
        F.when(F.col("p_size") <= 45, _money(amount * _decimal("0.90")).cast("string"))
        .otherwise(""),
        F.lit("\n\n\n\nRetrieval fees\n"), F.col("p_type"), F.lit("|"), F.col("p_name"), F.lit("|"),
        amount.cast("string"),
    )
    return part.select(
        F.concat(F.lit("contract "), F.col("p_partkey"), F.lit(".pdf")).alias("filename"),
        F.col("p_type").alias("customer_id"),
        text.alias("text"),
    )


def amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A card with very many versions per key: every order amends the price of its customer's segment
    and status for one quantity and one to three weeks, every 500th for all quantities and 400 days."""
    wide = F.col("o_orderkey") % 500 == 0
    only = (F.col("o_custkey") % 50 + 1).cast("int")
    days = F.when(wide, 400).otherwise(7 * (1 + F.col("o_orderkey") % 3)).cast("int")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    start = F.col("o_orderdate").cast("date")
    return (
        table(spark, sf_dir, "orders").join(_sized(customers), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat(F.lit("AM"), F.col("o_orderkey").cast("string")).alias("contract_id"),
            F.col("c_mktsegment").alias("customer_name"), F.col("o_orderstatus").alias("service_type"),
            F.when(wide, 1).otherwise(only).alias("volume_tier_min"),
            F.when(wide, 99999).otherwise(only).alias("volume_tier_max"),
            F.round(F.col("o_totalprice").cast("decimal(18,4)") / 1000, 2).cast("double").alias("unit_price"),
            start.alias("effective_date"), F.date_add(start, days).alias("expiry_date"),
        )
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions on the keys of ``amendments``."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").join(_sized(customers), F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("txn_id"),
        F.col("c_mktsegment").alias("customer_name"), F.col("l_linestatus").alias("service_type"),
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_shipdate").cast("date").alias("txn_date"),
    )


def price_table_documents(part: DataFrame) -> DataFrame:
    """(filename, customer_id, html): per part a page with a price table, list and net prices by quantity.
    A third of them leaves out the end tags, as HTML allows."""
    end = F.when(F.col("p_partkey") % 3 == 0, "").otherwise("</td>")
    prices = []
    for factor in ("1.00", "0.95"):
        cells = [
            F.concat(F.lit("<td>"), _money(_money(F.col("p_retailprice")) * _decimal(f) * _decimal(factor)).cast("string"), end)
            for _, _, f in TIERS
        ]
        prices.append(F.concat(*cells))
    tiers = "".join(f"<th>{lo}-{hi}</th>" for lo, hi, _ in TIERS)
    html = F.concat(
        F.lit("<html><body><h1>Rates</h1><table><tr><th rowspan=2>Brand</th><th rowspan=2>Kind</th>"),
        F.lit(f"<th colspan={len(TIERS)}>Unit price</th></tr><tr>{tiers}</tr><tr><td rowspan=2>"),
        F.col("p_brand"), end, F.lit("<td>List"), end, prices[0], F.lit("<tr><td>Net"), end, prices[1],
        F.lit("</table><p>Prices in USD</body></html>"),
    )
    return part.select(
        F.concat(F.lit("part-"), F.col("p_partkey"), F.lit(".html")).alias("filename"),
        F.col("p_type").alias("customer_id"), html.alias("html"),
    )
