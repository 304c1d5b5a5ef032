"""The same results in standard SQL, written independently of the DataFrame code."""

from __future__ import annotations

import re

from ..operators.pages import MODELS
from .queries import KEYWORDS, LINK, PARSED_AT

ORACLE: dict[str, str] = {}


def r2(expression: str, digits: int = 2) -> str:
    return f"CAST(ROUND(TRY_CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def total(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(28,10))) AS DOUBLE)"


def mean(column: str) -> str:
    return r2(f"({total(column)} / NULLIF(COUNT({column}), 0))", 6)


RATE_BASE = """
rate_base AS (
  SELECT p_type AS service_type, p_brand AS temperature,
         CASE WHEN p_size <= 25 THEN 'SMALL' ELSE 'LARGE' END AS container_size,
         CAST(substr(p_brand, 7) AS INT) AS brand_no,
         MIN(CAST(p_retailprice AS DECIMAL(18,2))) AS base_price
  FROM part GROUP BY p_type, p_brand, p_size <= 25
)"""

RATE_CARD = RATE_BASE + """,
rate_card AS MATERIALIZED (
  SELECT concat(w.pfx, '-', s.c_mktsegment) AS contract_id, s.c_mktsegment AS customer_name,
         b.service_type, b.temperature, b.container_size,
         t.lo AS volume_tier_min, t.hi AS volume_tier_max,
         CAST(CASE WHEN b.brand_no = 24 THEN 0
              ELSE CAST(b.base_price * t.f * w.wf AS DECIMAL(18,2)) END AS DOUBLE) AS unit_price,
         CAST(w.d0 AS DATE) AS effective_date, CAST(w.d1 AS DATE) AS expiry_date
  FROM (SELECT DISTINCT c_mktsegment FROM customer) s
  CROSS JOIN rate_base b
  CROSS JOIN (SELECT 1 AS lo, 10 AS hi, CAST(1.00 AS DECIMAL(3,2)) AS f
              UNION ALL SELECT 11, 25, CAST(0.90 AS DECIMAL(3,2))
              UNION ALL SELECT 26, 40, CAST(0.80 AS DECIMAL(3,2))) t
  CROSS JOIN (SELECT 'MSA1' AS pfx, '1995-01-01' AS d0, '1997-12-31' AS d1,
                     CAST(1.00 AS DECIMAL(3,2)) AS wf
              UNION ALL SELECT 'MSA2', '1998-01-01', '2000-12-31', CAST(1.00 AS DECIMAL(3,2))
              UNION ALL SELECT 'SOW1', '1997-07-01', '1998-06-30', CAST(0.95 AS DECIMAL(3,2))) w
  WHERE b.brand_no <> 25 AND (w.pfx <> 'SOW1' OR s.c_mktsegment = 'BUILDING')
)"""

BILLING = RATE_CARD + f""",
billing_raw AS (
  SELECT concat(l.l_orderkey, '-', l.l_linenumber, '-', l.l_partkey, '-', l.l_suppkey) AS txn_id,
         c.c_mktsegment AS customer_name, CAST(l.l_shipdate AS DATE) AS txn_date,
         b.service_type, b.temperature, b.container_size, CAST(l.l_quantity AS INT) AS quantity,
         CAST(CASE WHEN b.brand_no = 24 AND l.l_orderkey % 10 = 4 THEN 0
              ELSE CAST(CAST(b.base_price * CASE WHEN l.l_quantity <= 10 THEN CAST(1.00 AS DECIMAL(3,2))
                                                 WHEN l.l_quantity <= 25 THEN CAST(0.90 AS DECIMAL(3,2))
                                                 ELSE CAST(0.80 AS DECIMAL(3,2)) END AS DECIMAL(18,2))
                   * CASE l.l_orderkey % 10 WHEN 0 THEN CAST(1.100 AS DECIMAL(4,3))
                                            WHEN 1 THEN CAST(0.850 AS DECIMAL(4,3))
                                            WHEN 2 THEN CAST(1.005 AS DECIMAL(4,3))
                                            WHEN 3 THEN CAST(1.010 AS DECIMAL(4,3))
                                            ELSE CAST(1.000 AS DECIMAL(4,3)) END AS DECIMAL(18,2))
              END AS DOUBLE) AS billed_unit_price,
         CASE o.o_orderstatus WHEN 'P' THEN 'PRE_ERP' WHEN 'O' THEN 'APPROVED' ELSE 'INVOICED' END
           AS erp_status
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN rate_base b ON p.p_type = b.service_type AND p.p_brand = b.temperature
    AND CASE WHEN p.p_size <= 25 THEN 'SMALL' ELSE 'LARGE' END = b.container_size
),
billing AS (
  SELECT *, {r2('(quantity * billed_unit_price)')} AS total_amount FROM billing_raw
)"""

_PCT = ("(b.billed_unit_price - r.unit_price) / NULLIF(r.unit_price, 0) * 100")

_ANOMALY_COLUMNS = f"""
  b.txn_id, b.customer_name, b.txn_date, b.service_type, b.temperature, b.container_size,
  b.quantity, b.billed_unit_price, b.total_amount, b.erp_status, r.contract_id,
  r.unit_price AS contract_unit_price, r.volume_tier_min, r.volume_tier_max,
  r.effective_date AS contract_start, r.expiry_date AS contract_end,
  {r2('(b.billed_unit_price - r.unit_price)')} AS price_difference,
  {r2(f'({_PCT})')} AS price_variance_pct,
  {r2('((b.billed_unit_price - r.unit_price) * b.quantity)')} AS revenue_impact,
  CASE WHEN r.unit_price IS NULL THEN 'NO_CONTRACT_MATCH'
       WHEN ABS({_PCT}) <= 1.0 THEN 'WITHIN_TOLERANCE'
       WHEN b.billed_unit_price > r.unit_price THEN 'OVERCHARGE'
       WHEN b.billed_unit_price < r.unit_price THEN 'UNDERCHARGE' END AS anomaly_type"""

ANOMALIES = BILLING + f""",
anomalies AS (
  SELECT {_ANOMALY_COLUMNS}
  FROM billing b LEFT JOIN rate_card r
    ON b.customer_name = r.customer_name AND b.service_type = r.service_type
   AND b.temperature = r.temperature AND b.container_size = r.container_size
   AND b.quantity BETWEEN r.volume_tier_min AND r.volume_tier_max
   AND b.txn_date BETWEEN r.effective_date AND r.expiry_date
)"""

EXTRACTED = RATE_CARD + """,
extracted AS MATERIALIZED (
  SELECT concat(lower(r.customer_name), '.txt') AS filename, m.extraction_method,
         CASE r.customer_name WHEN 'AUTOMOBILE' THEN 'North America' WHEN 'BUILDING' THEN 'Griesheim'
              WHEN 'FURNITURE' THEN 'Singapore' WHEN 'HOUSEHOLD' THEN 'Beijing' ELSE 'Global' END AS region,
         r.customer_name AS customer_id, r.temperature,
         concat(r.service_type, '/', r.container_size, '/', left(r.contract_id, 4)) AS sample_size,
         concat(r.volume_tier_min, '-', r.volume_tier_max) AS quantity_tier,
         r.volume_tier_min AS min_quantity_tier, r.volume_tier_max AS max_quantity_tier,
         CAST(substr(r.temperature, 7) AS INT) AS brand_no,
         CASE WHEN CAST(substr(r.temperature, 7) AS INT) % 7 = 4 THEN 'per request'
              WHEN m.extraction_method = 'B' AND CAST(substr(r.temperature, 7) AS INT) % 5 = 1 THEN '1.00'
              ELSE CAST(CAST(r.unit_price AS DECIMAL(18,2)) AS VARCHAR) END AS price,
         'USD' AS currency
  FROM rate_card r CROSS JOIN (SELECT 'A' AS extraction_method UNION ALL SELECT 'B') m
  WHERE NOT (m.extraction_method = 'B' AND CAST(substr(r.temperature, 7) AS INT) % 5 = 0)
)"""

TRUTH = EXTRACTED + """,
truth AS (
  SELECT customer_id, lower(temperature) AS temperature, lower(sample_size) AS sample_size,
         quantity_tier, upper(region) AS region,
         CASE brand_no % 7
           WHEN 1 THEN CAST(CAST(CAST(price AS DECIMAL(18,2)) + 0.00005 AS DECIMAL(18,5)) AS VARCHAR)
           WHEN 2 THEN CAST(CAST(CAST(price AS DECIMAL(18,2)) * 1.005 AS DECIMAL(18,2)) AS VARCHAR)
           WHEN 3 THEN CAST(CAST(CAST(price AS DECIMAL(18,2)) * 1.200 AS DECIMAL(18,2)) AS VARCHAR)
           WHEN 5 THEN 'per request' ELSE price END AS price
  FROM extracted WHERE extraction_method = 'A' AND brand_no % 7 <> 0
)"""

RAW_FEES = """
raw_fees AS (
  SELECT concat(lower(p_brand), '.txt') AS filename, p_brand AS customer_id,
         p_type AS fee_category,
         CASE WHEN p_partkey % 17 <> 16 THEN concat(p_name, ' ', p_partkey) END AS fee_name,
         CASE WHEN p_partkey % 3 <> 2 THEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS price_usd,
         CASE WHEN p_partkey % 5 <> 4 THEN CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.90 AS DECIMAL(18,2)) AS VARCHAR) END AS price_eur,
         CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 1.35 AS DECIMAL(18,2)) AS VARCHAR) AS price_sgd,
         'per sample' AS unit, concat('Fee for ', p_name) AS description
  FROM part
)"""

FEES = RAW_FEES + """,
fees_a AS (
  SELECT filename, customer_id, fee_category, fee_name, 'USD' AS currency,
         COALESCE(price_usd, price_eur, price_sgd) AS price, unit, description,
         'A' AS extraction_method
  FROM raw_fees WHERE fee_name IS NOT NULL
),
fees AS (
  SELECT * FROM fees_a
  UNION ALL
  SELECT filename, customer_id, fee_category, fee_name, currency,
         CASE WHEN fee_name LIKE '%bolt%' THEN '1.00' ELSE price END, unit, description, 'B'
  FROM fees_a WHERE fee_name NOT LIKE '%gear%'
),
truth_fees AS (
  SELECT customer_id, lower(fee_category) AS fee_category, upper(fee_name) AS fee_name,
         CASE WHEN fee_name LIKE '%ring%'
                THEN CAST(CAST(CAST(price AS DECIMAL(18,2)) + 0.005 AS DECIMAL(18,3)) AS VARCHAR)
              WHEN fee_name LIKE '%widget%'
                THEN CAST(CAST(CAST(price AS DECIMAL(18,2)) + 1.00 AS DECIMAL(18,2)) AS VARCHAR)
              ELSE price END AS price
  FROM fees_a WHERE fee_name NOT LIKE '%gizmo%'
)"""


def number(column: str) -> str:
    return (
        f"CASE WHEN regexp_matches({column}, "
        r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$') "
        f"THEN TRY_CAST(trim({column}) AS DOUBLE) END"
    )


VALID_PRICES = f"""
valid_prices_num AS (
  SELECT e.*, t.price AS expected_price, {number('e.price')} AS got, {number('t.price')} AS want
  FROM extracted e LEFT JOIN truth t
    ON e.customer_id = t.customer_id AND upper(e.temperature) = upper(t.temperature)
   AND upper(e.sample_size) = upper(t.sample_size) AND upper(e.quantity_tier) = upper(t.quantity_tier)
   AND upper(e.region) = upper(t.region)
),
valid_prices_delta AS (
  SELECT *, {r2('abs(got - want)', 6)} AS price_delta,
         {r2('(100.0 * abs(got - want) / NULLIF(want, 0))')} AS price_delta_pct
  FROM valid_prices_num
),
valid_prices AS (
  SELECT *, CASE WHEN expected_price IS NULL THEN 'NO_EXPECTED'
                 WHEN price = expected_price THEN 'EXACT_MATCH'
                 WHEN price_delta <= 0.0001 THEN 'NEAR_MATCH'
                 WHEN price_delta_pct <= 1.0 THEN 'WITHIN_1PCT' ELSE 'MISMATCH' END AS match_status
  FROM valid_prices_delta
)"""

VALID_FEES = f"""
valid_fees_num AS (
  SELECT e.*, t.price AS expected_price, {number('e.price')} AS got, {number('t.price')} AS want
  FROM fees e LEFT JOIN truth_fees t
    ON e.customer_id = t.customer_id AND upper(e.fee_category) = upper(t.fee_category)
   AND upper(e.fee_name) = upper(t.fee_name)
),
valid_fees AS (
  SELECT *, {r2('abs(got - want)', 6)} AS price_delta,
         CASE WHEN expected_price IS NULL THEN 'NO_EXPECTED'
              WHEN price = expected_price THEN 'EXACT_MATCH'
              WHEN abs(got - want) <= 0.01 THEN 'NEAR_MATCH' ELSE 'MISMATCH' END AS match_status
  FROM valid_fees_num
)"""


def page_rows(source: str, text: str, columns: str, name: str = "page_rows") -> str:
    """CTEs splitting ``text`` of ``source`` into pages of five lines."""
    return f"""
page_lines AS (SELECT {columns}, string_split({text}, chr(10)) AS lines FROM {source}),
page_counts AS (SELECT *, CAST(ceil(len(lines) / 5.0) AS INT) AS total_pages FROM page_lines),
page_index AS (SELECT *, unnest(range(0, total_pages)) AS i FROM page_counts),
{name} AS (
  SELECT * EXCLUDE (lines, i), CAST(i AS INT) AS page_index,
         array_to_string(lines[i * 5 + 1 : i * 5 + 5], chr(10)) AS page_text
  FROM page_index
)"""


DOCUMENT_PAGES = page_rows(
    "documents", "text",
    "concat(source, '/', doc_id) AS filename, lang AS customer_id, doc_id",
)

_LINK_SQL = LINK.replace("'", "''")

_BM25_TOKENS = (
    r"list_transform(regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+'), lambda t: lower(t))"
)


def bm25(k: int, attribute_filter: str = "TRUE") -> str:
    return f"""
WITH doc_tokens AS (
  SELECT doc_id, lang, source, {_BM25_TOKENS.format(text='text')} AS t FROM documents
),
stats AS (SELECT COUNT(*) AS n, AVG(len(t)) AS avg_len FROM doc_tokens),
terms AS (
  SELECT DISTINCT item_id AS query_id, unnest({_BM25_TOKENS.format(text='text')}) AS term FROM benchmark
),
tokens AS (SELECT doc_id, lang, source, len(t) AS doc_len, unnest(t) AS term FROM doc_tokens),
postings AS (
  SELECT doc_id, lang, source, doc_len, term, COUNT(*) AS tf FROM tokens
  WHERE term IN (SELECT term FROM terms) GROUP BY ALL
),
frequency AS (SELECT term, COUNT(*) AS df FROM postings GROUP BY term),
scored AS (
  SELECT q.query_id, p.doc_id,
         SUM(CAST(
           ln(1 + (s.n - f.df + 0.5::DOUBLE) / (f.df + 0.5::DOUBLE)) * p.tf * (1.2::DOUBLE + 1)
           / (p.tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * p.doc_len / s.avg_len))
         AS DECIMAL(18,10))) AS total
  FROM postings p JOIN terms q ON p.term = q.term JOIN frequency f ON p.term = f.term, stats s
  WHERE {attribute_filter}
  GROUP BY q.query_id, p.doc_id
),
ranked AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY total DESC, doc_id) AS INT) AS rank
  FROM scored
)
SELECT query_id, doc_id, CAST(ROUND(total, 6) AS DOUBLE) AS score, rank FROM ranked WHERE rank <= {k}"""


def _anomaly_query(select: str) -> str:
    return f"WITH {ANOMALIES}\n{select}"


_REVIEWED = "anomaly_type IN ('OVERCHARGE', 'UNDERCHARGE')"

# --- billing against the rate card ---------------------------------------------------------------

ORACLE["billing_anomalies"] = _anomaly_query("SELECT * FROM anomalies")
ORACLE["stream_anomalies"] = ORACLE["billing_anomalies"]

ORACLE["billing_anomalies_single_match"] = f"""
WITH {BILLING},
numbered AS (SELECT *, ROW_NUMBER() OVER () AS row_no FROM billing),
joined AS (
  SELECT {_ANOMALY_COLUMNS},
         ROW_NUMBER() OVER (PARTITION BY b.row_no ORDER BY r.effective_date DESC, r.contract_id) AS pick
  FROM numbered b LEFT JOIN rate_card r
    ON b.customer_name = r.customer_name AND b.service_type = r.service_type
   AND b.temperature = r.temperature AND b.container_size = r.container_size
   AND b.quantity BETWEEN r.volume_tier_min AND r.volume_tier_max
   AND b.txn_date BETWEEN r.effective_date AND r.expiry_date
)
SELECT * EXCLUDE (pick) FROM joined WHERE pick = 1"""

ORACLE["anomaly_inner_variant"] = f"""
WITH {BILLING},
pairs AS (
  SELECT b.customer_name, {_PCT} AS pct,
         {r2('((b.billed_unit_price - r.unit_price) * b.quantity)')} AS revenue_impact
  FROM billing b JOIN rate_card r
    ON b.customer_name = r.customer_name AND b.temperature = r.temperature
   AND b.container_size = r.container_size
   AND b.quantity BETWEEN r.volume_tier_min AND r.volume_tier_max
),
flagged AS (
  SELECT *, CASE WHEN pct > 1.0 THEN 'OVERCHARGE' WHEN pct < -1.0 THEN 'UNDERCHARGE' END AS anomaly_type
  FROM pairs
)
SELECT customer_name, anomaly_type, COUNT(*) AS pair_count,
       {total('revenue_impact')} AS total_revenue_impact
FROM flagged GROUP BY customer_name, anomaly_type"""

_SUMMARY = f"""SELECT customer_name, anomaly_type, COUNT(*) AS txn_count,
       {total('total_amount')} AS total_billed, {total('revenue_impact')} AS total_revenue_impact,
       {mean('price_variance_pct')} AS avg_variance_pct,
       MIN(txn_date) AS earliest_txn, MAX(txn_date) AS latest_txn
FROM anomalies GROUP BY customer_name, anomaly_type"""

ORACLE["anomaly_summary"] = _anomaly_query(_SUMMARY)

ORACLE["anomaly_summary_reviewed"] = _anomaly_query(f"""
SELECT customer_name, anomaly_type, txn_count, total_revenue_impact
FROM ({_SUMMARY}) s WHERE {_REVIEWED} ORDER BY 1, 2""")

ORACLE["anomaly_counts"] = _anomaly_query(
    "SELECT anomaly_type, COUNT(*) AS txn_count FROM anomalies GROUP BY anomaly_type ORDER BY 1")

ORACLE["top_anomalies"] = _anomaly_query(f"""
SELECT txn_id, customer_name, temperature, container_size, quantity, billed_unit_price,
       contract_unit_price, price_difference, revenue_impact, anomaly_type, contract_id
FROM anomalies WHERE {_REVIEWED}
ORDER BY ABS(revenue_impact) DESC, txn_id, contract_id LIMIT 10""")

ORACLE["impact_alerts"] = _anomaly_query("""
SELECT txn_id, contract_id, customer_name, revenue_impact, anomaly_type
FROM anomalies WHERE ABS(revenue_impact) >= 5000.0""")
ORACLE["stream_alerts"] = ORACLE["impact_alerts"]

ORACLE["rate_history"] = f"""
WITH {RATE_CARD},
starts AS (
  SELECT DISTINCT customer_name, service_type, temperature, container_size, volume_tier_min,
         volume_tier_max, effective_date FROM rate_card
),
nexts AS (
  SELECT *, LEAD(effective_date) OVER (
           PARTITION BY customer_name, service_type, temperature, container_size, volume_tier_min,
                        volume_tier_max ORDER BY effective_date) AS next_effective_date
  FROM starts
)
SELECT r.*, n.next_effective_date,
       CASE WHEN n.next_effective_date - 1 < r.expiry_date
            THEN CAST(n.next_effective_date - 1 AS DATE) ELSE r.expiry_date END AS closed_date,
       n.next_effective_date IS NULL AS is_current
FROM rate_card r JOIN nexts n USING (customer_name, service_type, temperature, container_size,
                                     volume_tier_min, volume_tier_max, effective_date)"""

# --- metric layer --------------------------------------------------------------------------------

ORACLE["overcharge_impact_by_customer"] = _anomaly_query(f"""
SELECT customer_name, COUNT(*) AS overcharge_count,
       {total('revenue_impact')} AS total_overcharge_impact
FROM anomalies WHERE anomaly_type = 'OVERCHARGE'
GROUP BY customer_name ORDER BY total_overcharge_impact DESC""")

ORACLE["customer_anomalies"] = _anomaly_query(f"""
SELECT txn_id, txn_date, temperature, container_size, quantity, billed_unit_price,
       contract_unit_price, price_difference, revenue_impact, anomaly_type
FROM anomalies WHERE customer_name = 'BUILDING' AND {_REVIEWED} ORDER BY txn_date""")

ORACLE["rate_tiers_for_item"] = f"""
WITH {RATE_CARD}
SELECT customer_name, contract_id, service_type, volume_tier_min, volume_tier_max, unit_price,
       effective_date, expiry_date
FROM rate_card WHERE temperature = 'Brand#7' AND container_size = 'SMALL'
ORDER BY customer_name, volume_tier_min"""

ORACLE["billed_vs_contract"] = _anomaly_query("""
SELECT txn_id, customer_name, temperature, container_size, quantity, billed_unit_price,
       contract_unit_price, price_difference, price_variance_pct, anomaly_type, contract_id
FROM anomalies ORDER BY ABS(price_variance_pct) DESC NULLS LAST""")

ORACLE["anomaly_breakdown"] = _anomaly_query(f"""
SELECT customer_name, anomaly_type, COUNT(*) AS txn_count,
       {total('revenue_impact')} AS total_revenue_impact,
       {mean('price_variance_pct')} AS avg_variance_pct
FROM anomalies GROUP BY customer_name, anomaly_type ORDER BY 1, 2""")

ORACLE["pre_invoice_overcharges"] = _anomaly_query("""
SELECT txn_id, customer_name, txn_date, temperature, container_size, quantity, billed_unit_price,
       contract_unit_price, revenue_impact, contract_id
FROM anomalies WHERE erp_status = 'PRE_ERP' AND anomaly_type = 'OVERCHARGE'
ORDER BY revenue_impact DESC""")

_PIVOTED = ",\n       ".join(
    f"COUNT(*) FILTER (coalesce(anomaly_type, 'UNCLASSIFIED') = '{c}') AS {c.lower()}_count, "
    f"CAST(SUM(CAST(revenue_impact AS DECIMAL(28,10))) "
    f"FILTER (coalesce(anomaly_type, 'UNCLASSIFIED') = '{c}') AS DOUBLE) AS {c.lower()}_impact"
    for c in ("NO_CONTRACT_MATCH", "OVERCHARGE", "UNDERCHARGE", "WITHIN_TOLERANCE", "UNCLASSIFIED")
)
ORACLE["anomaly_pivot"] = _anomaly_query(
    f"SELECT customer_name,\n       {_PIVOTED}\nFROM anomalies GROUP BY customer_name")

ORACLE["metric_query_sample"] = _anomaly_query(f"""
SELECT erp_status, container_size, COUNT(*) AS row_count,
       {total('revenue_impact')} AS sum_revenue_impact, {total('total_amount')} AS sum_total_amount,
       {mean('price_variance_pct')} AS avg_price_variance_pct
FROM anomalies WHERE {_REVIEWED} GROUP BY erp_status, container_size""")

ORACLE["metric_query_rates"] = f"""
WITH {RATE_CARD}
SELECT customer_name, temperature, COUNT(*) AS row_count, MAX(unit_price) AS max_unit_price,
       MIN(volume_tier_min) AS min_volume_tier_min, MAX(volume_tier_max) AS max_volume_tier_max
FROM rate_card WHERE container_size = 'LARGE' GROUP BY customer_name, temperature"""

ORACLE["metric_query_small_prices"] = f"""
WITH priced AS (
  SELECT p_brand AS temperature, CAST(CAST(p_retailprice / 1000 AS DECIMAL(18,4)) AS DOUBLE) AS unit_price
  FROM part
)
SELECT temperature, COUNT(*) AS row_count, {mean('unit_price')} AS avg_unit_price FROM priced
GROUP BY temperature"""

ORACLE["filtered_prices"] = f"""
WITH {EXTRACTED}
SELECT customer_id, filename, temperature, sample_size, quantity_tier, region, price,
       min_quantity_tier, max_quantity_tier, extraction_method
FROM extracted WHERE customer_id = 'BUILDING' AND extraction_method = 'A'
ORDER BY customer_id, temperature, sample_size, min_quantity_tier LIMIT 500"""

ORACLE["fee_previews"] = f"""
WITH {FEES}
SELECT customer_id, fee_category, fee_name, price, unit, left(description, 8) AS description
FROM fees WHERE extraction_method = 'A' ORDER BY customer_id, fee_category, fee_name LIMIT 200"""

ORACLE["distinct_filter_values"] = f"""
WITH {EXTRACTED}
SELECT DISTINCT 'extraction_method' AS column_name, extraction_method AS value FROM extracted
UNION ALL SELECT DISTINCT 'temperature', temperature FROM extracted
UNION ALL SELECT DISTINCT 'region', region FROM extracted"""

# --- pages and extraction ------------------------------------------------------------------------

ORACLE["split_pages"] = f"""
WITH {DOCUMENT_PAGES}
SELECT filename, customer_id, page_index, page_text, total_pages FROM page_rows"""
ORACLE["stream_pages"] = ORACLE["split_pages"]
ORACLE["stream_changed_pages"] = ORACLE["split_pages"]

ORACLE["split_html_pages"] = r"""
WITH no_code AS (
  SELECT url AS filename,
         regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', '', 'gis') AS h FROM pages
),
no_notes AS (SELECT filename, regexp_replace(h, '<!--.*?-->', '', 'gs') AS h FROM no_code),
blocks AS (
  SELECT filename, regexp_replace(h, '</?(p|br|h[1-6]|li|div|title|article|footer)[^>]*>', chr(10), 'gi') AS h
  FROM no_notes
),
bare AS (SELECT filename, regexp_replace(h, '<[^>]*>', ' ', 'gs') AS h FROM blocks),
packed AS (SELECT filename, regexp_replace(h, '[ \t]*\n[ \t\n]*', chr(10), 'g') AS h FROM bare),
texts AS (SELECT filename, regexp_replace(h, '^[ \t\n]+|[ \t\n]+$', '', 'g') AS text FROM packed),
""" + page_rows("texts", "text", "filename") + """
SELECT filename, page_index, page_text, total_pages FROM page_rows"""

ORACLE["page_cache_status"] = f"""
WITH {DOCUMENT_PAGES}
SELECT filename, customer_id, COUNT(*) AS page_count, MAX(total_pages) AS total_pages,
       TIMESTAMP '{PARSED_AT}' AS parsed_at
FROM page_rows GROUP BY filename, customer_id"""

ORACLE["parse_once_delta"] = f"""
WITH {DOCUMENT_PAGES}
SELECT filename, customer_id, page_index, total_pages FROM page_rows
WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""

ORACLE["keyword_pages"] = f"""
WITH {DOCUMENT_PAGES}
SELECT filename, page_index, page_text FROM page_rows
WHERE {' OR '.join(f"lower(page_text) LIKE '%{w}%'" for w in KEYWORDS)}"""

ORACLE["token_budget"] = f"""
WITH {DOCUMENT_PAGES}
SELECT filename, page_index, CAST(ceil(length(page_text) / 4.0) AS INT) AS tokens,
       ceil(length(page_text) / 4.0) <= 400 AS fits
FROM page_rows"""

ORACLE["batch_customer_ids"] = """
SELECT doc_id, concat('rate_card_', lang, '_', source) AS customer_id FROM documents"""

_LINK_ROWS = f"""
links AS (
  SELECT page_id, url, regexp_extract_all(html, '{_LINK_SQL}', 1) AS hrefs,
         regexp_extract_all(html, '{_LINK_SQL}', 2) AS labels FROM pages
),
link_rows AS (
  SELECT *, unnest(range(1, len(hrefs) + 1)) AS i FROM links
)"""

ORACLE["extract_parallel_arrays"] = f"""
WITH {_LINK_ROWS}
SELECT page_id, CAST(i - 1 AS INT) AS row_index, hrefs[i] AS href, labels[i] AS label FROM link_rows"""

ORACLE["extract_json_from_rules"] = f"""
WITH {_LINK_ROWS} SELECT page_id, hrefs[i] AS href, labels[i] AS label FROM link_rows"""

ORACLE["ragged_array_flatten"] = """
WITH parts AS (
  SELECT conv_id, turn, CASE WHEN role <> 'system' THEN string_split(text, chr(10)) END AS lines,
         string_split(text, '. ') AS sentences FROM conversations
),
positioned AS (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM parts)
SELECT conv_id, turn, CAST(i - 1 AS INT) AS row_index, lines[i] AS line, sentences[i] AS sentence
FROM positioned"""

ORACLE["extract_json_rows"] = """
WITH made AS (
  SELECT doc_id, concat('{"rows":[{"fee_category":"', lang, '","fee_name":',
    CASE WHEN doc_id % 13 = 0 THEN 'null' ELSE concat('"', source, '"') END,
    ',"price_usd":', n_chars, '},{"fee_category":"', lang,
    '","fee_name":"second","price_usd":"', doc_id, '","unit":"per page"}]}') AS j
  FROM documents
),
cut AS (
  SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN left(j, length(j) - 1) ELSE j END AS j FROM made
),
parsed AS (SELECT doc_id, TRY_CAST(j AS JSON) AS j FROM cut),
items AS (SELECT doc_id, unnest(CAST(j->'rows' AS JSON[])) AS r FROM parsed WHERE j IS NOT NULL)
SELECT doc_id, r->>'fee_category' AS fee_category, r->>'fee_name' AS fee_name,
       r->>'price_usd' AS price_usd, r->>'unit' AS unit
FROM items WHERE r->>'fee_name' IS NOT NULL"""

ORACLE["safe_json_props"] = """
WITH cut AS (
  SELECT event_id, event_type,
         CASE WHEN event_id % 17 = 0 THEN left(props, length(props) - 1) ELSE props END AS props
  FROM events
),
parsed AS (SELECT event_id, event_type, TRY_CAST(props AS JSON) AS j FROM cut)
SELECT event_id, event_type, CAST(j->>'k' AS INT) AS k FROM parsed WHERE j->>'k' IS NOT NULL"""

ORACLE["label_bounds_of_tiers"] = """
SELECT p_partkey,
       CASE p_partkey % 7 WHEN 0 THEN concat('<=', p_size, '.4mL')
            WHEN 1 THEN concat(p_size, '-', p_size + 5, 'mL')
            WHEN 2 THEN concat('>', p_size, '000mL')
            WHEN 3 THEN concat('1-', format('{:,}', p_size * 1000))
            WHEN 4 THEN concat('>', format('{:,}', p_size * 1000))
            WHEN 5 THEN concat(p_size, '+') ELSE 'per request' END AS label,
       CAST(CASE p_partkey % 7 WHEN 0 THEN 0 WHEN 1 THEN p_size WHEN 2 THEN p_size * 1000 WHEN 3 THEN 1
            WHEN 4 THEN p_size * 1000 WHEN 5 THEN p_size END AS DOUBLE) AS low,
       CAST(CASE p_partkey % 7 WHEN 0 THEN p_size + 0.4 WHEN 1 THEN p_size + 5 WHEN 2 THEN 999999999
            WHEN 3 THEN p_size * 1000 WHEN 4 THEN 999999999 WHEN 5 THEN 999999999 END AS DOUBLE) AS high
FROM part"""

ORACLE["clause_prices"] = """
WITH priced AS (SELECT *, CAST(p_retailprice AS DECIMAL(18,2)) AS amount FROM part)
SELECT concat('MSA-', p_partkey) AS contract_id, p_type AS customer_name, temperature,
       container_size, volume_tier_min, volume_tier_max, CAST(unit_price AS DOUBLE) AS unit_price
FROM (
  SELECT *, p_brand AS temperature, 'VIAL' AS container_size, 1 AS volume_tier_min,
         p_size AS volume_tier_max, CAST(amount * 1.00 AS DECIMAL(18,2)) AS unit_price FROM priced
  UNION ALL SELECT *, p_brand, 'VIAL', p_size + 1, 99999, CAST(amount * 0.90 AS DECIMAL(18,2)) FROM priced
  UNION ALL SELECT *, 'LN2', 'BOX', 1, 1000, CAST(amount * 2.00 AS DECIMAL(18,2)) FROM priced
  UNION ALL SELECT *, 'LN2', 'BOX', 1001, 99999, CAST(amount * 1.80 AS DECIMAL(18,2)) FROM priced
)"""

_RAW_PRICES = """
raw_prices AS (
  SELECT p_partkey, p_size, concat(lower(p_type), '.txt') AS filename, p_type AS customer_id,
         CASE WHEN p_partkey % 10 <> 9 THEN p_brand END AS temperature,
         concat(p_name, '/', p_partkey) AS sample_size,
         concat('1-', format('{:,}', p_size * 1000)) AS quantity_tier,
         CASE WHEN p_partkey % 11 <> 10 THEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS price_usd,
         CASE WHEN p_partkey % 4 <> 1 THEN CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.90 AS DECIMAL(18,2)) AS VARCHAR) END AS price_eur,
         CASE WHEN p_partkey % 4 <> 2 THEN CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 1.35 AS DECIMAL(18,2)) AS VARCHAR) END AS price_sgd,
         CASE p_partkey % 7 WHEN 1 THEN 'North America' WHEN 2 THEN 'Griesheim' WHEN 3 THEN 'Europe'
              WHEN 4 THEN 'Singapore' WHEN 5 THEN 'Beijing' WHEN 6 THEN 'Global' END AS region
  FROM part
),
kept AS (SELECT * FROM raw_prices WHERE temperature IS NOT NULL AND price_usd IS NOT NULL)"""

ORACLE["normalize_prices"] = f"""
WITH {_RAW_PRICES}
SELECT filename, COALESCE(region, 'North America') AS region,
       CASE WHEN region IN ('Griesheim', 'Europe') THEN 'EUR' WHEN region = 'Singapore' THEN 'SGD'
            ELSE 'USD' END AS currency,
       temperature, sample_size, quantity_tier,
       COALESCE(CASE WHEN region IN ('Griesheim', 'Europe') THEN price_eur
                     WHEN region = 'Singapore' THEN price_sgd ELSE price_usd END, price_usd) AS price,
       CAST(CASE WHEN p_partkey % 3 <> 0 THEN p_size * 1000
                 WHEN p_size * 1000 < 1000 THEN p_size * 1000 END AS BIGINT) AS max_quantity_tier,
       CAST(1 AS BIGINT) AS min_quantity_tier, customer_id,
       CASE WHEN p_partkey % 6 = 5 THEN CAST(p_size + 0.5 AS DOUBLE) END AS cubic_foot_max,
       CASE WHEN p_partkey % 4 <> 3 THEN CAST(p_size AS DOUBLE) END AS min_sample_size,
       CAST(p_size + 5 AS DOUBLE) AS max_sample_size,
       'STORAGE' AS transaction_type, 'AI_PARSE+AI_EXTRACT' AS extraction_method,
       CASE WHEN region IN ('Griesheim', 'Europe') AND price_eur IS NOT NULL THEN 'EUR'
            WHEN region = 'Singapore' AND price_sgd IS NOT NULL THEN 'SGD' ELSE 'USD' END
         AS price_currency_actual
FROM kept"""

ORACLE["normalize_prices_b"] = f"""
WITH {_RAW_PRICES}
SELECT sample_size, COALESCE(region, 'North America') AS region,
       CASE WHEN region IN ('Griesheim', 'Europe') THEN 'EUR' WHEN region = 'Singapore' THEN 'SGD'
            ELSE 'USD' END AS currency,
       COALESCE(CASE WHEN region = 'Griesheim' THEN price_eur
                     WHEN region = 'Singapore' THEN price_sgd ELSE price_usd END, price_usd) AS price,
       'AI_PARSE+AI_COMPLETE_mistral-large2' AS extraction_method
FROM kept"""

_FEE_LINE = """SELECT filename, customer_id, fee_category, fee_name, 'USD' AS currency, {price} AS price,
       unit, description, '{tag}' AS extraction_method FROM raw_fees WHERE fee_name IS NOT NULL"""

ORACLE["fee_prices"] = f"""
WITH {RAW_FEES}
{_FEE_LINE.format(price='COALESCE(price_usd, price_eur, price_sgd)', tag='AI_PARSE+AI_EXTRACT')}
UNION ALL
{_FEE_LINE.format(price='COALESCE(price_usd, price_eur)', tag='AI_PARSE+AI_COMPLETE_mistral-large2')}"""

# --- validation and comparison -------------------------------------------------------------------

ORACLE["validate_prices"] = f"""
WITH {TRUTH}, {VALID_PRICES}
SELECT customer_id, filename, extraction_method, temperature, sample_size, quantity_tier, region,
       currency, price AS extracted_price, expected_price, got AS extracted_price_num,
       want AS expected_price_num, price_delta, price_delta_pct, match_status
FROM valid_prices"""

ORACLE["validate_fees"] = f"""
WITH {FEES}, {VALID_FEES}
SELECT customer_id, extraction_method, fee_category, fee_name, currency, price AS extracted_price,
       expected_price, price_delta, match_status
FROM valid_fees"""

ORACLE["validation_mismatches"] = f"""
WITH {TRUTH}, {VALID_PRICES}
SELECT customer_id, extraction_method, temperature, sample_size, quantity_tier,
       price AS extracted_price, expected_price, match_status
FROM valid_prices WHERE match_status = 'MISMATCH'"""

_STATS = """SELECT customer_id, extraction_method, '{name}' AS table_type, COUNT(*) AS total_rows,
       COUNT(*) FILTER (match_status IN ('EXACT_MATCH', 'NEAR_MATCH')) AS matched_rows,
       COUNT(*) FILTER (match_status = 'MISMATCH') AS mismatched_rows,
       COUNT(*) FILTER (match_status = 'NO_EXPECTED') AS no_expected_rows
  FROM {table} GROUP BY customer_id, extraction_method"""

ORACLE["validation_summary"] = f"""
WITH {TRUTH}, {VALID_PRICES}, {FEES}, {VALID_FEES},
stats AS (
  {_STATS.format(name='STORAGE_PRICING', table='valid_prices')}
  UNION ALL
  {_STATS.format(name='MANAGEMENT_FEES', table='valid_fees')}
),
rated AS (
  SELECT *, {r2('(100.0 * CAST(matched_rows AS DOUBLE) / NULLIF(total_rows - no_expected_rows, 0))', 1)}
           AS match_rate_pct FROM stats
)
SELECT *, CASE WHEN COALESCE(match_rate_pct, 0) >= 90 THEN 'GOOD'
               WHEN COALESCE(match_rate_pct, 0) >= 70 THEN 'WARN' ELSE 'BAD' END AS quality
FROM rated ORDER BY customer_id, table_type, extraction_method"""

ORACLE["method_counts"] = f"""
WITH {EXTRACTED}, {FEES}
SELECT customer_id, extraction_method, COUNT(*) AS row_count, 'prices' AS table_type
FROM extracted GROUP BY customer_id, extraction_method
UNION ALL
SELECT customer_id, extraction_method, COUNT(*), 'fees' FROM fees
GROUP BY customer_id, extraction_method"""

_COMPARE = f"""
WITH {EXTRACTED},
a AS (SELECT * FROM extracted WHERE extraction_method = 'A'),
b AS (SELECT * FROM extracted WHERE extraction_method = 'B')"""
_SAME_PRICE_KEY = """a.customer_id = b.customer_id AND a.temperature = b.temperature
  AND a.sample_size = b.sample_size AND a.quantity_tier = b.quantity_tier"""
_COMPARE_REGION = f"""
SELECT a.customer_id, a.temperature, a.sample_size, a.quantity_tier, a.region,
       a.price AS price_a, b.price AS price_b,
       CASE WHEN b.price IS NULL THEN 'B_MISSING' WHEN a.price = b.price THEN 'MATCH' ELSE 'DIFF' END AS status
FROM a LEFT JOIN b ON {_SAME_PRICE_KEY} AND a.region = b.region"""

ORACLE["compare_methods_region"] = _COMPARE + _COMPARE_REGION

ORACLE["compare_methods_noregion"] = _COMPARE + f"""
SELECT a.customer_id, a.temperature, a.sample_size, a.quantity_tier,
       a.price AS price_a, b.price AS price_b,
       CASE WHEN a.price = b.price THEN 'MATCH' ELSE 'DIFF' END AS status
FROM a LEFT JOIN b ON {_SAME_PRICE_KEY}"""

ORACLE["compare_methods_fees"] = f"""
WITH {FEES},
a AS (SELECT * FROM fees WHERE extraction_method = 'A'),
b AS (SELECT * FROM fees WHERE extraction_method = 'B')
SELECT a.customer_id, a.fee_category, a.fee_name, a.price AS price_a, b.price AS price_b,
       CASE WHEN b.price IS NULL THEN 'B_MISSING' WHEN a.price = b.price THEN 'MATCH' ELSE 'DIFF' END AS status
FROM a LEFT JOIN b ON a.customer_id = b.customer_id AND a.fee_category = b.fee_category
  AND a.fee_name = b.fee_name"""

ORACLE["compare_methods_full"] = _COMPARE + f"""
SELECT a.customer_id, a.temperature, a.sample_size, a.quantity_tier, a.region,
       b.price AS price_a, a.price AS price_b,
       CASE WHEN b.customer_id IS NULL THEN 'A_MISSING' WHEN a.price = b.price THEN 'MATCH'
            ELSE 'DIFF' END AS status
FROM a LEFT JOIN b ON {_SAME_PRICE_KEY} AND a.region = b.region
UNION ALL
SELECT b.customer_id, b.temperature, b.sample_size, b.quantity_tier, b.region, b.price, NULL,
       'B_MISSING'
FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE {_SAME_PRICE_KEY} AND a.region = b.region)"""

ORACLE["compare_tally"] = _COMPARE + f""",
compared AS ({_COMPARE_REGION})
SELECT COUNT(*) AS total, COUNT(*) FILTER (status = 'MATCH') AS matched,
       COUNT(*) FILTER (status = 'DIFF') AS diff,
       COUNT(*) FILTER (status = 'B_MISSING') AS b_missing,
       COALESCE(100 * COUNT(*) FILTER (status = 'MATCH') // NULLIF(COUNT(*), 0), 0) AS match_pct
FROM compared"""

# --- search --------------------------------------------------------------------------------------

ORACLE["search_bm25"] = bm25(10)
ORACLE["stream_search"] = ORACLE["search_bm25"]
ORACLE["search_filtered"] = bm25(5, "p.lang = 'en' AND p.source = 'src1'")

ORACLE["vector_topk"] = f"""
WITH cells AS (
  SELECT label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings
),
means AS (SELECT label, i, AVG(x) AS x FROM cells GROUP BY label, i),
centers AS (SELECT label AS query_id, list(x ORDER BY i) AS center FROM means GROUP BY label),
pairs AS (
  SELECT c.query_id, e.vec_id,
         list_cosine_similarity(c.center, CAST(e.embedding AS DOUBLE[])) AS similarity
  FROM centers c CROSS JOIN embeddings e
),
ranked AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY round(similarity, 12) DESC, vec_id) AS INT) AS rank
  FROM pairs
)
SELECT query_id, vec_id, {r2('similarity', 6)} AS similarity, rank FROM ranked WHERE rank <= 10"""

ORACLE["index_refresh_delta"] = f"""
WITH before_docs AS (
  SELECT doc_id, CASE WHEN lang = 'fr' THEN concat('old ', text) ELSE text END AS text
  FROM documents WHERE source <> 'src3'
),
now_docs AS (
  SELECT doc_id, text, CAST(len({_BM25_TOKENS.format(text='text')}) AS INT) AS doc_len
  FROM documents WHERE source <> 'src4'
)
SELECT n.doc_id, CASE WHEN b.doc_id IS NULL THEN 'NEW' ELSE 'CHANGED' END AS change, n.doc_len
FROM now_docs n LEFT JOIN before_docs b ON n.doc_id = b.doc_id
WHERE b.doc_id IS NULL OR b.text <> n.text
UNION ALL
SELECT b.doc_id, 'REMOVED', NULL FROM before_docs b
WHERE b.doc_id NOT IN (SELECT doc_id FROM now_docs)"""

# --- runs ----------------------------------------------------------------------------------------

ORACLE["table_row_counts"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
)

ORACLE["named_table_scan"] = """
SELECT quality, toxic, COUNT(*) AS row_count FROM labels GROUP BY quality, toxic"""

ORACLE["run_report"] = f"""
WITH {EXTRACTED}, {FEES},
per_method AS (
  SELECT customer_id, extraction_method, COUNT(*) AS storage_rows, 0 AS fee_rows
  FROM extracted GROUP BY 1, 2
  UNION ALL SELECT customer_id, extraction_method, 0, COUNT(*) FROM fees GROUP BY 1, 2
),
pages_of AS (SELECT p_brand AS customer_id, COUNT(*) AS pages FROM part GROUP BY p_brand)
SELECT m.customer_id, m.extraction_method, COALESCE(p.pages, 0) AS pages,
       CAST(SUM(m.storage_rows) AS BIGINT) AS storage_rows, CAST(SUM(m.fee_rows) AS BIGINT) AS fee_rows
FROM per_method m LEFT JOIN pages_of p ON m.customer_id = p.customer_id
GROUP BY m.customer_id, m.extraction_method, p.pages"""

ORACLE["contract_status"] = """
WITH log AS (
  SELECT o_custkey AS contract_id, o_orderdate AS logged_at,
         CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'EXTRACTED' ELSE 'PENDING' END AS status,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
  FROM orders
)
SELECT contract_id, MAX(CASE WHEN n = 1 THEN status END) AS extraction_status,
       MAX(CASE WHEN status = 'EXTRACTED' THEN logged_at END) AS extracted_at,
       COUNT(*) AS log_entries
FROM log GROUP BY contract_id"""

ORACLE["keyed_replace"] = f"""
WITH {EXTRACTED}
SELECT customer_id, extraction_method, temperature, sample_size, quantity_tier,
       CASE WHEN extraction_method = 'B' AND customer_id = 'BUILDING' THEN '9.99' ELSE price END AS price
FROM extracted WHERE NOT (extraction_method = 'B' AND customer_id = 'MACHINERY')"""

ORACLE["append_and_dedupe"] = f"""
WITH {FEES}
SELECT 'appended' AS table_name, 2 * COUNT(*) AS row_count FROM fees
UNION ALL
SELECT 'deduplicated', COUNT(*) FROM (
  SELECT DISTINCT customer_id, fee_category, fee_name, extraction_method FROM fees)"""

ORACLE["stored_documents"] = """
SELECT lang, CAST(SUM(octet_length(encode(text)) + 1) AS BIGINT) AS listed_bytes,
       CAST(SUM(octet_length(encode(text)) + 1) AS BIGINT) AS read_bytes
FROM documents GROUP BY lang"""

ORACLE["csv_export"] = f"""
WITH {FEES}
SELECT customer_id, fee_category, fee_name, price, unit FROM fees WHERE extraction_method = 'A'"""

_BOTH = """SELECT url AS filename, hrefs[i] AS fee_category, labels[i] AS fee_name,
       CAST(length(labels[i]) AS VARCHAR) AS price, '{tag}' AS extraction_method FROM link_rows"""

ORACLE["run_both_methods"] = f"""
WITH {_LINK_ROWS}
{_BOTH.format(tag='AI_PARSE+AI_EXTRACT')}
UNION ALL
{_BOTH.format(tag='AI_PARSE+AI_COMPLETE_mistral-large2')}"""

ORACLE["extract_contracts"] = """
WITH priced AS (
  SELECT *, concat('contract ', p_partkey, '.pdf') AS filename,
         CAST(p_retailprice AS DECIMAL(18,2)) AS amount FROM part
)
SELECT 'price' AS kind, filename, p_type AS customer_id, p_brand AS name,
       CASE WHEN p_size > 40 THEN 'Griesheim' WHEN p_size > 30 THEN 'Singapore'
            ELSE 'North America' END AS region,
       CASE WHEN p_size > 40 THEN 'EUR' WHEN p_size > 30 THEN 'SGD' ELSE 'USD' END AS currency,
       CASE WHEN p_size > 40 AND p_size <= 45
            THEN CAST(CAST(amount * 0.90 AS DECIMAL(18,2)) AS VARCHAR)
            ELSE CAST(amount AS VARCHAR) END AS price,
       'AI_PARSE+AI_EXTRACT' AS extraction_method
FROM priced
UNION ALL
SELECT 'fee', filename, p_type, p_name, NULL, 'USD', CAST(amount AS VARCHAR), 'AI_PARSE+AI_EXTRACT'
FROM priced"""

ORACLE["billing_anomalies_shuffled"] = ORACLE["billing_anomalies"]
ORACLE["billing_single_match_shuffled"] = ORACLE["billing_anomalies_single_match"]
ORACLE["compare_methods_shuffled"] = ORACLE["compare_methods_region"]

_READABLE = "WHERE b.brand_no <> 25 AND b.brand_no % 7 <> 4 AND"
ORACLE["document_rates_summary"] = ORACLE["anomaly_summary"].replace(
    "WHERE b.brand_no <> 25 AND", _READABLE)

ORACLE["document_rate_rejects"] = f"""
WITH {RATE_CARD}
SELECT contract_id, 'unit_price' AS reason, COUNT(*) AS row_count FROM rate_card
WHERE CAST(substr(temperature, 7) AS INT) % 7 = 4 GROUP BY contract_id"""

ORACLE["document_rate_status"] = f"""
WITH {RATE_CARD}
SELECT contract_id, COUNT(*) FILTER (CAST(substr(temperature, 7) AS INT) % 7 <> 4) AS rate_rows,
       CASE WHEN COUNT(*) FILTER (CAST(substr(temperature, 7) AS INT) % 7 <> 4) > 0 THEN 'EXTRACTED'
            ELSE 'FAILED' END AS status
FROM rate_card GROUP BY contract_id"""

ORACLE["extractor_errors"] = """
SELECT page_id, CASE WHEN length(html) % 2 = 0 THEN CAST(length(html) AS VARCHAR) END AS size,
       CASE WHEN length(html) % 2 = 1 THEN 'ValueError: odd page' END AS error
FROM pages"""

ORACLE["extract_json_null_counts"] = ORACLE["extract_json_rows"].replace(
    "r->>'price_usd' AS price_usd, r->>'unit' AS unit", "r->>'unit' AS unit"
).replace("r->>'fee_name' IS NOT NULL", "json_exists(r, '$.fee_name')")

ORACLE["search_refreshed"] = bm25(10).replace(
    "FROM documents", "FROM (SELECT * FROM documents WHERE source <> 'src4')")

ORACLE["late_amendments"] = ORACLE["billing_anomalies"]
ORACLE["summary_kept_current"] = ORACLE["anomaly_summary"]
ORACLE["search_segmented"] = ORACLE["search_refreshed"]

_LINES_OF = """
  SELECT 'price' AS kind, filename, {customer} AS customer_id, p_brand AS name,
       CASE WHEN p_size > 40 THEN 'Griesheim' WHEN p_size > 30 THEN 'Singapore'
            ELSE 'North America' END AS region,
       CASE WHEN p_size > 40 THEN 'EUR' WHEN p_size > 30 THEN 'SGD' ELSE 'USD' END AS currency,
       CASE WHEN p_size > 40 AND p_size <= 45
            THEN CAST(CAST(amount * 0.90 AS DECIMAL(18,2)) AS VARCHAR)
            ELSE CAST(amount AS VARCHAR) END AS price,
       'AI_PARSE+AI_EXTRACT' AS extraction_method
  FROM priced WHERE {chosen}
  UNION ALL
  SELECT 'fee', filename, {customer}, p_name, NULL, 'USD', CAST(amount AS VARCHAR),
       'AI_PARSE+AI_EXTRACT'
  FROM priced WHERE {chosen}"""

ORACLE["two_contract_runs"] = f"""
WITH priced AS (
  SELECT *, concat('contract ', p_partkey, '.pdf') AS filename,
         CAST(p_retailprice AS DECIMAL(18,2)) AS amount FROM part
)
{_LINES_OF.format(customer="concat('0000', p_partkey % 10)", chosen="TRUE")}
UNION ALL
{_LINES_OF.format(customer="'00042'", chosen="p_partkey % 10 = 3 AND p_partkey % 4 = 3")}"""

ORACLE["contract_methods_run"] = "\nUNION ALL\n".join(
    ORACLE["extract_contracts"].replace("'AI_PARSE+AI_EXTRACT'", f"'{tag}'").join(
        ("SELECT * FROM (", ")")
    ) for tag in ("AI_PARSE+AI_EXTRACT", *(f"AI_PARSE+AI_COMPLETE_{m}" for m in MODELS[:2])))

VERSIONS = """
WITH amendments AS (
  SELECT concat('AM', o_orderkey) AS contract_id, c_mktsegment AS customer_name,
         o_orderstatus AS service_type, CAST(o_orderdate AS DATE) AS contract_start,
         CASE WHEN o_orderkey % 500 = 0 THEN 1 ELSE o_custkey % 50 + 1 END AS lo,
         CASE WHEN o_orderkey % 500 = 0 THEN 99999 ELSE o_custkey % 50 + 1 END AS hi,
         CAST(CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 500 = 0 THEN 400
              ELSE 7 * (1 + o_orderkey % 3) END AS INT) AS DATE) AS contract_end,
         CAST(round(CAST(o_totalprice AS DECIMAL(18,4)) / 1000, 2) AS DOUBLE) AS contract_unit_price
  FROM orders JOIN customer ON o_custkey = c_custkey
), shipments AS (
  SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS txn_id,
         row_number() OVER () AS line, c_mktsegment AS customer_name, l_linestatus AS service_type,
         CAST(l_quantity AS INT) AS quantity, CAST(l_shipdate AS DATE) AS txn_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
), matched AS (
  SELECT s.txn_id, s.line, a.contract_id, a.contract_unit_price, a.contract_start
  FROM shipments s LEFT JOIN amendments a ON s.customer_name = a.customer_name
   AND s.service_type = a.service_type AND s.quantity BETWEEN a.lo AND a.hi
   AND s.txn_date BETWEEN a.contract_start AND a.contract_end
)"""

ORACLE["rates_of_many_versions"] = VERSIONS + """
SELECT txn_id, contract_id, contract_unit_price FROM matched"""

ORACLE["latest_of_many_versions"] = VERSIONS + """
SELECT txn_id, contract_id, contract_unit_price, contract_start FROM (
  SELECT *, row_number() OVER (PARTITION BY line ORDER BY contract_start DESC, contract_id) AS nth
  FROM matched
) WHERE nth = 1"""

ORACLE["vector_ivf_recall"] = """
SELECT count(*) * least(10, (SELECT count(*) FROM embeddings)) AS exact_results, TRUE AS reached
FROM embeddings WHERE vec_id % 20 = 0"""

# --- tables in documents ---------------------------------------------------------------------------

_PRICE_TABLES = """kinds AS (SELECT 0 AS row_index, 'List' AS kind, CAST(1.00 AS DECIMAL(3,2)) AS kf
           UNION ALL SELECT 1, 'Net', CAST(0.95 AS DECIMAL(3,2))
), tiers AS (SELECT 2 AS column_index, '1-10' AS tier, CAST(1.00 AS DECIMAL(3,2)) AS f
             UNION ALL SELECT 3, '11-25', CAST(0.90 AS DECIMAL(3,2))
             UNION ALL SELECT 4, '26-40', CAST(0.80 AS DECIMAL(3,2))
), prices AS (
  SELECT concat('part-', p_partkey, '.html') AS filename, p_type AS customer_id, p_brand, row_index, kind,
         column_index, tier, CAST(CAST(p_retailprice AS DECIMAL(18,2)) * f * kf AS DECIMAL(18,2)) AS price
  FROM part CROSS JOIN kinds CROSS JOIN tiers
)"""

ORACLE["layout_cells"] = f"""
WITH {_PRICE_TABLES}
SELECT filename, CAST(0 AS INT) AS table_index, row_index, column_index, concat('Unit price / ', tier) AS header_path,
       CAST(price AS VARCHAR) AS value, FALSE AS spanned FROM prices
UNION ALL
SELECT filename, 0, row_index, 0, 'Brand', p_brand, row_index = 1 FROM prices WHERE column_index = 2
UNION ALL
SELECT filename, 0, row_index, 1, 'Kind', kind, FALSE FROM prices WHERE column_index = 2"""

ORACLE["layout_prices"] = f"""
WITH {_PRICE_TABLES}
SELECT filename, customer_id, p_brand AS brand, kind,
       CAST(max(price) FILTER (WHERE column_index = 2) AS DOUBLE) AS small,
       CAST(max(price) FILTER (WHERE column_index = 4) AS DOUBLE) AS large
FROM prices GROUP BY filename, customer_id, p_brand, kind"""

# --- event time ----------------------------------------------------------------------------------

_IN_TIME = """marks AS MATERIALIZED (
  SELECT wave, max(newest) OVER (ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {delay} AS mark
  FROM (SELECT wave, max(moment) AS newest FROM arrivals GROUP BY wave) w
), in_time AS (
  SELECT a.* FROM arrivals a JOIN marks m ON a.wave = m.wave WHERE m.mark IS NULL OR a.moment >= m.mark
), final AS (SELECT max(moment) - {delay} AS mark FROM arrivals)"""

_EVENT_WAVES = """arrivals AS MATERIALIZED (
  SELECT event_id, user_id, event_type, epoch_us(ts) AS moment, value,
         CASE WHEN day(ts) <= 15 THEN 0 ELSE 1 END + CASE WHEN event_id % 20 = 7 THEN 1 ELSE 0 END AS wave
  FROM events
), """ + _IN_TIME.format(delay=172800000000)

ORACLE["event_storms"] = f"""
WITH {_EVENT_WAVES},
opened AS (
  SELECT *, CASE WHEN moment - lag(moment) OVER w < 43200000000 THEN 0 ELSE 1 END AS opens FROM in_time
  WINDOW w AS (PARTITION BY user_id, event_type ORDER BY moment)
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id, event_type ORDER BY moment ROWS UNBOUNDED PRECEDING) AS session
  FROM opened
)
SELECT user_id, event_type, min(moment) AS first, max(moment) AS last, count(*) AS n_events,
       {total('value')} AS total, max(moment) + 43200000000 <= max(mark) AS closed
FROM numbered, final GROUP BY user_id, event_type, session"""

ORACLE["late_events"] = f"""
WITH {_EVENT_WAVES}
SELECT event_id, user_id, moment AS at_micros, CAST(a.wave AS BIGINT) AS wave
FROM arrivals a JOIN marks m ON a.wave = m.wave WHERE a.moment < m.mark"""

ORACLE["sliding_impact"] = f"""
WITH {ANOMALIES},
arrivals AS MATERIALIZED (
  SELECT customer_name, CAST(txn_date - DATE '1970-01-01' AS BIGINT) AS moment, revenue_impact AS value,
         CASE WHEN txn_date < DATE '1998-01-01' THEN 0 ELSE 1 END + CASE WHEN quantity % 20 = 7 THEN 1 ELSE 0 END AS wave
  FROM anomalies
), {_IN_TIME.format(delay=30)},
copies AS (SELECT customer_name, moment - moment % 7 - 7 * k AS begin, value FROM in_time, range(4) r(k))
SELECT customer_name, DATE '1970-01-01' + CAST(begin AS INT) AS begin, count(*) AS n_rows,
       coalesce({total('value')}, 0) AS total_impact, begin + 28 <= max(mark) AS closed
FROM copies, final GROUP BY customer_name, begin"""

_STATUS_ROWS = """arrivals AS MATERIALIZED (
  SELECT o_custkey AS contract_id, o_orderkey AS seq, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) AS moment,
         CASE o_orderstatus WHEN 'P' THEN 'PENDING' WHEN 'F' THEN 'EXTRACTED' ELSE 'FAILED' END AS status,
         CASE WHEN o_orderdate < DATE '1998-01-01' THEN 0 ELSE 1 END + CASE WHEN o_orderkey % 20 = 7 THEN 1 ELSE 0 END AS wave
  FROM orders
)"""


def _lifecycle(rows: str, passed: str) -> str:
    return f"""judged AS (
  SELECT *, (status = 'PENDING') <> coalesce(lag(status = 'PENDING') OVER (
           PARTITION BY contract_id ORDER BY moment, seq), FALSE) AS legal FROM {rows}
), legal AS (
  SELECT *, lead(moment) OVER (PARTITION BY contract_id ORDER BY moment, seq) AS next FROM judged WHERE legal
), log AS (
  SELECT contract_id, moment, status, seq, CASE WHEN legal THEN 'CHANGE' ELSE 'REJECTED' END AS kind FROM judged
  UNION ALL
  SELECT contract_id, moment + 30, 'OVERDUE', seq, 'OVERDUE' FROM legal
  WHERE status = 'PENDING' AND {passed} AND (next IS NULL OR next > moment + 30)
)"""


_LOG = "SELECT contract_id, DATE '1970-01-01' + CAST(moment AS INT) AS day, status, seq, kind FROM log"

ORACLE["contract_lifecycle"] = f"""
WITH {_STATUS_ROWS}, {_lifecycle("arrivals", "TRUE")} {_LOG}"""

ORACLE["stream_lifecycle"] = f"""
WITH {_STATUS_ROWS}, {_IN_TIME.format(delay=60)},
ripe AS (SELECT i.* FROM in_time i, final f WHERE i.moment < f.mark),
{_lifecycle("ripe", "moment + 30 < (SELECT mark FROM final)")} {_LOG}"""

ORACLE["overdue_contracts"] = f"""
WITH {_STATUS_ROWS}, {_lifecycle("arrivals", "TRUE")}
SELECT contract_id, arg_max(status, nth) AS status, count(*) FILTER (WHERE kind = 'OVERDUE') AS times_overdue
FROM (SELECT *, row_number() OVER (PARTITION BY contract_id ORDER BY moment, kind <> 'OVERDUE', seq) AS nth
      FROM log WHERE kind <> 'REJECTED')
GROUP BY contract_id"""

ORACLE = {name: re.sub(r"\n\s*\n", "\n", sql).strip() for name, sql in ORACLE.items()}
