"""DuckDB SQL with the same rows as the queries, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op4_exact_dedup": r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
    FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM texts
""",
    "op5_embedding_neardup": """
WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = least.a
""",
    "op6_ngram_jaccard": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(
        regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1),
            lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        END AS shingles
    FROM words
), sized AS (
    SELECT doc_id, len(shingles) AS n, shingles FROM sets
), postings AS (
    SELECT doc_id, n, unnest(shingles) AS s FROM sized
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n - count(*) AS together, count(*) AS shared
    FROM postings a JOIN postings b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
), links AS (
    SELECT a, b FROM pairs WHERE 100 * shared >= 90 * together
    UNION ALL
    SELECT b, a FROM pairs WHERE 100 * shared >= 90 * together
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT sized.doc_id, n AS n_shingles, least_id AS component_id
FROM sized JOIN (SELECT a, min(b) AS least_id FROM reach GROUP BY a) ON sized.doc_id = a
""",
    "op10_warc": """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), firsts AS (
    SELECT *, CASE WHEN strlen(payload) >= 100 THEN min(page_id) OVER (PARTITION BY payload)
        ELSE page_id END AS first_id
    FROM payloads
)
SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
""",
    "op12_line_rules": r"""
WITH texts AS (
    SELECT doc_id, source, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
           unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g
    FROM texts
), repeated AS (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT doc_id, CAST(sum(least(3, i - coalesce(last, i - 3))) AS BIGINT) AS n FROM repeated GROUP BY doc_id
), lines AS (
    SELECT doc_id, source, t, translate(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS line,
        len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n
    FROM (SELECT doc_id, source, t, unnest(lines) AS line FROM texts)
), frequent AS (
    SELECT source, line FROM lines GROUP BY source, line HAVING count(DISTINCT t) > 10
), lost AS (
    SELECT doc_id, CAST(sum(n) AS BIGINT) AS n FROM lines JOIN frequent
    ON lines.source IS NOT DISTINCT FROM frequent.source AND lines.line = frequent.line GROUP BY doc_id
), counted AS (
    SELECT texts.doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS n_removed_words
    FROM texts LEFT JOIN covered ON texts.doc_id = covered.doc_id LEFT JOIN lost ON texts.doc_id = lost.doc_id
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND 2 * n_removed_words <= n_words AS kept
FROM counted
""",
}
