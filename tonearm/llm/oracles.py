"""DuckDB SQL for the operators that SQL can express on whole tables in reasonable time."""

ORACLES: dict[str, str] = {
    "op6_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), f AS (
            SELECT payload_digest, min(page_id) AS least FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN least IS NULL OR least = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN least IS NULL OR least = page_id THEN NULL ELSE least END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    "op12_fill_in_middle": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents
        ), c AS (
            SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
                   CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
                        WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM d
        ), p AS (
            SELECT doc_id, text, n, form, least(a, b) AS low, greatest(a, b) AS high,
                   '<P>' || substr(text, 1, least(a, b)) AS prefix,
                   '<M>' || substr(text, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
                   '<S>' || substr(text, greatest(a, b) + 1) AS suffix
            FROM c
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN prefix || suffix || middle
                                ELSE suffix || prefix || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p
    """,
    "op13_lexical_search": """
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS terms
            FROM documents
        ), t AS (SELECT k, doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0
        ), totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM t
        ), i AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term
            FROM benchmark
        ), f AS (
            SELECT k, doc_id, n, term, count(*) AS tf
            FROM (SELECT k, doc_id, n, unnest(terms) AS term FROM t)
            WHERE term IN (SELECT term FROM i) GROUP BY ALL
        ), w AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM f, totals GROUP BY term
        ), s AS (
            SELECT item_id, k, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
            FROM i JOIN f USING (term) JOIN w USING (term), totals
            GROUP BY item_id, k, doc_id
        ), r AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
                   doc_id, score
            FROM s WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
    """,
}
