"""DuckDB SQL for the queries that SQL can express, each written independently."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op5_chats": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS position FROM turns
        ), prefixes AS (
            SELECT *, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY position) AS so_far,
                count(*) OVER (PARTITION BY conv_id) AS n_turns
            FROM numbered
        ), wholes AS (
            SELECT min(conv_id) AS conv_id, count(*) AS n_logged, so_far
            FROM prefixes WHERE position = n_turns GROUP BY so_far
        ), kept AS (
            SELECT conv_id, n_logged FROM wholes
            WHERE so_far NOT IN (SELECT so_far FROM prefixes WHERE position < n_turns)
        )
        SELECT p.conv_id, p.position, p.n_turns, k.n_logged,
            '<|' || p.role || '|>' || chr(10) || p.text || chr(10) || '<|end|>' || chr(10) AS rendered
        FROM prefixes p JOIN kept k USING (conv_id)
    """,
    "op7_warc": r"""
        WITH rows AS (
            SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM rows
        ), judged AS (
            SELECT *, payload_bytes >= 100 AND first IS NOT NULL AND first IS DISTINCT FROM page_id AS again FROM firsts
        )
        SELECT page_id, payload_bytes, sha256(payload) AS payload_digest,
            CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN again THEN first END AS refers_to, CAST(NULL AS VARCHAR) AS error
        FROM judged
    """,
    "op8_substrings": rf"""
        WITH docs AS (
            SELECT doc_id, {_WORDS} AS words FROM documents
        ), windows AS (
            SELECT doc_id, i AS start, array_to_string(words[i:i + 19], ' ') AS content
            FROM docs, unnest(range(1, len(words) - 18)) AS t(i) WHERE len(words) >= 20
        ), later AS (
            SELECT doc_id, start FROM windows
            QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, start) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, start + k AS place FROM later, range(20) AS r(k)
        ), places AS (
            SELECT doc_id, i AS place, words[i] AS word FROM docs, unnest(range(1, len(words) + 1)) AS t(i)
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS rest, count(*) AS n
            FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
            sha256(coalesce(rest, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)
    """,
    "op12_resampling": r"""
        WITH RECURSIVE steps AS (
            SELECT b, b AS crc, 0 AS step FROM range(256) AS t(b)
            UNION ALL
            SELECT b, CASE crc & 1 WHEN 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, step + 1
            FROM steps WHERE step < 8
        ), crcs AS (
            SELECT list(crc ORDER BY b) AS by_byte FROM steps WHERE step = 8
        ), words AS (
            SELECT doc_id, false AS aimed, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
            UNION ALL
            SELECT NULL, true, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
        ), counted AS (
            SELECT doc_id, aimed, word, count(*) AS n FROM words GROUP BY ALL
        ), digits AS (
            SELECT word, hex(encode(word)) AS code FROM (SELECT DISTINCT word FROM counted)
        ), hashes AS (
            SELECT word, xor(4294967295, list_reduce(
                list_transform(range(1, len(code), 2),
                    lambda i: 16 * (strpos('0123456789ABCDEF', code[i]) - 1) + strpos('0123456789ABCDEF', code[i + 1]) - 1),
                lambda crc, b: xor(by_byte[(xor(crc, b) & 255) + 1], crc >> 8),
                4294967295)) % 10000 AS bucket
            FROM digits, crcs
        ), buckets AS (
            SELECT b AS bucket, coalesce(sum(n) FILTER (NOT aimed), 0) AS s, coalesce(sum(n) FILTER (aimed), 0) AS t
            FROM range(10000) AS r(b) LEFT JOIN (counted JOIN hashes USING (word)) ON bucket = b GROUP BY b
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM buckets
        ), weights AS (
            SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
            FROM counted JOIN hashes USING (word) JOIN gains USING (bucket) WHERE NOT aimed GROUP BY doc_id
        ), scores AS (
            SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln((
                    ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
            FROM documents d LEFT JOIN weights w USING (doc_id)
        ), drawn AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS position, count(*) OVER () AS n
            FROM scores WHERE n_features >= 20
        )
        SELECT s.doc_id, n_features, weight, score,
            CASE WHEN position <= 10 * n // 100 THEN position END AS rank
        FROM scores s LEFT JOIN drawn USING (doc_id)
    """,
}
