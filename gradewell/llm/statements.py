"""DuckDB statements for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

PREFERENCE_FORMAT = r"""
WITH t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, role, text
    FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
),
answers AS (SELECT conv_id, max(k) AS last, arg_max(text, k) AS text FROM t WHERE role = 'assistant' GROUP BY conv_id),
pairs AS (
    SELECT c.conv_id, a.last, b.text, b.conv_id IS NOT NULL AS has_other
    FROM (SELECT DISTINCT conv_id FROM t) c LEFT JOIN answers a USING (conv_id) LEFT JOIN answers b ON b.conv_id = xor(c.conv_id, 1)
),
sides AS (
    SELECT 'c' AS side, conv_id, k, role, text FROM t
    UNION ALL
    SELECT 'r', t.conv_id, k, role, CASE WHEN k = last THEN p.text ELSE t.text END
    FROM t JOIN pairs p USING (conv_id) WHERE last IS NULL OR has_other OR k < last
),
shared AS (
    SELECT c.conv_id, coalesce(min(c.k) FILTER (r.k IS NULL OR c.text IS DISTINCT FROM r.text) - 1, max(c.k)) AS n
    FROM sides c LEFT JOIN sides r ON r.side = 'r' AND r.conv_id = c.conv_id AND r.k = c.k
    WHERE c.side = 'c' GROUP BY c.conv_id
),
rendered AS (
    SELECT side, s.conv_id, k, n, role, '<|' || coalesce(role, '') || '|>' || chr(10) AS head, coalesce(text, '') || '<|end|>' AS body
    FROM sides s JOIN shared USING (conv_id)
),
placed AS (
    SELECT *, coalesce(sum(CASE WHEN k > n THEN length(head || body) + 1 ELSE 0 END)
                       OVER (PARTITION BY side, conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
    FROM rendered
),
joined AS (
    SELECT side, conv_id, any_value(n) AS n,
           coalesce(string_agg(head || body || chr(10), '' ORDER BY k) FILTER (k <= n), '') AS prompt,
           coalesce(string_agg(head || body || chr(10), '' ORDER BY k) FILTER (k > n), '') AS rest,
           coalesce(string_agg((pos + length(head)) || '-' || (pos + length(head || body)), ',' ORDER BY k)
                    FILTER (k > n AND role = 'assistant'), '') AS mask
    FROM placed GROUP BY side, conv_id
)
SELECT c.conv_id, c.n AS prompt_turns, c.prompt, c.rest AS chosen, c.mask AS chosen_mask, coalesce(r.rest, '') AS rejected,
       coalesce(r.mask, '') AS rejected_mask
FROM joined c LEFT JOIN joined r ON r.side = 'r' AND c.conv_id = r.conv_id WHERE c.side = 'c'
"""

LINE_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT u, unnest(ls) AS line, unnest(range(len(ls))) AS place FROM d),
k AS (
    SELECT u, place, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l
),
frequent AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT u) >= 10),
kept AS (
    SELECT u, string_agg(line, chr(10) ORDER BY place) AS text, count(*) AS n
    FROM k WHERE NOT EXISTS (SELECT 1 FROM frequent f WHERE f.key = k.key) GROUP BY u
)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - coalesce(n, 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (u)
"""

DECONTAMINATION = r"""
WITH folded AS (
    SELECT row_number() OVER () AS u, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
),
items AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark
),
asked AS (
    SELECT DISTINCT item, size, array_to_string(ws[i:i + size - 1], ' ') AS win
    FROM (SELECT item, ws, least(10, len(ws)) AS size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
          FROM items WHERE len(ws) > 0)
),
there AS (
    SELECT u, i, size, array_to_string(ws[i:i + size - 1], ' ') AS win
    FROM (SELECT u, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM folded, (SELECT DISTINCT size FROM asked))
),
found AS (SELECT DISTINCT u, i, size, item FROM there JOIN asked USING (size, win)),
hits AS (SELECT u, count(DISTINCT p) AS n FROM (SELECT u, unnest(range(i, i + size)) AS p FROM found) GROUP BY u),
named AS (
    SELECT u, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT u, item FROM found WHERE item IS NOT NULL) GROUP BY u
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM folded LEFT JOIN hits USING (u) LEFT JOIN named USING (u)
"""

#: Repeated windows by grouping, the rules of the cascade in plain form.
QUALITY_RULES = r"""
WITH texts AS (SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS t FROM documents),
worded AS (SELECT u, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM texts),
windows AS (
    SELECT u, i, array_to_string(ws[i:i + 4], ' ') AS win
    FROM (SELECT u, ws, unnest(range(1, len(ws) - 3)) AS i FROM worded)
),
twice AS (SELECT u, i FROM windows QUALIFY count(*) OVER (PARTITION BY u, win) > 1),
covered AS (
    SELECT u, sum(least(5, gap)) AS n
    FROM (SELECT u, i - lag(i, 1, -5) OVER (PARTITION BY u ORDER BY i) AS gap FROM twice) GROUP BY u
),
lines AS (
    SELECT u, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup
    FROM (SELECT u, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM worded)
),
measured AS (
    SELECT doc_id, len(ws) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(n_dup AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, n_lines,
           length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS n_letters, length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_upper
    FROM worded JOIN lines USING (u) LEFT JOIN covered USING (u)
),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words
            OR 10 * n_dup_lines > 3 * n_lines OR 2 * n_upper > word_chars OR 2 * n_letters < word_chars) AS kept
FROM base
"""

#: Every rule against every page.
URL_FILTER = r"""
WITH rules(verdict, host, path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
           ('block', 'net', '/es/'), ('block', 'net', '/fr/')
),
cut AS (SELECT row_number() OVER () AS u, page_id, regexp_extract(url, '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
parts AS (
    SELECT u, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
),
best AS (
    SELECT u, arg_max(r.host || r.path, (length(r.host || r.path), length(r.host))) AS rule,
           arg_max(r.verdict, (length(r.host || r.path), length(r.host))) AS verdict
    FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY u
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (u)
"""

STATEMENTS: dict[str, str] = {
    "op1_url_filter": URL_FILTER,
    "op4_preference_format": PREFERENCE_FORMAT,
    "op5_line_dedup": LINE_DEDUP,
    "op7_decontamination": DECONTAMINATION,
    "op9_quality_rules": QUALITY_RULES,
}
