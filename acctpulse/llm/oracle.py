"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

OP5 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
runs AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + 12], ' ') AS run
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i
        FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM words, (SELECT DISTINCT n FROM runs) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, runs.n FROM places JOIN runs USING (run, n)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


OP2 = """
WITH facts AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest, coalesce(html, '') AS payload FROM pages),
largest AS (
  SELECT payload, max(page_id) AS response FROM facts WHERE payload_bytes >= 1000 GROUP BY payload)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN response IS NULL OR response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to, true AS verified
FROM facts LEFT JOIN largest USING (payload)
"""

OP6 = r"""
WITH parts AS (
  SELECT page_id, url, CASE WHEN contains(url, '://')
    THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, url, regexp_extract(rest, '^[^/?#]*') AS h, rest FROM parts),
placed AS (
  SELECT page_id, url,
    translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM hosts),
rules(rule, verdict) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'),
  ('example.com/de/', 'block'), ('org/fr/', 'allow')),
cut AS (SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host,
  substr(rule, length(split_part(rule, '/', 1)) + 1) AS rule_path FROM rules),
best AS (
  SELECT page_id, url, max(length(rule)) AS size, arg_max(rule, length(rule)) AS rule,
    arg_max(verdict, length(rule)) AS verdict
  FROM placed JOIN cut ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path) GROUP BY page_id, url)
SELECT p.page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  coalesce(b.verdict, CASE WHEN regexp_matches(split_part(regexp_replace(lower(coalesce(p.url, '')),
    '^[^:/?#]*://', '//'), '/', 3),
    '(^|[^a-z0-9])(spam|casino|porn|xxx|viagra|warez|phishing|malware)($|[^a-z0-9?#][^?#]*|[?#])')
    THEN 'block' ELSE 'allow' END) AS verdict
FROM placed p LEFT JOIN best b ON p.page_id = b.page_id AND p.url = b.url
"""

#: CRC-32 bit by bit, the costs to go row by row from the end, then the audit read back.
OP11 = r"""
WITH RECURSIVE crc AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda c: CAST(ord(c) AS BIGINT))),
      lambda h, b: list_reduce(list_prepend(xor(h, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS rest
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN rest = 4 THEN 'user' ELSE role END AS role,
    CASE rest WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM crc, generate_series(1, 2) AS copies(k) WHERE rest <> 0 AND (k = 1 OR rest = 3)),
numbered AS (
  SELECT *, substr(role, 1, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
  FROM damaged),
faulty AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS earlier,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault
  FROM numbered),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
inserted(q, prefix, q2) AS (
  VALUES (0, '', 0), (0, 'I', 2), (0, 'II', 3), (0, 'III', 2), (1, '', 1), (1, 'I', 2), (1, 'II', 3), (1, 'III', 2),
    (2, '', 2), (2, 'I', 3), (2, 'II', 2), (2, 'III', 3), (3, '', 3), (3, 'I', 2), (3, 'II', 3), (3, 'III', 2)),
edits(q2, edit, price, needs, next) AS (
  VALUES (0, 'D', 3, NULL, 0), (1, 'D', 3, NULL, 1), (2, 'D', 3, NULL, 2), (3, 'D', 3, NULL, 3),
    (0, 'R', 2, NULL, 2), (1, 'R', 2, NULL, 2), (2, 'R', 2, NULL, 3), (3, 'R', 2, NULL, 2),
    (0, 'K', 0, 's', 1), (0, 'K', 0, 'u', 2), (1, 'K', 0, 'u', 2), (2, 'K', 0, 'a', 3), (3, 'K', 0, 'u', 2)),
moves AS (
  SELECT q, prefix || edit AS told, edit, 2 * length(prefix) + price AS price, needs, next
  FROM inserted JOIN edits USING (q2)),
solved AS (
  SELECT conv_id, n AS i, q, best FROM facts, (
    VALUES (0, {'c': 0::BIGINT, 'a': ''}), (1, {'c': 4::BIGINT, 'a': 'II'}), (2, {'c': 2::BIGINT, 'a': 'I'}), (3, {'c': 0::BIGINT, 'a': ''})) AS ends(q, best)
  UNION ALL
  SELECT s.conv_id, s.i - 1, m.q, min({'c': s.best.c + m.price
      + CASE WHEN f.fault = 'truncated' AND m.edit <> 'D' THEN 1 ELSE 0 END, 'a': m.told || s.best.a})
  FROM solved AS s JOIN faulty AS f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i
    JOIN moves AS m ON m.next = s.q AND (m.needs IS NULL OR m.needs = f.initial)
      AND (m.edit = 'D' OR f.fault IN ('none', 'truncated'))
  GROUP BY s.conv_id, s.i, m.q),
cheapest AS (SELECT conv_id, best.c AS cost, best.a AS audit FROM solved WHERE i = 0 AND q = 0),
steps AS (
  SELECT conv_id, k, edit, sum(CAST(edit <> 'I' AS INT)) OVER w AS i, sum(CAST(edit <> 'D' AS INT)) OVER w AS e
  FROM (SELECT conv_id, k, substr(audit, k, 1) AS edit
        FROM (SELECT conv_id, audit, unnest(generate_series(1, length(audit))) AS k FROM cheapest))
  WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
placed AS (
  SELECT s.conv_id, k, edit, e, f.role, f.text,
    max(CAST(e = 1 AND edit = 'K' AND f.initial = 's' AS INT)) OVER (PARTITION BY s.conv_id) AS leads
  FROM steps AS s LEFT JOIN faulty AS f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i AND s.edit <> 'I'
  WHERE edit <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (e - leads) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS told
  FROM placed GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(f.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(f.blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(f.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(f.truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(f.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(c.cost, 0) AS BIGINT) AS cost,
  coalesce(c.audit, '') AS audit, sha256(coalesce(r.told, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
  LEFT JOIN facts AS f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN cheapest AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN repaired AS r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def statements() -> dict[str, str]:
    return {
        "op2_warc": OP2, "op5_decontamination": OP5, "op6_url_filter": OP6,
        "op11_conversation_repair": OP11,
    }
