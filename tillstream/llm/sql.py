"""SQL forms of the operators' queries."""

from __future__ import annotations

_ASCII_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = _ASCII_LOWER.format("text")

URL_FILTER = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path
  FROM (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host, '(^|[^a-z0-9])(casino|gambling|porn|spam|viagra)([^a-z0-9]|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

EXACT_DEDUP = f"""
WITH docs AS (SELECT doc_id, sha256({_NORMAL}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM docs WINDOW same AS (PARTITION BY text_sha256)
"""

LINE_DEDUP = f"""
WITH tiles AS (
  SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''),
           '(?:[^\\n.!?]+|[.!?]+[^\\n.!? \\t])*(?:[.!?]+[ \\t]+|[.!?]*\\n|[.!?]*\\z)'), lambda t: t <> '') AS parts
  FROM documents
), units AS (
  SELECT doc_id, nr, parts[nr] AS unit, coalesce(list_sum(list_transform(parts[1:nr - 1], lambda p: length(p))), 0) AS start,
         trim(regexp_replace({_ASCII_LOWER.format('parts[nr]')}, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS normal
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS nr FROM tiles)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY nr) AS place, len(string_split(normal, ' ')) AS words,
         row_number() OVER (PARTITION BY normal ORDER BY doc_id, nr) > 1 AS later
  FROM units WHERE normal <> ''
), runs AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id, run) AS run_words
  FROM (SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM ranked WHERE later)
), removed AS (SELECT doc_id, nr, true AS gone FROM runs WHERE run_words >= 25),
marked AS (SELECT doc_id, nr, unit, start, coalesce(gone, false) AS gone FROM units LEFT JOIN removed USING (doc_id, nr)),
changed AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
         string_agg(start::BIGINT || '+' || length(unit), ',' ORDER BY nr) FILTER (gone) AS removed,
         string_agg(unit, '' ORDER BY nr) FILTER (NOT gone) AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed, coalesce(c.text, '') AS text
FROM documents d LEFT JOIN changed c USING (doc_id)
"""

_WORDS = f"list_filter(regexp_split_to_array({_NORMAL}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, words FROM (SELECT item_id, {_WORDS} AS words FROM benchmark) WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n,
         array_to_string(list_slice(words, pos, pos + least(len(words), 10) - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos FROM items)
),
spans AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT doc_id, n, pos, array_to_string(list_slice(words, pos, pos + n - 1), ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS pos FROM docs, spans WHERE len(words) >= n)
),
hits AS (SELECT doc_id, pos, n, item_id FROM runs JOIN windows USING (n, win)),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS pos FROM hits) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

ARCHIVES = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
sized AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM payloads),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM sized)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 100 OR first = page_id THEN NULL ELSE first END AS refers_to
FROM firsts
"""

_UNITS = "regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+')"

FILL_IN_MIDDLE = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, {_UNITS} AS units, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), numbers AS (
  SELECT *, len(units) AS n, list_transform(range(4), lambda i: CAST('0x' || substr(h, CAST(8 * i + 1 AS BIGINT), 8) AS BIGINT)) AS hs FROM docs
), cuts AS (
  SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 50
              THEN 'plain' WHEN hs[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix
  FROM cuts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
