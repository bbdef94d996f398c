"""SQL, as DuckDB runs it, for the queries that SQL can express. Words and windows are spelt out, nothing is hashed."""

from __future__ import annotations

from marketlane.llm import chat, collocations, line_dedup, ranked_search, sharding, url_filter

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ASCII_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH items AS (SELECT item_id, {_ASCII_WORDS} AS w FROM benchmark),
item_places AS (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS k FROM items WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, len(w[k:k + 9]) AS n, array_to_string(w[k:k + 9], ' ') AS p FROM item_places),
lengths AS (SELECT DISTINCT n FROM phrases),
docs AS (SELECT doc_id, {_ASCII_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, lengths),
windows AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS p FROM places),
occurrences AS (SELECT w.doc_id, w.n, w.k, p.item_id FROM windows AS w JOIN phrases AS p ON w.p = p.p AND w.n = p.n),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM occurrences) AS o GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occurrences WHERE item_id IS NOT NULL) AS i GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.list, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs AS d LEFT JOIN covered AS c ON d.doc_id = c.doc_id LEFT JOIN named AS i ON d.doc_id = i.doc_id
"""

OP2 = f"""
WITH docs AS (SELECT doc_id, {_SPACED.format("coalesce(text, '')")} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM docs),
ranked AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY p ORDER BY doc_id, k) AS nth
  FROM (SELECT doc_id, k, array_to_string(w[k:k + 19], ' ') AS p FROM places) AS x),
gone AS (SELECT DISTINCT doc_id, k + j AS at FROM ranked, (SELECT unnest(range(0, 20)) AS j) AS steps WHERE nth > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at FROM docs),
kept AS (
  SELECT w.doc_id, count(*) AS n_words, count(g.at) AS n_removed, string_agg(w.word, ' ' ORDER BY w.at) FILTER (WHERE g.at IS NULL) AS kept
  FROM words AS w LEFT JOIN gone AS g ON w.doc_id = g.doc_id AND w.at = g.at GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents AS d LEFT JOIN kept AS k ON d.doc_id = k.doc_id
"""

OP7 = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_SPACED.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(2, len(w)))) AS k FROM docs WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 1], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
sized AS (SELECT s.doc_id, s.s, z.n FROM shingles AS s JOIN sizes AS z ON s.doc_id = z.doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM sized AS a JOIN sized AS b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (na + nb - c)),
either AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, x.b FROM reach AS r JOIN either AS x ON r.b = x.a),
least_of AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents AS d JOIN least_of AS l ON d.doc_id = l.a LEFT JOIN sizes AS z ON d.doc_id = z.doc_id
"""

OP8 = r"""
WITH rests AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, lower_host AS host, regexp_extract(substr(r, length(lower_host) + 1), '^[^?#]*') AS path
  FROM (SELECT page_id, r, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_host FROM rests) AS x),
rules(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
globs(h, p, nth) AS (VALUES @GLOBS@),
closed AS (SELECT DISTINCT q.page_id FROM parts AS q JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
method AS (
  SELECT page_id, min_by(g.h || g.p, g.nth) AS glob
  FROM parts JOIN globs AS g ON ('.' || host) LIKE ('%.' || replace(g.h, '*', '%')) AND path LIKE (replace(g.p, '*', '%') || '%')
  WHERE page_id NOT IN (SELECT page_id FROM closed) GROUP BY page_id),
best AS (
  SELECT page_id, h || p AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS nth
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT q.page_id, q.host, q.path, b.rule, coalesce(b.verdict, CASE WHEN m.glob IS NULL THEN 'allow' ELSE 'block' END) AS verdict, m.glob
FROM parts AS q LEFT JOIN best AS b ON q.page_id = b.page_id AND b.nth = 1 LEFT JOIN method AS m ON q.page_id = m.page_id
"""
_GLOBS = [url_filter.METHOD[i] for i in url_filter.ranking(url_filter.METHOD)]
OP8 = OP8.replace("@GLOBS@", ", ".join(f"('{g.host}', '{g.path}', {k})" for k, g in enumerate(_GLOBS)))

# Base 32 of the digest: four times ten hexadecimal digits, each of which are eight characters.
_BASE32 = "list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(s, CAST(i // 8 * 10 + 1 AS BIGINT), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT) + 1, 1)), 'string_agg', '')"
OP4 = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS s, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS latest FROM pages)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM p
"""

_FULL = r"length(regexp_replace({}, '[\x20\x09-\x0D]', '', 'g'))"
OP10 = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, {_SPACED.format("coalesce(text, '')")} AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS pos FROM docs),
again AS (
  SELECT doc_id, count(*) AS n_dup_lines, sum(size) AS line_chars
  FROM (SELECT doc_id, {_FULL.format('line')} AS size, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth FROM lines) AS x
  WHERE nth > 1 AND size > 0 GROUP BY doc_id),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM docs, (SELECT unnest(range(5, 11)) AS n) AS lengths),
counted AS (SELECT doc_id, n, k, count(*) OVER (PARTITION BY doc_id, n, g) AS times FROM (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM places) AS x),
inside AS (SELECT DISTINCT doc_id, n, unnest(range(k, k + n)) AS pos FROM counted WHERE times > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM docs),
shares AS (SELECT i.doc_id, i.n, count(*) AS n_words, sum(length(word)) AS chars FROM inside AS i JOIN words AS w ON i.doc_id = w.doc_id AND i.pos = w.pos GROUP BY i.doc_id, i.n),
base AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST({_FULL.format('t')} AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(a.n_dup_lines, 0) AS n_dup_lines, coalesce(a.line_chars, 0) AS line_chars,
         coalesce((SELECT s.n_words FROM shares AS s WHERE s.doc_id = d.doc_id AND s.n = 8), 0) AS n_repeat_words
  FROM docs AS d LEFT JOIN again AS a ON d.doc_id = a.doc_id),
over AS (
  SELECT DISTINCT s.doc_id FROM shares AS s JOIN base AS b ON s.doc_id = b.doc_id
  JOIN (VALUES (5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10)) AS l(n, most) ON s.n = l.n
  WHERE CAST(s.chars AS DOUBLE) / b.word_chars > CAST(l.most AS DOUBLE)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND CAST(line_chars AS DOUBLE) / word_chars <= 0.2 AND doc_id NOT IN (SELECT doc_id FROM over) AS kept
FROM failed
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1, "op2_substring_dedup": OP2, "op5_line_dedup": line_dedup.SQL, "op6_chat_format": chat.SQL, "op7_near_dup": OP7, "op8_url_filter": OP8, "op4_warc": OP4, "op10_quality_rules": OP10, "op11_collocations": collocations.SQL, "op12_sharding": sharding.SQL, "op13_ranked_search": ranked_search.SQL}
