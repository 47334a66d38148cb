"""DuckDB SQL that gives the same rows as the registered queries of the same name."""

from __future__ import annotations

from ebbline.llm.chat import HOSTILE

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PARTS = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"

# Five hexadecimal digits are four digits of base 32.
_BASE32 = " || ".join(
    f"substr('{_DIGITS}', CAST((CAST('0x' || substr(sha1(html), {5 * part + 1}, 5) AS INTEGER) >> {shift}) & 31 AS INTEGER) + 1, 1)"
    for part in range(8)
    for shift in (15, 10, 5, 0)
)

WARC = f"""
WITH filled AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
last AS (SELECT html, max(page_id) AS response FROM filled GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to, url
FROM filled JOIN last USING (html)"""

URLS = f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), {_PARTS}, 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), {_PARTS}, 2) AS path
  FROM pages),
hosts AS (SELECT host, count(*) FILTER (WHERE contains(url, '?')) * 2 >= count(*) AS listed FROM parts GROUP BY host),
ruled AS (
  SELECT page_id, host, path, listed,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts JOIN hosts USING (host))
SELECT page_id, host, path, rule, listed,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""

_ESCAPED = r"length({0}) + length(regexp_replace({0}, '[^\[<\\]', '', 'g'))"

_ESCAPE = r"regexp_replace({}, '([\[<\\])', '\1\\', 'g')"

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{HOSTILE}' UNION ALL SELECT -1, 1, 'assistant', '{HOSTILE}'),
formatted AS (
  SELECT *, CASE role WHEN 'user' THEN '[INST] ' || {_ESCAPE.format("text")} || ' [/INST]'
    WHEN 'assistant' THEN '<s>' || {_ESCAPE.format("text")} || '</s>'
    ELSE '[ROLE] ' || {_ESCAPE.format("role")} || ' [TEXT] ' || {_ESCAPE.format("text")} || ' [/ROLE]' END AS segment
  FROM turns),
streams AS (
  SELECT *, coalesce(string_agg(segment, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS context FROM formatted)
SELECT conv_id, count(*) AS n_turns,
  count(*) FILTER (WHERE role = 'assistant') AS n_examples,
  CAST(coalesce(sum(length(context)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS context_chars,
  sha256(coalesce(string_agg(sha256(context) || chr(10), '' ORDER BY turn, role, text, length(context))
    FILTER (WHERE role = 'assistant'), '')) AS contexts_sha256,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_ESCAPED.format("text")} + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
    ELSE 23 + {_ESCAPED.format("role")} END) AS BIGINT) AS formatted_chars
FROM streams GROUP BY conv_id"""

# CRC-32 of the decimal digits: a step per digit (its code) and eight per bit (-1).
_CRC32 = """xor(4294967295, list_reduce([4294967295] || flatten(list_transform(range(1, length(name) + 1),
  lambda i: [ord(name[i]), -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END))"""

TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS name FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
strings AS (
  SELECT conv_id, coalesce(list(length(role) || ':' || role || text ORDER BY own, place) FILTER (WHERE text IS NOT NULL), []) AS keys,
    coalesce(list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY own, place) FILTER (WHERE text IS NOT NULL), []) AS words
  FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
prefixes AS (
  SELECT conv_id, depth, len(keys) = depth AS ends, keys[1:depth] AS key, coalesce(words[depth], 0) AS words
  FROM strings, LATERAL (SELECT unnest(range(0, len(keys) + 1)) AS depth)),
nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY key, depth),
children AS (SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
linked AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (key)),
subtrees AS (
  SELECT key[1:above] AS key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM linked, LATERAL (SELECT unnest(range(0, depth + 1)) AS above) GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM linked n JOIN subtrees s ON s.key = n.key LEFT JOIN nodes p ON n.depth > 0 AND p.key = n.key[1:n.depth - 1] AND p.depth = n.depth - 1"""

_SCORE = "(1000000::HUGEINT * a * a) // ({0}::HUGEINT * {1})"

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f1 AS (SELECT lang, w1, count(*) AS f FROM (SELECT lang, unnest(w) AS w1 FROM pieces) GROUP BY ALL),
f2 AS (
  SELECT lang, w1, w2, count(*) AS a
  FROM (SELECT lang, w[i] AS w1, w[i + 1] AS w2 FROM pieces, LATERAL (SELECT unnest(range(1, len(w))) AS i)) GROUP BY ALL HAVING a >= 10),
f3 AS (
  SELECT lang, w1, w2, w3, count(*) AS a
  FROM (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM pieces, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i))
  GROUP BY ALL HAVING a >= 10),
inside AS (
  SELECT lang, w1, w2, max(a) AS longest
  FROM (SELECT lang, w1, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL),
found AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, a, x.f AS l, y.f AS r, {_SCORE.format("x.f", "y.f")} AS score
  FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w2
    LEFT JOIN inside i ON i.lang = p.lang AND i.w1 = p.w1 AND i.w2 = p.w2
  WHERE longest IS NULL OR 100 * longest < 50 * a
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s2 < s1 THEN l2 ELSE l1 END, CASE WHEN s2 < s1 THEN r2 ELSE r1 END, least(s1, s2)
  FROM (
    SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.a, x.f AS l1, q.a AS r1, p.a AS l2, z.f AS r2,
      {_SCORE.replace("a * a", "t.a * t.a").format("x.f", "q.a")} AS s1, {_SCORE.replace("a * a", "t.a * t.a").format("p.a", "z.f")} AS s2
    FROM f3 t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f1 z ON z.lang = t.lang AND z.w1 = t.w3
      JOIN f2 p ON p.lang = t.lang AND p.w1 = t.w1 AND p.w2 = t.w2 JOIN f2 q ON q.lang = t.lang AND q.w1 = t.w2 AND q.w2 = t.w3)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM found)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000"""

ORACLES: dict[str, str] = {"op3_warc": WARC, "op4_urls": URLS, "op9_chat": CHAT, "op11_collocations": COLLOCATIONS, "op13_prefixtrie": TRIE}
