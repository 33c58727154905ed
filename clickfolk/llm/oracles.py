"""What the registered queries must return, in DuckDB SQL."""

from clickfolk.llm.pii import IBAN_LENGTHS, THRESHOLD

_WORDS = "[^\\x20\\x09-\\x0D]+"

# kind, order, pattern as the contract has it, condition on the match v (d: its digits, l and r: the text around)
_KINDS = [
    ("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", 1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     "len(list_filter(string_split(v, '.'), lambda p: try_cast(p AS DOUBLE) > 255)) = 0"),
    ("card", 2, r"[0-9]([\x20-]?[0-9])+",
     "length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN "
     "CAST(reverse(d)[i] AS INT) ELSE (CAST(reverse(d)[i] AS INT) * 2) // 10 + (CAST(reverse(d)[i] AS INT) * 2) % 10 END)) % 10 = 0"),
    ("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 10 AND 15"),
    ("iban", 4, r"[A-Z]{2}[0-9]{2}([A-Z0-9]{11,30}|( [A-Z0-9]{4}){2,7}( [A-Z0-9]{1,3})?)",
     "NOT regexp_matches(l, '[A-Za-z0-9]$') AND NOT regexp_matches(r, '^[A-Za-z0-9]') AND length(replace(v, ' ', '')) = CASE "
     "substr(v, 1, 2) " + " ".join(f"WHEN '{c}' THEN {n}" for c, n in IBAN_LENGTHS.items()) + " ELSE 0 END AND "
     "list_reduce(list_prepend(0, list_transform(range(1, length(replace(v, ' ', '')) + 1), lambda i: "
     "ascii((substr(replace(v, ' ', ''), 5) || substr(replace(v, ' ', ''), 1, 4))[i]))), lambda a, c: CASE WHEN c < 58 THEN "
     "(a * 10 + c - 48) % 97 ELSE (a * 100 + c - 55) % 97 END) = 1"),
    ("ssn", 5, r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
     "NOT regexp_matches(l, '[A-Za-z0-9]$') AND NOT regexp_matches(r, '^[A-Za-z0-9]') AND NOT regexp_matches(v, "
     f"'^(000|666|9)|-00-|-0000$') AND {0.3 + 0.5 >= THRESHOLD} AND regexp_matches(right(l, 48) || ' ' || left(r, 24), "
     "'(?i)\\bssn\\b|social security')"),
]

_MATCHES = """SELECT row_no, '{kind}' AS kind, {order} AS o, v, b FROM (
  SELECT *, regexp_replace(v, '[^0-9]', '', 'g') AS d FROM (
    SELECT row_no, f[i] AS v, g[i] AS l, g[i + 1] AS r,
      coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS b
    FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM (
      SELECT row_no, regexp_extract_all(t, '{pattern}') AS f, regexp_split_to_array(t, '{pattern}') AS g FROM d))))
  WHERE {valid}"""

PII = """WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS t FROM documents),
m AS (""" + " UNION ALL ".join(
    _MATCHES.format(kind=k, order=o, pattern=p, valid=v) for k, o, p, v in _KINDS) + """),
s AS (SELECT row_no, count(*) FILTER (o = 0) AS e, count(*) FILTER (o = 1) AS i, count(*) FILTER (o = 2) AS c,
  count(*) FILTER (o = 3) AS p, string_agg(kind || ':' || CAST(b AS BIGINT) || ':' || CAST(b + length(v) AS BIGINT), ',' ORDER BY b, o)
  FILTER (o < 4) AS base, string_agg(kind || ':' || CAST(b AS BIGINT) || ':' || CAST(b + length(v) AS BIGINT), ',' ORDER BY b, o) AS a
  FROM m GROUP BY row_no)
SELECT doc_id, coalesce(e, 0) AS n_email, coalesce(i, 0) AS n_ip, coalesce(c, 0) AS n_card, coalesce(p, 0) AS n_phone,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(a, '') AS spans FROM d LEFT JOIN s USING (row_no)"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM late),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS x FROM d),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.k) FILTER (gone.k IS NULL) AS t, count(*) AS n,
  count(gone.k) AS g FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.k = word.k GROUP BY word.doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(g, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id"""

_ESCAPES = r"len(regexp_extract_all({0}, '\\|</?s>|\[/?INST\]|\[ROLE\]'))"
CHATS = f"""
WITH r AS (SELECT conv_id, turn, role, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || x || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(x) + {_ESCAPES.format("x")} + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5
    ELSE 14 + length(role) + {_ESCAPES.format("role")} END) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""

FILTER_AUDIT = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_WORDS}') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
  100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
  coalesce(doc_id > least, false)] AS fails FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
one AS (SELECT unnest(range(1, 6)) AS k),
o AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS ks FROM one a JOIN one b ON b.k <> a.k JOIN one c ON c.k NOT IN (a.k, b.k)
  JOIN one d ON d.k NOT IN (a.k, b.k, c.k) JOIN one e ON e.k NOT IN (a.k, b.k, c.k, d.k)),
s AS (SELECT ks, array_to_string(list_transform(ks, lambda k: substr('ABCDE', k, 1)), '') AS filter_order,
  unnest(range(1, 6)) AS step FROM o),
r AS (SELECT part, filter_order, step, ks[step] AS k, n, good, bad, fails[ks[step]] AS own, len(list_filter(fails, lambda x: x)) AS many,
  len(list_filter(ks[1:step - 1], lambda k: fails[k])) > 0 AS gone FROM s CROSS JOIN c),
p AS (SELECT part, filter_order, step, k,
  CAST(coalesce(sum(n) FILTER (NOT gone AND NOT own), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (NOT gone AND own), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (gone AND own), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (own AND many = 1), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (NOT gone AND own), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(bad) FILTER (NOT gone AND own), 0) AS BIGINT) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM p"""

URL_FILTERS = """
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS u FROM pages),
h AS (SELECT page_id, translate(regexp_extract(u, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
m AS (SELECT page_id, host, path, CASE
  WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
  WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
  WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
  WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM m"""
