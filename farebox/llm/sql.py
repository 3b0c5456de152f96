"""DuckDB SQL for the queries of this package that SQL can express."""

QUALITY_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1),
spots AS (SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS p FROM grams JOIN twice USING (r, g)),
repeated AS (SELECT r, count(*) AS n FROM spots GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(regexp_extract_all(t, '\p{Lu}')) AS n_capitals, len(regexp_extract_all(t, '!')) AS n_bangs
  FROM d LEFT JOIN repeated USING (r)),
b AS (
  SELECT *, n_words < 50 AS few, 100 * n_repeat_words > 50 * n_words AS rep,
    CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
      + 8 * (n_lines >= 4 AND 2 * n_dup_lines > n_lines)::INT
      + 16 * (word_chars < 2 * n_words OR word_chars > 16 * n_words)::INT
      + 32 * (2 * n_capitals > word_chars)::INT + 64 * (2 * n_bangs > n_words)::INT AS BIGINT) AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  few OR rep AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM b"""

_KEYWORD = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
    "[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
)
_ASSIGN = _KEYWORD + r"[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
_ALLOWED = (
    r"[A-Za-z+/_=-]+|[0-9+/_=-]+|[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|"
    r"([A-Za-z]{3,}[0-9]{0,4}[/_=+-]+)+([A-Za-z]{3,}[0-9]{0,4}|[0-9]{1,4})?"
)


def _matches(rank: int, kind: str, pattern: str, keep: str) -> str:
    """Matches with their offsets: the text between them and the matches alternate."""
    return f"""
  SELECT r, {rank} AS nr, '{kind}' AS kind, until - length(body) AS begins, until, body FROM (
    SELECT r, i, body, sum(length(gap) + length(body)) OVER (PARTITION BY r ORDER BY i) AS until FROM (
      SELECT r, unnest(range(1, len(hit) + 1)) AS i, unnest(hit) AS body, unnest(gap[1:len(hit)]) AS gap FROM (
        SELECT r, regexp_extract_all(t, '{pattern}', 0) AS hit, string_split_regex(t, '{pattern}') AS gap
        FROM d WHERE regexp_matches(t, '{pattern}')))) WHERE {keep}"""


def _surprising(least: float) -> str:
    window = "list_transform(range(1, length(body) - 18), lambda i: substring(body, i::INT, 20))"
    share = "len(list_filter(string_split(v, ''), lambda y: y = c)) / 20.0"
    entropy = f"list_sum(list_transform(list_distinct(string_split(v, '')), lambda c: -({share}) * log2({share})))"
    return (
        f"NOT regexp_full_match(body, '{_ALLOWED}') AND "
        f"list_max(list_transform({window}, lambda v: {entropy})) >= {least} - 1e-9"
    )


SECRET_SCAN = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS (
  {_matches(0, "assign", _ASSIGN, f"length(regexp_extract(body, '{_ASSIGN}', 2)) >= 6")}
  UNION ALL {_matches(1, "access", "AKIA[A-Z0-9]+", "length(body) >= 20")}
  UNION ALL {_matches(2, "hex", "[0-9a-f]+", "length(body) >= 24")}
  UNION ALL {_matches(3, "entropy_hex", "[0-9a-fA-F]{24,}", _surprising(2.9))}
  UNION ALL {_matches(4, "entropy_base64", "[A-Za-z0-9+/_=-]{24,}", _surprising(3.75))}),
g AS (
  SELECT r, count(*) FILTER (WHERE nr = 0) AS a, count(*) FILTER (WHERE nr = 1) AS b, count(*) FILTER (WHERE nr = 2) AS c,
    string_agg(concat(kind, ':', begins, ':', until), ',' ORDER BY begins, nr) FILTER (WHERE nr < 3) AS base,
    string_agg(concat(kind, ':', begins, ':', until), ',' ORDER BY begins, nr) AS spans
  FROM s GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)"""

URL_FILTER = r"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
links AS (
  SELECT url AS source, unnest([
    regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'),
      '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1),
    regexp_extract(html,
      '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*\burl\s*=\s*[''"]?\s*([^"''\s>]+)', 1)]) AS target
  FROM pages),
good AS (SELECT * FROM links WHERE contains(target, '://') AND contains(source, '://')),
urls AS (SELECT DISTINCT url FROM (SELECT url FROM pages UNION ALL SELECT source FROM good UNION ALL SELECT target FROM good)),
parts AS (
  SELECT url, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path,
    regexp_replace(regexp_replace(regexp_extract(url, '\?([^#]*)', 1),
      '(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&+', '') AS q
  FROM urls),
judged AS (
  SELECT url, p.host, p.path, concat(p.host, if(p.path = '', '/', p.path), if(q <> '', '?' || q, '')) AS key,
    arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY ALL),
pairs AS (
  SELECT a.key AS a, b.key AS b FROM good JOIN judged a ON a.url = source JOIN judged b ON b.url = target),
linked AS (SELECT a, b FROM pairs WHERE a <> b UNION SELECT b, a FROM pairs WHERE a <> b),
reach AS (SELECT a, b FROM linked UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a),
inherited AS (
  SELECT reach.a AS key, bool_or(verdict = 'allow') AS allowed FROM reach JOIN judged ON judged.key = reach.b
  WHERE rule IS NOT NULL GROUP BY 1)
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NOT NULL THEN verdict WHEN NOT allowed THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN allowed IS NOT NULL THEN 'alias' ELSE 'default' END AS via
FROM pages JOIN judged ON pages.url IS NOT DISTINCT FROM judged.url LEFT JOIN inherited USING (key)"""

TOOL_CALLS = r"""
WITH t AS (SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM conversations),
c AS (
  SELECT *, sum(CASE WHEN turn - before <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS chain
  FROM (SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM t WHERE role IN ('system', 'user'))),
l AS (SELECT *, row_number() OVER (PARTITION BY conv_id, chain ORDER BY turn) - 1 AS level FROM c),
a AS (SELECT * FROM t WHERE role = 'assistant'),
j AS (
  SELECT coalesce(l.conv_id, a.conv_id) AS conv_id, concat('call_', coalesce(l.turn, a.turn - 1)) AS call_id,
    coalesce(l.turn, a.turn) AS turn, l.level AS level, l.role AS role, l.text AS said, l.words AS words, a.text AS told,
    l.turn IS NOT NULL AS called, a.turn IS NOT NULL AS answered
  FROM l FULL JOIN a ON l.conv_id = a.conv_id AND l.turn = a.turn - 1),
e AS (
  SELECT *, CASE WHEN role = 'system' THEN CASE WHEN said = '' THEN '$.instructions: too short' ELSE '' END
    WHEN role = 'user' THEN concat_ws('; ', CASE WHEN said = '' THEN '$.question: too short' END,
      CASE WHEN length(said) > 2000 THEN '$.question: too long' END,
      CASE WHEN words < 3 THEN '$.words: too small' END) END AS errors
  FROM j)
SELECT conv_id, call_id, turn, CAST(level AS INTEGER) AS level,
  CASE role WHEN 'user' THEN 'ask' WHEN 'system' THEN 'configure' END AS name,
  CASE WHEN NOT called THEN 'orphan' WHEN NOT answered THEN 'unanswered' ELSE 'linked' END AS status,
  errors = '' AS valid, errors,
  CASE WHEN NOT called THEN json_object('id', call_id, 'result', told)
    WHEN role = 'user' THEN json_object('arguments', json_object('question', said, 'words', words), 'id', call_id,
      'name', 'ask', 'result', told)
    ELSE json_object('arguments', json_object('instructions', said), 'id', call_id, 'name', 'configure',
      'result', told) END::VARCHAR AS line
FROM e"""


# The text is put together again from the output: the marks are found there, the parts lie between them.
FILL_IN_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
    sha256(concat('7:', coalesce(doc_id::VARCHAR, ''))) AS h
  FROM documents),
x AS (
  SELECT *, len(units) AS n, [('0x' || h[1 + 8 * k : 8 + 8 * k])::BIGINT FOR k IN range(4)] AS draw FROM d),
c AS (
  SELECT *, least(draw[1] % (n + 1), draw[2] % (n + 1)) AS low, greatest(draw[1] % (n + 1), draw[2] % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR draw[3] % 100 >= 100
      THEN 'plain' WHEN draw[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM x),
p AS (
  SELECT *, coalesce(array_to_string(units[1 : low], ''), '') AS pre, coalesce(array_to_string(units[low + 1 : high], ''), '') AS mid,
    coalesce(array_to_string(units[high + 1 : n], ''), '') AS suf
  FROM c),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', pre, '<S>', suf, '<M>', mid)
    ELSE concat('<S>', suf, '<P>', pre, '<M>', mid) END AS output FROM p),
r AS (
  SELECT *, strpos(output, CASE form WHEN 'psm' THEN '<S>' ELSE '<P>' END) AS two, strpos(output, '<M>') AS three FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars, sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN concat(substr(output, 4, two - 4), substr(output, three + 3), substr(output, two + 3, three - two - 3))
    ELSE concat(substr(output, two + 3, three - two - 3), substr(output, three + 3), substr(output, 4, two - 4)) END) AS restored_sha256
FROM r"""
