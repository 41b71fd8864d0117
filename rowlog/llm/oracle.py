"""DuckDB SQL for the training-data queries that SQL can express."""
from __future__ import annotations

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(c: str) -> str:
    return f"translate({c}, '{_UP}', '{_LOW}')"


# The base kinds in order, their patterns, and the method's own kind.
_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_KINDS = (("assign", _ASSIGN, 2), ("access", "AKIA[A-Z0-9]+", 0), ("hex", "[0-9a-f]{24,}", 0), ("token", "[A-Za-z0-9+/_=-]{20,}", 0))


def _matches(kind: int) -> str:
    name, pattern, group = _KINDS[kind]
    return f"""
SELECT doc_id, source, {kind} AS kind, '{name}' AS name,
  CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
  length(m[i]) AS n, v[i] AS value
FROM (SELECT doc_id, source, p, m, v, unnest(range(1, len(m) + 1)) AS i FROM (
  SELECT doc_id, source, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}') AS m,
    regexp_extract_all(t, '{pattern}', {group}) AS v FROM d WHERE regexp_matches(t, '{pattern}')) x) y"""


def op4_secrets() -> str:
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, chr(1)) AS source, coalesce(text, '') AS t FROM documents),
base AS (SELECT * FROM ({_matches(0)}) a WHERE length(value) >= 6 UNION ALL
  SELECT * FROM ({_matches(1)}) b WHERE n >= 20 UNION ALL {_matches(2)}),
tok AS (SELECT * FROM ({_matches(3)}) c WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.s < c.s + c.n AND c.s < b.s + b.n)),
own AS (SELECT value, count(DISTINCT source) < 3 AS live FROM (SELECT * FROM base UNION ALL SELECT * FROM tok) u GROUP BY value),
f AS (SELECT u.*, o.live FROM (SELECT * FROM base UNION ALL SELECT * FROM tok) u JOIN own o ON u.value = o.value),
g AS (SELECT doc_id,
  count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS b, count(*) FILTER (WHERE kind = 2) AS c,
  string_agg(name || ':' || s || ':' || (s + n), ',' ORDER BY s, kind) FILTER (WHERE kind < 3) AS base,
  string_agg(name || ':' || s || ':' || (s + n), ',' ORDER BY s, kind) FILTER (WHERE kind < 3 OR live) AS spans,
  count(*) FILTER (WHERE live) AS live, count(*) FILTER (WHERE NOT live) AS example
  FROM f GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(b, 0) AS BIGINT) AS n_access, CAST(coalesce(c, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  CAST(coalesce(live, 0) AS BIGINT) AS n_live, CAST(coalesce(example, 0) AS BIGINT) AS n_example
FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""


def op7_repeats() -> str:
    return """
WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS x FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS s FROM d WHERE n >= 100) a),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS r FROM w) b WHERE r > 1),
edge AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS new FROM late),
isl AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM edge),
spans AS (SELECT doc_id, k, min(s) AS lo, max(s) + 100 AS hi FROM isl GROUP BY doc_id, k),
cut AS (SELECT doc_id, k, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS prev FROM spans),
g AS (SELECT c.doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS tail,
  string_agg(substr(d.h, 2 * prev + 1, 2 * (lo - prev)), '' ORDER BY lo) AS kept
  FROM cut c JOIN d ON d.doc_id = c.doc_id GROUP BY c.doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN g.doc_id IS NULL THEN d.h ELSE kept || substr(d.h, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""


def op8_near_dups() -> str:
    words = f"regexp_extract_all({_lower('''coalesce(text, '')''')}, '[^\\x20\\x09-\\x0D]+')"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {words} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + least(3, len(w))], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 2, 1))) AS i FROM w WHERE len(w) > 0) a),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(id, via) AS (SELECT a, b FROM l UNION SELECT r.id, l.b FROM r JOIN l ON r.via = l.a),
m AS (SELECT id, min(via) AS via FROM r GROUP BY id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(m.via, w.doc_id)) AS component_id,
  w.doc_id = least(w.doc_id, coalesce(m.via, w.doc_id)) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.id = w.doc_id"""


def op9_line_dedup() -> str:
    return f"""
WITH x AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d),
k AS (SELECT *, {_lower(f"trim(line, {_BLANKS})")} AS key FROM x),
common AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, coalesce(doc_id <> keeper, false) AS gone FROM k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""


def op10_decontamination() -> str:
    words = f"regexp_extract_all({_lower('''coalesce(text, '')''')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH it AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
win AS (SELECT DISTINCT item, n, array_to_string(w[i + 1:i + n], ' ') AS x
  FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS i FROM it WHERE len(w) > 0) a),
d AS (SELECT doc_id, {words} AS w FROM documents),
dw AS (SELECT doc_id, i, n, array_to_string(w[i + 1:i + n], ' ') AS x FROM (
  SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM win) s WHERE len(w) >= n) b),
h AS (SELECT dw.doc_id, i, dw.n, item FROM dw JOIN win ON dw.n = win.n AND dw.x = win.x),
pos AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) c GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) e GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id"""


SQL: dict[str, str] = {f.__name__: f() for f in (op4_secrets, op7_repeats, op8_near_dups, op9_line_dedup, op10_decontamination)}
