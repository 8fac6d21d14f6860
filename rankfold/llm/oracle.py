"""DuckDB SQL of the queries that SQL can express; each compares all rows with all rows where the operator uses an index."""

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

_URLS = r"""
WITH RECURSIVE urls AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail FROM urls),
rules(rule_host, rule_path, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
tags AS (
  SELECT page_id, host, path, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM parts),
named AS (
  SELECT page_id, host, path, replace(CASE
    WHEN regexp_matches(tag, '(?is)^<link\b[^>]*\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]*)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>]*)', 1)
    END, '&amp;', '&') AS t FROM tags),
targets AS (
  SELECT page_id, CASE WHEN instr(t, '://') > 0 THEN substr(t, instr(t, '://') + 3) WHEN starts_with(t, '//') THEN substr(t, 3)
    WHEN starts_with(t, '/') THEN host || t WHEN t <> '' THEN host || regexp_replace(path, '[^/]*$', '') || t END AS rest FROM named),
linked AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS target FROM targets WHERE regexp_extract(rest, '^[^/?#]*') <> ''),
ties AS (SELECT DISTINCT host || tail AS a, target AS b FROM parts JOIN linked USING (page_id) WHERE host <> '' AND host || tail <> target),
both_ways AS (SELECT a, b FROM ties UNION SELECT b, a FROM ties),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
places AS (
  SELECT host, path FROM parts UNION
  SELECT regexp_extract(b, '^[^/?#]*'), regexp_extract(b, '^[^/?#]*([^?#]*)', 1) FROM reach),
ruled AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(action, length(rule_host || rule_path)) AS action
  FROM places JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY host, path),
told AS (
  SELECT a, bool_or(action = 'block') AND NOT bool_or(action = 'allow') AS blocked
  FROM reach LEFT JOIN ruled ON host = regexp_extract(b, '^[^/?#]*') AND path = regexp_extract(b, '^[^/?#]*([^?#]*)', 1) GROUP BY a)
SELECT page_id, p.host, p.path, rule, coalesce(action, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN ruled r ON p.host = r.host AND p.path = r.path LEFT JOIN told ON p.host <> '' AND a = p.host || p.tail
"""

_VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a), many AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN many ON many.a = vec_id
"""

_NEAR = f"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_sort(list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) ELSE w END AS s FROM words),
sized AS (SELECT doc_id, s, len(s) AS n FROM sets),
classes AS (SELECT s, n, min(doc_id) AS c FROM sized WHERE n > 0 GROUP BY s, n),
each_one AS MATERIALIZED (SELECT c, n, unnest(s) AS g FROM classes),
shared AS (
  SELECT x.c AS a, y.c AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS k FROM each_one x JOIN each_one y ON x.g = y.g AND x.c < y.c
  AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) GROUP BY x.c, y.c),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 80 * (na + nb - k)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, d.n AS n_shingles, coalesce(least(c, m), c, d.doc_id) AS component_id, d.doc_id = coalesce(least(c, m), c, d.doc_id) AS kept
FROM sized d LEFT JOIN classes ON d.n > 0 AND d.s = classes.s LEFT JOIN least ON least.a = c
"""

_LINES = r"""
WITH cut AS (
  SELECT doc_id, unnest(regexp_extract_all(text, u.p, 1)) AS unit, unnest(regexp_extract_all(text, u.p, 2)) AS gap,
    generate_subscripts(regexp_extract_all(text, u.p, 1), 1) AS k
  FROM documents, (SELECT '((?:[^\n.!?]|[.!?]+[^\n.!?\x20\x09])*[.!?]*)(\n|[\x20\x09]+|$)' AS p) u),
placed AS (
  SELECT *, coalesce(sum(length(unit) + length(gap)) OVER before, 0)::BIGINT AS s,
    coalesce(sum((gap = chr(10))::INT) OVER before, 0) AS line, regexp_extract_all(unit, '[^\x20\x09-\x0D]+') AS w
  FROM cut WINDOW before AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ranked AS (
  SELECT *, len(w) > 0 AND row_number() OVER (PARTITION BY len(w) > 0,
    translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ORDER BY doc_id, k) > 1 AS gone,
    lag(gap, 1, '') OVER (PARTITION BY doc_id ORDER BY k) AS gap_before FROM placed),
joined AS (
  SELECT doc_id, k, CASE WHEN lag(line) OVER kept < line THEN chr(10) || unit WHEN lag(line) OVER kept = line THEN gap_before || unit ELSE unit END AS piece
  FROM ranked WHERE NOT gone AND (k = 1 OR gap_before <> '') WINDOW kept AS (PARTITION BY doc_id ORDER BY k)),
texts AS (SELECT doc_id, string_agg(piece, '' ORDER BY k) AS text FROM joined GROUP BY doc_id),
counts AS (
  SELECT doc_id, count(*) FILTER (len(w) > 0) AS n_units, count(*) FILTER (gone) AS n_removed, coalesce(sum(len(w)) FILTER (gone), 0)::BIGINT AS removed_words,
    coalesce(sum(length(unit)) FILTER (gone), 0)::BIGINT AS removed_chars, coalesce(string_agg(s || ':' || (s + length(unit)), ',' ORDER BY k) FILTER (gone), '') AS removed
  FROM ranked GROUP BY doc_id)
SELECT doc_id, coalesce(text, '') AS text, n_units, n_removed, removed_words, removed_chars, removed FROM counts LEFT JOIN texts USING (doc_id)
"""

_MIX = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':17'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / greatest(0.05, coalesce(length(regexp_replace(text, '[^\p{L}]+', '', 'g'))::DOUBLE / nullif(length(text), 0), 0.0)) AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, ([3.0, 1.0, 2.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM base GROUP BY source),
caps AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / w AS ratio FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5 - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level FROM caps),
chosen AS (SELECT first(level ORDER BY ratio, source NULLS LAST) AS level FROM levels WHERE level < ratio),
targets AS (
  SELECT source, source_size, coalesce(least(cap, (SELECT level FROM chosen) * w), cap) AS target FROM levels),
budgets AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs, round(target)::BIGINT - coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT * source_size AS budget FROM targets),
run AS (
  SELECT b.*, t.source_size, t.target, t.epochs, t.budget,
    coalesce(sum(size) OVER (PARTITION BY b.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM base b JOIN budgets t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, epochs, (epochs * size + greatest(0, least(size, budget - before)))::BIGINT AS taken FROM run
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
ones AS MATERIALIZED (SELECT lang, v, count(*)::HUGEINT AS f FROM (SELECT lang, unnest(w) AS v FROM cut) GROUP BY ALL),
twos AS MATERIALIZED (
  SELECT lang, p.x, p.y, count(*)::HUGEINT AS f FROM (SELECT lang, unnest([{'x': w[i], 'y': w[i + 1]} for i in range(1, len(w))]) AS p FROM cut) GROUP BY ALL),
threes AS MATERIALIZED (
  SELECT lang, p.x, p.y, p.z, count(*)::HUGEINT AS f
  FROM (SELECT lang, unnest([{'x': w[i], 'y': w[i + 1], 'z': w[i + 2]} for i in range(1, len(w) - 1)]) AS p FROM cut) GROUP BY ALL HAVING f >= 10),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang),
long_ones AS (
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.f AS a, a.f AS f1, yz.f AS f23, xy.f AS f12, c.f AS f3,
    1000000::HUGEINT * t.f * t.f // (a.f * yz.f) AS s1, 1000000::HUGEINT * t.f * t.f // (xy.f * c.f) AS s2
  FROM threes t JOIN ones a ON a.lang = t.lang AND a.v = t.x JOIN ones c ON c.lang = t.lang AND c.v = t.z
  JOIN twos xy ON xy.lang = t.lang AND xy.x = t.x AND xy.y = t.y JOIN twos yz ON yz.lang = t.lang AND yz.x = t.y AND yz.y = t.z),
most AS (
  SELECT lang, x, y, max(f) AS m FROM (SELECT lang, x, y, f FROM threes UNION ALL SELECT lang, y AS x, z AS y, f FROM threes) GROUP BY ALL),
kept AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, a.f AS l, b.f AS r, 1000000::HUGEINT * t.f * t.f // (a.f * b.f) AS score
  FROM twos t JOIN ones a ON a.lang = t.lang AND a.v = t.x JOIN ones b ON b.lang = t.lang AND b.v = t.y
  LEFT JOIN most ON most.lang = t.lang AND most.x = t.x AND most.y = t.y WHERE t.f >= 10 AND (m IS NULL OR 100 * m < 50 * t.f)
  UNION ALL SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN f1 ELSE f12 END, CASE WHEN s1 <= s2 THEN f23 ELSE f3 END, least(s1, s2) FROM long_ones),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_redirect_filter": _URLS,
    "op2_pivot_neighbours": _VECTORS,
    "op4_fast_similarity": _NEAR,
    "op6_repeated_lines": _LINES,
    "op10_weighted_mix": _MIX,
    "op13_phrase_collocations": _PHRASES,
}
