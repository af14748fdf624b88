"""DuckDB SQL for the queries of this package that SQL can express, each by the plain definition."""

from tremora.llm import licenses
from tremora.llm.queries import RULES

_ASCII = f"'{licenses.UPPER}', '{licenses.LOWER}'"


def _values(rows) -> str:
    def text(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)


EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

URL_FILTER = f"""
WITH rules(host, path, verdict) AS (VALUES {_values(RULES)}),
rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                       ELSE '' END AS rest FROM pages),
hosts AS (
  SELECT page_id, rest, strpos(translate(rest, '?#', '//'), '/') AS p FROM rests),
tails AS (
  SELECT page_id, CASE WHEN p > 0 THEN substr(rest, 1, p - 1) ELSE rest END AS host,
         CASE WHEN p > 0 AND substr(rest, p, 1) = '/' THEN substr(rest, p) ELSE '' END AS tail
  FROM hosts),
parts AS (
  SELECT page_id, translate(host, {_ASCII}) AS host,
         split_part(translate(tail, '#', '?'), '?', 1) AS path FROM tails),
hits AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY
           length(r.host) - length(replace(r.host, '.', '')) DESC, length(r.path) DESC) AS n
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host))
       AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN hits h ON h.page_id = p.page_id AND h.n = 1
"""

NEAR_DEDUP = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_ASCII}),
         '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k
        FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(r.b) AS component_id,
       d.doc_id = min(r.b) AS kept
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes z ON z.doc_id = d.doc_id
GROUP BY d.doc_id
"""

REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (
  SELECT doc_id, k, md5(substr(h, 2 * k + 1, 800)) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS k FROM docs)),
again AS (SELECT doc_id, k, count(*) OVER (PARTITION BY s) AS n FROM strings),
starts AS (
  SELECT doc_id, k, CASE WHEN k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) <= 400
                         THEN 0 ELSE 1 END AS opens FROM again WHERE n > 1),
numbered AS (SELECT doc_id, k, sum(opens) OVER (PARTITION BY doc_id ORDER BY k) AS r FROM starts),
spans AS (SELECT doc_id, r, min(k) AS a, max(k) + 400 AS b FROM numbered GROUP BY ALL),
edges AS (
  SELECT doc_id, b AS first, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS after FROM spans
  UNION ALL SELECT doc_id, 0, min(a) FROM spans GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, string_agg(substr(d.h, 2 * e.first + 1, 2 * (coalesce(e.after,
         length(d.h) // 2) - e.first)), '' ORDER BY e.first) AS h
  FROM docs d JOIN edges e ON e.doc_id = d.doc_id GROUP BY d.doc_id),
totals AS (SELECT doc_id, count(*) AS n, sum(b - a) AS bytes FROM spans GROUP BY doc_id)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, coalesce(t.bytes, 0)::BIGINT AS n_removed,
       coalesce(t.n, 0) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256,
       -- whole characters in UTF-8, in hexadecimal digits with a space after each byte
       coalesce(decode(unhex(replace(array_to_string(regexp_extract_all(
         regexp_replace(coalesce(k.h, d.h), '(..)', '\\1 ', 'g'), '[0-7][0-9A-F] '
         || '|[CD][0-9A-F] [89AB][0-9A-F] |E[0-9A-F] [89AB][0-9A-F] [89AB][0-9A-F] '
         || '|F[0-9A-F] [89AB][0-9A-F] [89AB][0-9A-F] [89AB][0-9A-F] '), ''), ' ', ''))), '') AS text
FROM docs d LEFT JOIN totals t ON t.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_TEMPLATES = [(i, text, label, base) for i, (text, label, base) in enumerate(
    [(t, label, 1) for t, label in licenses.PHRASES]
    + [(t, label, 0) for t, label in licenses.NOTICES])]

LICENSES = f"""
WITH templates(template, text, label, base) AS (VALUES {_values(_TEMPLATES)}),
t_words AS (SELECT template, label, base, string_split(text, ' ') AS w FROM templates),
t_runs AS (
  SELECT template, label, base, len(w) - 2 AS total, k - 1 AS t_place, w[k:k + 2] AS run
  FROM (SELECT *, unnest(range(1, len(w) - 1)) AS k FROM t_words)),
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_ASCII}),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
runs AS (SELECT doc_id, k - 1 AS place, w[k:k + 2] AS run
         FROM (SELECT *, unnest(range(1, len(w) - 1)) AS k FROM words)),
found AS (
  SELECT doc_id, template, label, base, total, place - t_place AS diagonal, t_place
  FROM runs JOIN t_runs USING (run)),
lines AS (
  SELECT doc_id, template, label, base, total, diagonal, count(*) AS n,
         diagonal + min(t_place) AS lo, diagonal + max(t_place) AS hi
  FROM found GROUP BY doc_id, template, label, base, total, diagonal),
steps AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template
            ORDER BY diagonal) <= {licenses.NEIGHBOURS} THEN 0 ELSE 1 END AS step FROM lines),
blocks AS (SELECT *, sum(step) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS block
           FROM steps),
held AS (
  SELECT b.doc_id, b.template, b.block, count(DISTINCT f.t_place) AS together
  FROM blocks b JOIN found f ON f.doc_id = b.doc_id AND f.template = b.template
       AND f.diagonal = b.diagonal GROUP BY ALL),
spans AS (
  SELECT b.doc_id, b.template, b.label, b.base, b.total, b.block, max(b.n) AS best,
         max(b.hi) - min(b.lo) + 1 AS width, count(*) FILTER (b.n = b.total) AS n_exact,
         min(b.diagonal) FILTER (b.n = b.total) AS first_exact,
         max(b.diagonal) FILTER (b.n = b.total) AS last_exact
  FROM blocks b GROUP BY b.doc_id, b.template, b.label, b.base, b.total, b.block),
shares AS (
  SELECT s.*, greatest(s.best, CASE WHEN s.width <= 2 * s.total + {licenses.NEIGHBOURS}
         THEN h.together ELSE 0 END)::DOUBLE / s.total AS share
  FROM spans s JOIN held h USING (doc_id, template, block)),
report AS (
  SELECT doc_id, sum(n_exact) FILTER (base = 1) AS n_base,
         min(first_exact) FILTER (base = 1) AS first_word,
         max(last_exact) FILTER (base = 1) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (base = 1 AND n_exact > 0)), ',')
           AS base_labels,
         array_to_string(list_sort(list(DISTINCT label) FILTER ((base = 1 AND n_exact > 0)
           OR share >= {licenses.MIN_SHARE})), ',') AS labels,
         max(share) AS score
  FROM shares GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(r.n_base, 0)::BIGINT AS n_base,
       r.first_word::BIGINT AS first_word, r.last_word::BIGINT AS last_word,
       coalesce(r.base_labels, '') AS base_labels, coalesce(r.labels, '') AS labels,
       coalesce(r.score, 0.0)::DOUBLE AS score
FROM words w LEFT JOIN report r ON r.doc_id = w.doc_id
"""



def _k_means(rounds: int = 3, k: int = 16, dims: int = 64, scale: int = 64) -> str:
    """Rounds of assignment and floored means, in long form: a row per vector and component."""
    steps, last = [], "start"
    for n in range(rounds + 1):
        steps.append(f"""
near{n} AS (
  SELECT r, c, d FROM (
    SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS n FROM (
      SELECT x.r, z.c, sum((x.v - z.v) * (x.v - z.v))::BIGINT AS d
      FROM comps x JOIN {last} z ON z.i = x.i GROUP BY x.r, z.c)) WHERE n = 1)""")
        if n < rounds:
            steps.append(f"""
means{n} AS (
  SELECT c, i, (s - ((s % n) + n) % n) // n AS v FROM (
    SELECT a.c, x.i, sum(x.v)::BIGINT AS s, count(*) AS n
    FROM near{n} a JOIN comps x ON x.r = a.r GROUP BY a.c, x.i)),
step{n} AS (SELECT o.c, o.i, coalesce(m.v, o.v) AS v
            FROM {last} o LEFT JOIN means{n} m ON m.c = o.c AND m.i = o.i)""")
            last = f"step{n}"
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {dims}
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
comps AS (
  SELECT r, i, floor({scale} * e[i]::DOUBLE)::BIGINT AS v
  FROM (SELECT r, e, unnest(range(1, {dims + 1})) AS i FROM kept)),
firsts AS (
  SELECT r, n - 1 AS c FROM (
    SELECT r, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, ''))) AS n
    FROM kept) WHERE n <= {k}),
start AS (SELECT f.c, x.i, x.v FROM firsts f JOIN comps x ON x.r = f.r),
{",".join(steps).strip()},
digests AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY i)) AS h FROM {last} GROUP BY c)
SELECT q.vec_id, a.c::INTEGER AS cluster, a.d AS distance,
       (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, g.h AS centroid_sha256
FROM near{rounds} a JOIN kept q ON q.r = a.r JOIN digests g ON g.c = a.c
"""


DIVERGENCE = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(translate(text,
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term
         HAVING count(DISTINCT d) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
sources AS (SELECT DISTINCT lang, source FROM docs),
langs AS (SELECT lang, sum(n) AS total, count(*) AS v FROM kept GROUP BY lang),
grid AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
  FROM sources s JOIN kept k ON k.lang = s.lang
       LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
totals AS (SELECT lang, source, sum(n) AS total FROM grid GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, g.term, g.n,
         1 + (1000000000::HUGEINT * (g.n + 2)) // (t.total + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (g.lang_n + 2)) // (l.total + 2 * l.v) AS q
  FROM grid g JOIN totals t ON t.lang = g.lang AND t.source = g.source
       JOIN langs l ON l.lang = g.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
  GROUP BY ALL),
report AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM sources a JOIN sources b ON b.lang = a.lang AND b.source <> a.source
       LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares
  WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                        ORDER BY value DESC, item) AS rank FROM report)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

SQL = {"op4_repeats": REPEATS, "op5_exact_dedup": EXACT_DEDUP, "op7_url_filter": URL_FILTER,
       "op9_near_dedup": NEAR_DEDUP, "op10_licenses": LICENSES,
       "op11_centroids": _k_means(), "op13_divergence": DIVERGENCE}
