"""The SQL beside the queries that SQL can express."""

from rollcall.llm.centroid_clusters import CLUSTERS, DIM, ROUNDS, SALT, SCALE
from rollcall.llm.filter_audit import FILTERS
from rollcall.llm.license_scan import TEMPLATES, THRESHOLD, template_bigrams, template_words
from rollcall.llm.quality_rules import STOP_WORDS


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_WORD = r"[^\x20\x09-\x0D]"

QUALITY_RULES = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l
  FROM documents),
i AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3),
v AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS n FROM i),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM v WHERE n > 1) GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_excl,
         len(list_filter(w, lambda x: list_contains({_list(STOP_WORDS)}, x))) AS n_stop_words, len(l) AS n_lines,
         len(list_filter(l, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS n_cut,
         len(list_filter(l, lambda x: left(ltrim(x, ' '), 1) IN ('-', '*', '•'))) AS n_bullets
  FROM d LEFT JOIN c USING (r)),
q AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words::DOUBLE / 1 AS nw, greatest(n_lines, 1)::DOUBLE AS nl FROM m),
b AS (
  SELECT *, [
    CASE WHEN n_words < 50 THEN 'length' END,
    CASE WHEN NOT (CASE WHEN nw = 0 THEN 0 ELSE word_chars / nw END BETWEEN 3 AND 12) THEN 'word_length' END,
    CASE WHEN CASE WHEN nw = 0 THEN 0 ELSE n_symbols / nw END > 0.1::DOUBLE THEN 'symbols' END,
    CASE WHEN CASE WHEN nw = 0 THEN 0 ELSE n_excl / nw END > 0.3::DOUBLE THEN 'exclamations' END,
    CASE WHEN CASE WHEN nw = 0 THEN 0 ELSE n_stop_words / nw END < 0.04::DOUBLE THEN 'stop_words' END,
    CASE WHEN n_dup_lines / nl > 0.4::DOUBLE THEN 'repeated_lines' END,
    CASE WHEN n_cut / nl > 0.3::DOUBLE THEN 'cut_lines' END,
    CASE WHEN n_bullets / nl > 0.9::DOUBLE THEN 'bullets' END] AS broken FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND len(list_filter(broken, lambda x: x IS NOT NULL)) = 0 AS kept,
       coalesce(array_to_string(list_filter(broken, lambda x: x IS NOT NULL), ','), '') AS broken_rules, n_stop_words, n_lines
FROM b
"""

_TEMPLATE_ROWS = ", ".join(f"('{k}', {_list(template_bigrams(t))}, {len(template_words(t)) - 1})" for k, t in sorted(TEMPLATES.items()))

LICENSE_SCAN = f"""
WITH t(k, g, size) AS (VALUES {_TEMPLATE_ROWS}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
u AS (
  SELECT r, unnest(string_split(text, chr(10))) AS u FROM d
  UNION ALL SELECT r, text FROM d WHERE contains(text, chr(10))),
w AS (SELECT r, string_split(lower(trim(regexp_replace(u, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM u),
g AS (SELECT r, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w WHERE len(w) >= 2),
s AS (
  SELECT r, k, 2.0::DOUBLE * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) AS d
  FROM g JOIN t ON len(g.g) BETWEEN len(t.g) * {THRESHOLD} / {2 - THRESHOLD} - 1e-9 AND len(t.g) * {2 - THRESHOLD} / {THRESHOLD} + 1e-9),
m AS (SELECT r, count(*) AS n FROM s WHERE d >= {THRESHOLD}::DOUBLE GROUP BY r),
x AS MATERIALIZED (
  SELECT r, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS b
  FROM (SELECT r, string_split(lower(trim(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM d) WHERE len(w) >= 2),
p AS (SELECT r, unnest(b) AS word, generate_subscripts(b, 1) AS i FROM x),
h AS (SELECT DISTINCT r, k, unnest(range(i - size + 1, i + 1)) AS i FROM p JOIN (SELECT k, size, unnest(g) AS word FROM t) USING (word)),
v AS (
  SELECT r, k, t.g, list_distinct(b[i:i + size - 1]) AS b FROM h JOIN x USING (r) JOIN t USING (k) WHERE i >= 1 AND i + size - 1 <= len(b)),
a AS (
  SELECT r, k, d FROM s UNION ALL
  SELECT r, k, 2.0::DOUBLE * len(list_intersect(b, g)) / (len(b) + len(g)) FROM v),
f AS (SELECT r, k, max(d) AS d FROM a WHERE d >= {THRESHOLD}::DOUBLE GROUP BY r, k),
b AS (SELECT r, count(*) AS n_templates, max(d) AS d, arg_min(k, (-d, k)) AS k FROM f GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(n_templates, 0) AS n_templates, k AS license, d AS dice
FROM d LEFT JOIN m USING (r) LEFT JOIN b USING (r)
"""


def _assigned(k: int) -> str:
    """Vectors beside their nearest centroid of round ``k``."""
    return f"""
a{k} AS MATERIALIZED (
  SELECT r, vec_id, v, d[1] AS distance, d[2] AS cluster FROM (
    SELECT r, vec_id, v, min([list_sum(list_transform(range(1, {DIM + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT, k]) AS d
    FROM kept, c{k} GROUP BY ALL))"""


def _moved(k: int) -> str:
    """The centroids of round ``k + 1``."""
    mean = "(s - ((s % n) + n) % n) // n"
    return f"""
c{k + 1} AS MATERIALIZED (
  SELECT k, coalesce(m, c) AS c FROM c{k} LEFT JOIN (
    SELECT cluster, list({mean} ORDER BY i) AS m FROM (
      SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
        SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{k}) GROUP BY ALL) GROUP BY cluster) ON cluster = k)"""


CENTROID_CLUSTERS = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (
    SELECT sha256('{SALT}' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {CLUSTERS})),
{", ".join(_assigned(k) + "," + _moved(k) for k in range(ROUNDS))}, {_assigned(ROUNDS)}
SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} ON cluster = k
"""

_FAILS = {f: f"fails_{f.lower()}" for f in FILTERS}
_ORDERS = f"""
  SELECT concat({", ".join(f"f{i}" for i in range(1, 6))}) AS filter_order, [{", ".join(f"f{i}" for i in range(1, 6))}] AS l
  FROM {", ".join(f"(SELECT unnest(string_split('{FILTERS}', '')) AS f{i})" for i in range(1, 6))}
  WHERE len(list_distinct(l)) = 5"""

FILTER_AUDIT = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w
  FROM documents),
f AS (
  SELECT doc_id, part, concat(
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS failed FROM d),
g AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN g USING (doc_id) GROUP BY ALL),
o AS ({_ORDERS}),
s AS (
  SELECT part, filter_order, step, l[step] AS filter, n, good, toxic, contains(failed, l[step]) AS fails, failed = l[step] AS alone,
         len(list_filter(l[:step - 1], lambda x: contains(failed, x))) > 0 AS gone
  FROM m, o, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM r
"""
