"""SQL of the registered queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from bazaarlake.llm import mixing, secrets

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

LM = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
pairs AS (SELECT r, w[i] AS a, w[i + 1] AS b FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM docs)),
two AS (SELECT a, b, count(*) AS n FROM pairs GROUP BY ALL),
first AS (SELECT a, count(*) AS n FROM pairs GROUP BY ALL),
one AS (SELECT b, count(*) AS n FROM (SELECT unnest(w) AS b FROM docs) GROUP BY ALL),
total AS (SELECT sum(n) AS n FROM one),
scored AS (
    SELECT r, sum(CASE WHEN two.n >= 2 THEN ln(two.n / first.n) ELSE ln(0.4 * one.n / total.n) END) AS s
    FROM pairs JOIN two USING (a, b) JOIN first USING (a) JOIN one USING (b), total GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(s, 0.0), 6) AS log_score,
       round(CASE WHEN len(w) > 1 THEN s / (len(w) - 1) END, 6) AS score
FROM docs LEFT JOIN scored USING (r)
"""


def _secret_sql() -> str:
    """Positions from what lies between the matches of each rule."""
    parts = []
    for order, rule in enumerate(secrets.BASE + secrets.MORE):
        regex = rule.pattern.replace("'", "''")
        parts.append(f"""
    SELECT r, {order} AS o, '{rule.name}' AS kind, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s,
           length(m[i]) AS n, length(v[i]) AS held
    FROM (SELECT r, g, m, v, unnest(range(1, len(m) + 1)) AS i
          FROM (SELECT r, regexp_extract_all(t, '{regex}') AS m, regexp_extract_all(t, '{regex}', {rule.group}) AS v, string_split_regex(t, '{regex}') AS g FROM docs))
    WHERE length(v[i]) >= {rule.least}""")
    base = len(secrets.BASE)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}),
joined AS (
    SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
           string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, o) FILTER (o < {base}) AS base,
           string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, o) AS spans
    FROM found GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)
"""


SUFFIX = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (SELECT r, doc_id, c0, h[2 * c0 + 1 : 2 * c0 + 1098] AS p FROM (SELECT r, doc_id, h, unnest(range(0, len(h) // 2, 500)) AS c0 FROM docs)),
strings AS (SELECT r, doc_id, c0 + j AS i, p[2 * j + 1 : 2 * j + 100] AS s FROM (SELECT *, unnest(range(0, least(500, len(p) // 2 - 49))) AS j FROM pieces)),
least AS (SELECT s, min(doc_id) AS least FROM strings GROUP BY s),
hits AS (SELECT r, i FROM strings JOIN least USING (s) WHERE doc_id > least OR (doc_id IS NULL AND least IS NOT NULL)),
marked AS (SELECT r, i, CASE WHEN i <= lag(i) OVER w + 50 THEN 0 ELSE 1 END AS opens FROM hits WINDOW w AS (PARTITION BY r ORDER BY i)),
numbered AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS k FROM marked),
spans AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY r, k),
cut AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM spans GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN a IS NULL THEN h
            ELSE list_aggregate(list_transform(range(0, len(a) + 1), lambda k:
                 h[(CASE WHEN k = 0 THEN 0 ELSE b[k] END) * 2 + 1 : (CASE WHEN k = len(a) THEN len(h) // 2 ELSE a[k + 1] END) * 2]), 'string_agg', '') END)) AS kept_sha256
FROM docs LEFT JOIN cut USING (r)
"""

MIXING = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}'))::BIGINT AS size,
           ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
    FROM documents
),
totals AS (SELECT source, sum(size)::BIGINT AS total, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM sized GROUP BY source),
weighted AS (SELECT source, total, i, [3.0, 1.0, 2.0][((i - 1) % 3 + 1)::INTEGER]::DOUBLE AS w, total * 2.0::DOUBLE AS most FROM totals),
leveled AS (
    SELECT *, (sum(total) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY most / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted
),
dealt AS (SELECT source, total, CASE WHEN most <= level * w THEN most ELSE w * max(CASE WHEN most > level * w THEN level END) OVER () END AS target FROM leveled),
goal AS (
    SELECT *, CASE WHEN total > 0 THEN floor(target / total)::BIGINT ELSE 0 END AS epochs, CASE WHEN total > 0 THEN floor(target)::BIGINT ELSE 0 END AS budget
    FROM dealt
),
blocks AS (SELECT source, key, sum(size)::BIGINT AS words FROM sized GROUP BY source, key),
upto AS (SELECT source, key, words, sum(words) OVER (PARTITION BY source ORDER BY key) - words AS before FROM blocks)
SELECT doc_id, size, total AS source_size, target,
       (epochs * size + CASE WHEN words = 0 THEN 0 ELSE floor(size * least(greatest(budget - epochs * total - before, 0), words)::DOUBLE / words) END)::BIGINT AS taken
FROM sized JOIN goal ON sized.source IS NOT DISTINCT FROM goal.source
     JOIN upto ON sized.source IS NOT DISTINCT FROM upto.source AND sized.key = upto.key
"""

JACCARD = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
sets AS (
    SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM docs
),
shingles AS (SELECT r, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.r AS a, b.r AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.r <> b.r
    GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach AS (SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, m AS component_id
FROM sets JOIN (SELECT reach.a AS r, min(d.doc_id) AS m FROM reach JOIN docs d ON reach.b = d.r GROUP BY reach.a) USING (r)
"""

AUDIT = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                     regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM docs GROUP BY t),
told AS (SELECT doc_id, coalesce(max((quality = 1)::INTEGER), 0) AS good, coalesce(max((toxic = 1)::INTEGER), 0) AS toxic FROM labels GROUP BY doc_id),
failing AS (
    SELECT r, docs.doc_id, part,
           CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN docs.doc_id > first THEN 'E' ELSE '' END AS f
    FROM docs JOIN firsts USING (t)
),
counts AS (
    SELECT part, f, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
    FROM failing LEFT JOIN told ON failing.doc_id = told.doc_id GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
seen AS (
    SELECT part, filter_order, step, filter_order[step] AS x, n, good, toxic, f, contains(f, filter_order[step]) AS fails,
           translate(filter_order[1:step - 1], f, '') <> filter_order[1:step - 1] AS gone
    FROM counts, steps
),
outcomes AS (
    SELECT part, filter_order, step::INTEGER AS step, x,
           coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (f = x), 0)::BIGINT AS unique_fails,
           coalesce(sum(n) FILTER (fails AND NOT gone AND good = 1), 0)::BIGINT AS good_lost,
           coalesce(sum(n) FILTER (fails AND NOT gone AND toxic = 1), 0)::BIGINT AS toxic_lost
    FROM seen GROUP BY ALL
)
SELECT * EXCLUDE (x), (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM outcomes
"""

SQL: dict[str, str] = {
    "op2_lm_scoring": LM,
    "op3_secret_scans": _secret_sql(),
    "op7_suffix_dedup": SUFFIX,
    "op8_source_mixing": MIXING,
    "op10_ngram_jaccard": JACCARD,
    "op11_filter_audit": AUDIT,
}
