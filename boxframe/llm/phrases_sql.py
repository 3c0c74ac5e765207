"""DuckDB SQL of the collocation query: n-grams of all three orders are exploded and counted one by one."""

from __future__ import annotations


def oracle(min_count: int, inside: int, top: int) -> str:
    score = "CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST({l} AS HUGEINT) * {r}) AS BIGINT)"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces),
grams AS (
  SELECT lang, 1 AS k, unnest(ws) AS w1, '' AS w2, '' AS w3 FROM words
  UNION ALL
  SELECT lang, 2, ws[i], ws[i + 1], '' FROM (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM words)
  UNION ALL
  SELECT lang, 3, ws[i], ws[i + 1], ws[i + 2] FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM words)),
f AS (SELECT lang, k, w1, w2, w3, count(*) AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cut AS (
  SELECT p.lang, p.w1, p.w2, p.w3, p.k, 1 AS cut, p.a, l.a AS l, r.a AS r, {score.format(l='l.a', r='r.a').replace('* a * a', '* p.a * p.a')} AS score
  FROM f p JOIN f l ON l.lang = p.lang AND l.k = 1 AND l.w1 = p.w1
  JOIN f r ON r.lang = p.lang AND r.k = p.k - 1 AND r.w1 = p.w2 AND r.w2 = p.w3
  WHERE p.k > 1 AND p.a >= {min_count}
  UNION ALL
  SELECT p.lang, p.w1, p.w2, p.w3, p.k, 2 AS cut, p.a, l.a AS l, r.a AS r, {score.format(l='l.a', r='r.a').replace('* a * a', '* p.a * p.a')} AS score
  FROM f p JOIN f l ON l.lang = p.lang AND l.k = 2 AND l.w1 = p.w1 AND l.w2 = p.w2
  JOIN f r ON r.lang = p.lang AND r.k = 1 AND r.w1 = p.w3
  WHERE p.k = 3 AND p.a >= {min_count}),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, w1, w2, w3 ORDER BY score, cut) = 1),
holds AS (
  SELECT lang, w1, w2, max(a) AS longer FROM (
    SELECT lang, w1, w2, a FROM f WHERE k = 3 AND a >= {min_count}
    UNION ALL SELECT lang, w2, w3, a FROM f WHERE k = 3 AND a >= {min_count}) GROUP BY lang, w1, w2),
kept AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 || CASE WHEN c.k = 3 THEN ' ' || c.w3 ELSE '' END AS phrase, c.a, c.l, c.r, c.score
  FROM lowest c LEFT JOIN holds h ON c.k = 2 AND h.lang = c.lang AND h.w1 = c.w1 AND h.w2 = c.w2
  WHERE h.longer IS NULL OR 100 * h.longer < {inside} * c.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN total t USING (lang) WHERE r.rank <= {top}"""
