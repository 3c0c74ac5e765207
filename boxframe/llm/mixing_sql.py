"""DuckDB SQL of ``op5_mixing``: the same raking, one CTE per step."""

from __future__ import annotations


def oracle(topics: int, sweeps: int, temper: dict[str, float], seed: str) -> str:
    dims = ", ".join(temper)
    steps = [f"""
w0 AS MATERIALIZED (SELECT {dims}, CAST(sum(n_tokens) AS DOUBLE) AS mass, CAST(sum(n_tokens) AS DOUBLE) AS w
       FROM marks GROUP BY {dims} HAVING sum(n_tokens) > 0)"""]
    for d, p in temper.items():
        steps.append(f"""
goal_{d} AS MATERIALIZED (SELECT {d}, pow(m, {p}) / sum(pow(m, {p})) OVER () * sum(m) OVER () AS goal
       FROM (SELECT {d}, sum(mass) AS m FROM w0 GROUP BY {d}))""")
    n = 0
    for _ in range(sweeps):
        for d in temper:
            steps.append(f"""
w{n + 1} AS MATERIALIZED (SELECT c.* REPLACE (c.w * (g.goal / s.now) AS w) FROM w{n} c
       JOIN (SELECT {d}, sum(w) AS now FROM w{n} GROUP BY {d}) s USING ({d}) JOIN goal_{d} g USING ({d}))""")
            n += 1
    return f"""
WITH split AS (SELECT doc_id, coalesce(source, '?') AS source, coalesce(lang, '?') AS lang,
                      regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
marks AS MATERIALIZED (
  SELECT doc_id, source, lang, len(ws) AS n_tokens,
         CASE WHEN len(ws) = 0 THEN '-1' ELSE CAST(CAST('0x' || substr(md5(
           list_max([{{'n': length(x), 'w': x}} for x in ws]).w), 1, 8) AS BIGINT) % {topics} AS VARCHAR) END AS topic
  FROM split),{",".join(steps)},
cells AS MATERIALIZED (SELECT {dims}, w / mass AS factor, (w / mass) / max(w / mass) OVER () AS prob FROM w{n})
SELECT doc_id, source, lang, topic, n_tokens, round(n_tokens * coalesce(factor, 1.0), 3) AS weight,
       round(coalesce(prob, 1.0), 8) AS prob,
       CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 < coalesce(prob, 1.0) AS kept
FROM marks LEFT JOIN cells USING ({dims})"""
