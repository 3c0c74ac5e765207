"""DuckDB SQL of the ranked search query: every document is scored against every item by plain joins."""

from __future__ import annotations

_TERMS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")


def oracle(top: int) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS terms FROM benchmark),
corpus AS (SELECT count(*) AS cn, CAST(sum(len(terms)) AS BIGINT) AS cl FROM d WHERE len(terms) > 0),
tf AS (SELECT r, doc_id, len(terms) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, terms, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(cn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf CROSS JOIN corpus GROUP BY term),
q AS (SELECT i, item_id, unnest(terms) AS term FROM b),
s AS (
  SELECT q.i, q.item_id, tf.r, tf.doc_id,
         CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 90 + (90 * tf.n * cn) // cl)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) CROSS JOIN corpus GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= {top}"""
