"""Box tables derived from the driver's parquet tables.

The same SQL text builds each view in Spark (``spark.sql`` with DataFrame
parameters, no global temp names) and, as a CTE, in the DuckDB oracle.  Every
view is a pure function of the base tables, so its size grows with them.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.session import computed_once

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# view name -> (SQL, dependencies).  Written in the common subset of Spark SQL and DuckDB.
VIEW_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "img": ("""
SELECT o_orderkey AS img_id, CAST(320 + (o_orderkey % 10) * 32 AS INT) AS width,
       CAST(320 + (o_custkey % 10) * 32 AS INT) AS height
FROM orders""", ("orders",)),
    "gt": ("""
SELECT img_id, box_id, CAST(pk % 3 AS INT) AS label,
       CAST((pk * 13) % (width - bw) AS DOUBLE) AS x_min,
       CAST((pk * 29 + sk) % (height - bh) AS DOUBLE) AS y_min,
       CAST((pk * 13) % (width - bw) + bw AS DOUBLE) AS x_max,
       CAST((pk * 29 + sk) % (height - bh) + bh AS DOUBLE) AS y_max
FROM (SELECT i.img_id, i.width, i.height, l.box_id, pk, sk,
             CAST(40 + q * 4 AS BIGINT) AS bw, 40 + (sk * 7) % 160 AS bh
      FROM (SELECT l_orderkey, l_linenumber AS box_id, min(l_partkey) AS pk,
                   min(l_suppkey) AS sk, min(l_quantity) AS q
            FROM lineitem GROUP BY l_orderkey, l_linenumber) l
      JOIN img i ON i.img_id = l.l_orderkey) z""", ("lineitem", "img")),
    "pred": ("""
SELECT img_id, box_id * 10 + k AS pred_id,
       CAST((label + CASE WHEN (img_id + box_id * 3 + k) % 9 = 0 THEN 1 ELSE 0 END) % 3 AS INT) AS label,
       x_min + (img_id * 3 + k * 5 + box_id) % 23 - 11 + CASE WHEN (img_id + box_id) % 7 = 0 THEN 2000 ELSE 0 END AS x_min,
       y_min + (img_id * 7 + k * 3 + box_id) % 19 - 9 AS y_min,
       x_max + (img_id * 5 + k * 7) % 17 - 8 + CASE WHEN (img_id + box_id) % 7 = 0 THEN 2000 ELSE 0 END AS x_max,
       y_max + (img_id + k * 11) % 21 - 10 AS y_max,
       CAST(3000 + (img_id * 17 + box_id * 1013 + k * 2503) % 7000 AS DOUBLE) / 10000 AS score
FROM gt CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) c
""", ("gt",)),
    "meter_in": ("""
SELECT event_id AS step, CAST(ts AS TIMESTAMP) AS ts, event_type AS tag, value AS val,
       CAST(1 + user_id % 20 AS INT) AS n
FROM events""", ("events",)),
}

# Views whose text differs between the engines (array functions).
SPARK_ONLY_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    # same rows as the shared text, with the three copies made by explode instead of a join
    "pred": ("""
SELECT img_id, box_id * 10 + k AS pred_id,
       CAST((label + CASE WHEN (img_id + box_id * 3 + k) % 9 = 0 THEN 1 ELSE 0 END) % 3 AS INT) AS label,
       x_min + (img_id * 3 + k * 5 + box_id) % 23 - 11 + CASE WHEN (img_id + box_id) % 7 = 0 THEN 2000 ELSE 0 END AS x_min,
       y_min + (img_id * 7 + k * 3 + box_id) % 19 - 9 AS y_min,
       x_max + (img_id * 5 + k * 7) % 17 - 8 + CASE WHEN (img_id + box_id) % 7 = 0 THEN 2000 ELSE 0 END AS x_max,
       y_max + (img_id + k * 11) % 21 - 10 AS y_max,
       CAST(3000 + (img_id * 17 + box_id * 1013 + k * 2503) % 7000 AS DOUBLE) / 10000 AS score
FROM gt LATERAL VIEW explode(array(0, 1, 2)) c AS k
""", ("gt",)),
    "cellmap": ("""
SELECT vec_id AS img_id, CAST(pos AS INT) AS pos, CAST(v AS DOUBLE) * 8 AS logit
FROM embeddings LATERAL VIEW posexplode(concat(embedding, embedding, embedding)) t AS pos, v""", ("embeddings",)),
    "features": ("""
SELECT vec_id, transform(embedding, x -> CAST(x AS DOUBLE)) AS f, CAST(label % 3 AS INT) AS label
FROM embeddings""", ("embeddings",)),
}
DUCKDB_ONLY_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    # every image has a feature vector: number img_id modulo the number of vectors
    "img_vec": ("""
SELECT i.img_id, i.width, i.height, e.embedding
FROM img i JOIN embeddings e ON e.vec_id = i.img_id % (SELECT count(*) FROM embeddings)""", ("img", "embeddings")),
    "cellmap": ("""
SELECT vec_id AS img_id, CAST(pos AS INT) AS pos, CAST(embedding[pos % 64 + 1] AS DOUBLE) * 8 AS logit
FROM embeddings CROSS JOIN (SELECT unnest(range(192)) AS pos) p""", ("embeddings",)),
    "features": ("""
SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS f, CAST(label % 3 AS INT) AS label
FROM embeddings""", ("embeddings",)),
}


def _spark_views() -> dict[str, tuple[str, tuple[str, ...]]]:
    return {**VIEW_SQL, **SPARK_ONLY_SQL}


def _duck_views() -> dict[str, tuple[str, tuple[str, ...]]]:
    return {**VIEW_SQL, **DUCKDB_ONLY_SQL}


def _braced(sql: str, deps: tuple[str, ...]) -> str:
    """Turn bare table names into ``{name}`` placeholders for ``spark.sql(**dfs)``."""
    import re
    out = sql
    for d in deps:
        out = re.sub(rf"\b(FROM|JOIN)\s+{d}\b", rf"\1 {{{d}}}", out)
    return out


#: Rows of ``lineitem`` in one partition of the truth table, at most on average.
TRUTH_ROWS = 100_000


class Tables:
    """Lazily loaded base tables and derived views for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name == "img_vec":
                self._cache[name] = self.vectors(self["img"], "img_id")
            elif name == "gt":  # one exchange, by image, that grouping, the join with ``img`` and all that goes by image share
                sql, deps = _spark_views()[name]
                lines = self["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
                dfs = {"lineitem": lines.repartition(self.slices(), "l_orderkey"), "img": self["img"]}
                self._cache[name] = computed_once(self.spark.sql(_braced(sql, deps), **dfs), ["img_id"])
            elif name == "pred":
                sql, deps = _spark_views()[name]
                self._cache[name] = computed_once(self.spark.sql(_braced(sql, deps), **{d: self[d] for d in deps}), ["img_id"])
            else:
                sql, deps = _spark_views()[name]
                self._cache[name] = self.spark.sql(_braced(sql, deps), **{d: self[d] for d in deps})
        return self._cache[name]

    def slices(self) -> int:
        """Partitions of the truth table and of what is joined with it by image."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-self["lineitem"].count() // TRUTH_ROWS))

    def vectors(self, images: DataFrame, by: str) -> DataFrame:
        """``images`` with their feature vectors, dealt by ``by``: few bytes, but many slots an image.  They are dealt
        before the join, so that vectors are not shuffled once an image; the number of vectors is one scalar."""
        vec = F.pmod("img_id", F.lit(max(1, self["embeddings"].count())))
        e = self["embeddings"].select("vec_id", "embedding")
        return images.repartition(self.slices(), by).withColumn("vec_id", vec).join(e, "vec_id").drop("vec_id")

    __getattr__ = lambda self, name: self[name] if not name.startswith("_") else object.__getattribute__(self, name)


@lru_cache(maxsize=None)
def duck_cte(*names: str) -> str:
    """``WITH`` prefix defining the named views (and their dependencies) for DuckDB."""
    views = _duck_views()
    order: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in order:
            return
        for d in views[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({views[n][0]})" for n in order) + "\n"
