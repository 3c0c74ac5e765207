"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

The trees are fitted on a bounded sample of labelled rows (``max_train``), flattened into arrays
and broadcast; every document is scored by one vectorised walk per tree.  Scoring adds no shuffle.

Defined cases: null text counts as empty; empty texts are scored like any other (all statistics
0); repeated rows get equal scores; a label that is null, or differs between repeated label rows
of one document, is not learned from; without usable labels every document gets the share of
class 1 (1, so nothing is rejected); null ids are scored, held out and never learned from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxframe.llm import gbdt
from boxframe.llm.textkit import as_bytes, small_batches

#: Rows the trees may learn from; the sample is a few MB of statistics at most.
MAX_TRAIN = 20_000
SYMBOLS = b"#*$%&|<>"
_TABLES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789",
    "stop": b".,;:", "shout": b"!?", "symbol": SYMBOLS, "pipe": b"|", "space": b" \t\r\x0b\x0c",
    "line": b"\n", "high": bytes(range(128, 256)), "bracket": b"()[]{}@/\\_=+~^",
}
_MASK = np.stack([np.isin(np.arange(256), np.frombuffer(v, np.uint8)) for v in _TABLES.values()]).astype(float)
N_FEATURES = 12 + len(_TABLES)


def statistics(raw: bytes) -> list[float]:
    """Statistics of one whole text; all zero for an empty one."""
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    size = len(raw)
    classes = (_MASK @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256)) / size
    kinds = set(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    runs = len(set(zip(words, words[1:], words[2:])))
    lengths = np.fromiter(map(len, kinds), np.int64, len(kinds))
    tail = sum(w[-1] in SYMBOLS for w in kinds) / len(kinds)
    caps = sum(w.isupper() for w in kinds) / len(kinds)
    return [
        np.log1p(size), np.log1p(n), size / n, len(kinds) / n, runs / max(1, n - 2),
        1.0 - len(set(lines)) / len(lines), n / len(lines), max(map(len, lines)) / size,
        float(lengths.mean()), float(lengths.max()), tail, caps, *classes.tolist(),
    ]


def statistics_matrix(texts) -> np.ndarray:
    rows = [statistics(t) for t in as_bytes(texts)]
    return np.array(rows, float).reshape(len(rows), N_FEATURES)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics_column(texts: pd.Series) -> pd.Series:
    return pd.Series(list(statistics_matrix(texts)))


def training_rows(labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    """At most ``max_train`` (doc_id, y) rows that may be learned from: crc32 of the id, modulo 3,
    is not 1; chosen by a hash of the id."""
    return (labels.select("doc_id", F.col(label).cast("int").alias("y")).dropna()
            .filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
            .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y2"))
            .filter((F.col("y") == F.col("y2")) & F.col("y").isin(0, 1)).drop("y2")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))


def fit_quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, **params) -> gbdt.FlatTrees:
    """Trees from the labelled documents.  ``labels`` is first cut to ``max_train`` rows, so
    broadcasting them and fetching their statistics is bounded by that parameter."""
    rows = (docs.select("doc_id", F.col("text").cast("binary").alias("text"))
            .join(F.broadcast(training_rows(labels, max_train=max_train)), "doc_id")
            .select("doc_id", "y", _statistics_column("text").alias("x"))
            .orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(max_train).collect())
    x = np.array([r.x for r in rows], float).reshape(len(rows), N_FEATURES)
    return gbdt.fit(x, np.array([r.y for r in rows], float), **params)


def quality_column(model: gbdt.FlatTrees, text: Column) -> Column:
    """Score of ``text`` under ``model`` (0 to 1)."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(statistics_matrix(texts)), dtype=float)

    return score(text.cast("binary"))


def score_quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, **params) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    small_batches(docs.sparkSession)
    model = fit_quality(docs, labels, max_train, **params)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))
    return (docs.select("doc_id", held.alias("held_out"), quality_column(model, F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The documents (all their columns) that the classifier does not reject."""
    model = fit_quality(docs, labels, max_train)
    return docs.filter(quality_column(model, F.col("text")) >= 0.5)
