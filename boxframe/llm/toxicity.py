"""Toxicity: cumulative-link ordinal regression on sparse text features.

Features of a text are the distinct lower-cased words, without punctuation at their ends, and the
prefixes of 4 to 6 characters of longer words (each present or absent, so length does not matter).
The vocabulary and weights come from a bounded sample of labelled rows; all thresholds share the
weights and the output is the expected severity.

Labels with two values are spread over three grades: 0 is not toxic; toxic rows get grade 1 or 2 by
whether the number of their features seen (almost) only in toxic rows is over the median.

Defined cases: null and empty texts have no features and get the lowest margin; repeated rows get
equal results; null ids are scored, never learned from; null or contradicting labels are skipped;
without a toxic label everything is grade 0."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxframe.llm import ordinal
from boxframe.llm.quality import MAX_TRAIN, training_rows
from boxframe.llm.textkit import small_batches, written

PREFIXES = (4, 5, 6)
MAX_VOCABULARY = 4_096
GRADES = 3
#: Words without a weight that a batch remembers; a bound on memory, not on what is read.
MAX_IDLE = 500_000
#: Evidence (G statistic) a feature needs; five rows that are all toxic at a tenth of toxic rows stay under it.
MIN_GAIN = 12.0
_ENDS = re.compile(r"^\W+|\W+$")


def features(text: str | None) -> set[str]:
    """Words, and ``prefix*`` entries of longer words, of a whole text."""
    if text is None or text != text:
        return set()
    out: set[str] = set()
    for word in set(text.lower().split()):
        if not word.isalpha():
            word = _ENDS.sub("", word)
            if not word:
                continue
        out.add(word)
        for k in PREFIXES:
            if len(word) > k:
                out.add(word[:k] + "*")
    return out


@dataclass(frozen=True)
class SeverityModel:
    weights: dict[str, float]
    cuts: np.ndarray
    flag_at: float  # expected severity from which a document counts as toxic

    def margins(self, texts) -> np.ndarray:
        """Sum of the weights of each text's features."""
        w, out = self.weights, np.zeros(len(texts))
        idle: set[str] = set()  # words met before that have no feature with a weight
        for i, text in enumerate(texts):
            if text is None or text != text:
                continue
            total, seen = 0.0, set()
            for word in set(text.lower().split()) - idle:
                bare = word if word.isalpha() else _ENDS.sub("", word)
                keys = [bare, *(bare[:k] + "*" for k in PREFIXES if len(bare) > k)]
                keys = [k for k in keys if k in w]
                if not keys:
                    idle.add(word)
                for key in keys:
                    if key not in seen:
                        seen.add(key)
                        total += w[key]
            if len(idle) > MAX_IDLE:
                idle.clear()
            out[i] = total
        return out


def fit_severity(vocab: list[str], hits: list[list[int]], toxic: np.ndarray) -> SeverityModel:
    """Model from rows given as indices into ``vocab``."""
    toxic = np.asarray(toxic, int)
    rows = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    cols = np.array([c for h in hits for c in h], int)
    # severity inside the toxic rows: how many of their features are (almost) only in toxic rows
    seen, bad = np.bincount(cols, minlength=len(vocab)), np.bincount(cols, toxic[rows], len(vocab))
    only = bad >= 0.98 * np.maximum(seen, 1)
    count = np.bincount(rows, only[cols], len(hits))
    middle = np.median(count[toxic == 1]) if toxic.sum() else 0.0
    grades = toxic * (1 + (count > middle))
    w, cuts = ordinal.fit(rows, cols, grades.astype(int), len(vocab), GRADES)
    severity = ordinal.expected_grade(np.bincount(rows, w[cols], len(hits)), cuts)
    weights = {f: float(w[i]) for i, f in enumerate(vocab) if abs(w[i]) > 1e-3}
    return SeverityModel(weights, cuts, _flag_at(severity, toxic))


def _flag_at(severity: np.ndarray, toxic: np.ndarray) -> float:
    """Expected severity that tells the two classes of the sample apart best (balanced accuracy),
    in the middle of the gap it falls in; 0.5 without both classes."""
    if not 0 < toxic.sum() < len(toxic):
        return 0.5
    order = np.argsort(severity, kind="stable")
    s, t = severity[order], toxic[order]
    clean = np.concatenate([[0], (1 - t).cumsum()]) / (1 - t).sum()
    missed = np.concatenate([[0], t.cumsum()]) / t.sum()
    gain = clean - missed
    gain[1:-1][s[1:] == s[:-1]] = -np.inf  # equal severities stay together
    k = int(gain.argmax())
    return float((s[max(0, k - 1)] + s[min(len(s) - 1, k)]) / 2)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _features_column(texts: pd.Series) -> pd.Series:
    return pd.Series([sorted(features(t)) for t in texts])


def vocabulary(train: DataFrame, size: int = MAX_VOCABULARY) -> list[str]:
    """The ``size`` features of ``train`` (text, y) whose presence tells the two classes apart best (G
    statistic), of those in four rows or more; counted by Spark."""
    n, n1 = train.agg(F.count("y"), F.sum("y")).first()
    if not n1 or n1 == n:
        return []
    a, c = F.col("a"), F.col("c")
    expected = c * (n1 / n)
    gain = a * F.log((a + 1e-9) / expected) + (c - a) * F.log((c - a + 1e-9) / F.greatest(c - expected, F.lit(1e-9)))
    rows = (train.select("y", F.explode(_features_column("text")).alias("f"))
            .groupBy("f").agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("c")).filter("c >= 4")
            .select("f", F.round(gain, 9).alias("gain")).filter(F.col("gain") > MIN_GAIN)
            .orderBy(F.desc("gain"), "f").limit(size).collect())
    return [r.f for r in rows]


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> SeverityModel:
    """Model from at most ``max_train`` labelled documents.  The driver sees the vocabulary and, per row,
    the indices of its features there; texts stay on the executors."""
    train = written(docs.select("doc_id", "text")
                    .join(F.broadcast(training_rows(labels, "toxic", max_train)), "doc_id").select("doc_id", "text", "y"))
    vocab = vocabulary(train)
    index = {f: i for i, f in enumerate(vocab)}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def indices(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(index[f] for f in features(t) if f in index) for t in texts])

    rows = (train.select("doc_id", "y", indices("text").alias("hits"))
            .orderBy(F.xxhash64("doc_id"), "doc_id", "hits").limit(max_train).collect())
    return fit_severity(vocab, [list(r.hits) for r in rows], np.array([r.y for r in rows], int))


def severity_column(model: SeverityModel, text: Column) -> Column:
    """Expected severity (0 to 2) of ``text``."""

    @F.pandas_udf(T.DoubleType())
    def expected(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(ordinal.expected_grade(model.margins(texts), model.cuts), dtype=float)

    return expected(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, expected_severity, severity, toxic) of every document; ``severity`` is the nearest
    grade and ``toxic`` says whether the severity reaches the value that parts the sample best."""
    small_batches(docs.sparkSession)
    model = fit_toxicity(docs, labels, max_train)
    e = F.col("expected_severity")
    return (docs.select("doc_id", severity_column(model, F.col("text")).alias("expected_severity"))
            .withColumn("severity", F.round(e).cast("int")).withColumn("toxic", e >= F.lit(model.flag_at)))
