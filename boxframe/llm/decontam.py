"""Benchmark decontamination: size-partitioned MinHash containment search.

Which documents contain at least ``threshold`` of the distinct k-word shingles of a benchmark item
(an item of fewer than k words counts as one shingle of all its words)?

* Items are partitioned by their number of shingles n.  An item's sketch is its bottom-m MinHash
  (the m smallest values of one random order over shingles).  If a document holds a share of
  ``threshold`` or more, at most n - ceil(threshold * n) shingles are absent from it, so with
  m = n - ceil(threshold * n) + 1 for the partition's largest n, at least one sketch value is in the
  document.  The sketch of a size partition therefore finds every short item in a document of any
  length; nothing is missed, unlike with symmetric signatures that long documents drown.
* Documents are read once.  A bit array of fixed size (``FILTER_BITS``) over the hashes of all item
  shingles decides which document shingles leave the task; it only saves work, whatever its load.
  Documents without a sketch value send nothing at all.
* Sketch hits join the items (a plain equi-join), giving candidate pairs; each is verified by
  intersecting the item's whole shingle set with the document's hits (64-bit fingerprints).

A passage shared by a third of the documents makes one candidate per document, never pairs of
documents.  The only thing gathered on the driver is the bit array.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; null or empty texts contain
nothing and empty items match nothing; items with equal texts each get their rows; rows with a null
id are reported with a null id; repeated document rows are reported once per (doc_id, item_id)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.textkit import as_bytes, mix, shingles, small_batches, word_hashes
from boxframe.session import cut_lineage

K = 5
THRESHOLD = 0.8
FILTER_BITS = 1 << 23


def _rank(h: np.ndarray) -> np.ndarray:
    """The random order that MinHash sketches follow."""
    return mix(h ^ np.uint64(0x5851F42D4C957F2D))


def needed(n: int, threshold: float) -> int:
    """Smallest number of shared shingles that reaches ``threshold`` of n."""
    return max(1, math.ceil(threshold * n - 1e-9))


def _size_class(n: int) -> int:
    """Largest number of shingles in the size partition of n: sizes are parted at powers of 1.25."""
    top = 4
    while top < n:
        top = max(top + 1, int(top * 1.25))
    return top


def sketch_size(n: int, threshold: float) -> int:
    """Length of the sketch of an item with n shingles: enough for the largest of its partition."""
    top = _size_class(n)
    return min(n, max(m - needed(m, threshold) + 1 for m in range(n, top + 1)))


def item_shingles(items: DataFrame, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """(item_id, n, shingles array<bigint>, sketch array<bigint>) of items that have words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for item, words in zip(b["item_id"], word_hashes(as_bytes(b["text"], lower=True))):
                s = np.unique(shingles(words, k))
                if len(s):
                    m = sketch_size(len(s), threshold)
                    low = s[np.argsort(_rank(s), kind="stable")[:m]]
                    rows.append((item, len(s), s.view(np.int64).tolist(), low.view(np.int64).tolist()))
            yield pd.DataFrame(rows, columns=["item_id", "n", "shingles", "sketch"])

    return (items.select("item_id", F.col("text").cast("binary").alias("text")).dropDuplicates()
            .mapInPandas(run, "item_id bigint, n int, shingles array<bigint>, sketch array<bigint>"))


def _bits(values: DataFrame, column: str) -> np.ndarray:
    """Bit array of FILTER_BITS over a column of hashes, or-ed together on the executors."""
    at = F.col(column).bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = (values.groupBy(F.shiftright(at, 6).cast("int").alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("b")).collect())
    words = np.zeros(FILTER_BITS // 64, np.int64)
    for r in rows:
        words[r.w] = r.b
    return words.view(np.uint64)


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(FILTER_BITS - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def contained_items(docs: DataFrame, items: DataFrame, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) for every document that contains an item."""
    small_batches(docs.sparkSession)
    table = cut_lineage(item_shingles(items, k, threshold))
    everything = _bits(table.select(F.explode("shingles").alias("h")), "h")
    sketches = _bits(table.select(F.explode("sketch").alias("h")), "h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, words in zip(b["doc_id"], word_hashes(as_bytes(b["text"], lower=True))):
                # short items are one shingle of all their words: lengths under k are looked up too
                found = []
                for width in range(1, k + 1):
                    if len(words) >= width and (width == k or width in short):
                        s = shingles(words, width)
                        found.append(s[_has(everything, s)])
                hits = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
                probe = hits[_has(sketches, hits)]
                if len(probe):
                    rows.append((doc, hits.view(np.int64).tolist(), probe.view(np.int64).tolist()))
            yield pd.DataFrame(rows, columns=["doc_id", "hits", "probe"])

    short = _short_widths(items, k)
    hits = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInPandas(
        run, "doc_id bigint, hits array<bigint>, probe array<bigint>")
    keys = table.select("item_id", F.explode("sketch").alias("h"))
    # doc rows are cut to their hits here, so carrying those along the candidates is cheap
    cand = (hits.select("doc_id", "hits", F.explode("probe").alias("h")).join(keys, "h")
            .select("doc_id", "item_id", "hits").distinct())
    found = F.size(F.array_intersect("hits", "shingles"))
    return (cand.join(table.select("item_id", "n", "shingles"), "item_id")
            .select("doc_id", "item_id", F.col("n").cast("bigint").alias("n_shingles"),
                    found.cast("bigint").alias("n_found"))
            .filter(F.col("n_found") >= F.ceil(F.lit(threshold) * F.col("n_shingles") - 1e-9))
            .groupBy("doc_id", "item_id", "n_shingles").agg(F.max("n_found").alias("n_found"))
            .withColumn("containment", F.col("n_found") / F.col("n_shingles")))


def _short_widths(items: DataFrame, k: int) -> frozenset[int]:
    """Numbers of words under k that some item has (at most k - 1 numbers)."""
    n = F.size(F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    return frozenset(r.n for r in items.select(n.alias("n")).filter((F.col("n") > 0) & (F.col("n") < k)).distinct().collect())


def drop_contaminated(docs: DataFrame, items: DataFrame, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """The documents (all their columns) that contain no benchmark item."""
    bad = contained_items(docs, items, k, threshold).select("doc_id").distinct()
    # rows with a null id cannot be told apart by id: they match null ids only
    return docs.join(bad.withColumnRenamed("doc_id", "__bad_id"),
                     F.col("doc_id").eqNullSafe(F.col("__bad_id")), "left_anti")
