"""Ranked lexical search: exact top-k over posting lists that are blocked by the similarity of their documents.

A document is a vector over the terms of the items with one integer impact a term, (10^9 tf) div (1000 tf + 8 m);
a score is the sum of term weight times impact.  Items are taken in blocks of bounded text (``ITEM_BYTES``), each
block against all documents:

1. every whole text is read once and becomes a row (doc_id, number of terms, columns, frequencies); a table;
2. Spark sums the number of documents, all terms, document frequencies and the greatest impact of each term;
3. a probe scores the documents of each item's rarest lists; the k-th best of them is a floor under its result;
4. an item needs the lists that remain when the terms with the least weight times greatest impact are left out
   for as long as their sum stays under the floor: a document in those alone cannot enter.  Each such list is cut,
   tile by tile, into blocks of documents that are nearest to the same pivot document of the list.  A block's
   summary holds the greatest impact of its documents at each coordinate; weight times summary bounds every score
   in it, and the block is skipped only if that bound is under the floor.  Documents of the other blocks are
   scored in full.

Steps 3 and 4 are narrow passes over the table of step 1: a tile is some thousand documents as a dense matrix of
at most ``CELLS`` numbers, so long lists are split among all tasks and none holds one whole.  Impacts and weights
are whole numbers under 2^24, their sums under 2^53, so doubles hold them exactly.  A task sends its best k of an
item and tile; the last ranking adds up to k rows a partition by Spark's window limit.

Defined cases: null and empty texts have no term, rank nowhere and are not counted; each row of either table
counts by itself, so repeated rows rank one after the other (equal ids in any order); equal scores go to the
smaller doc_id, null ids first; items without a term found in the documents give no row; empty tables give
none; other columns, whatever their names, are never read."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxframe.llm.textkit import as_bytes, small_batches, written

TOP = 10
#: Bytes of item texts and items of one block, which the driver and each task hold.
ITEM_BYTES = 1 << 18
ITEM_ROWS = 4096
#: Numbers of a tile (4 bytes each).
CELLS = 1 << 22
#: Documents in the probed lists of an item, at least.
PROBE = 64
#: Documents of a block, as intended and at most; pivots of a list in a tile.
BLOCK, MAX_BLOCK, MAX_PIVOTS = 16, 64, 32
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")  # of bytes after A-Z are lowered; every byte of a character from U+0080 on is in it


def _terms(texts) -> Iterator[list[bytes]]:
    for raw in as_bytes(texts, lower=True):
        yield TERM.findall(raw)


def vectors(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, cols, tfs) of every document with a term; ``cols`` are positions in ``terms``."""
    shared = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = shared.value.get
        for batch in batches:
            at, size, cols, tfs = [], [], [], []
            for k, words in enumerate(_terms(batch.column(1).to_pylist())):
                if not words:
                    continue
                found = Counter(map(column, words))
                found.pop(None, None)
                at.append(k)
                size.append(len(words))
                cols.append(np.fromiter(found.keys(), np.int32, len(found)))
                tfs.append(np.fromiter(found.values(), np.int32, len(found)))
            if at:
                ends = pa.array(np.cumsum([0, *map(len, cols)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (cols, tfs)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(size, pa.int64()), *lists],
                                                 names=["doc_id", "n", "cols", "tfs"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(read, "doc_id bigint, n bigint, cols array<int>, tfs array<int>"))


class Searcher:
    """What a task needs of a block of items: the columns, weights, lists and floor of each."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray, np.ndarray]], floors: np.ndarray, width: int, n: int, total: int):
        self.items, self.floors, self.width, self.n, self.total = items, floors, width, n, total

    def prepare(self) -> None:
        """Items of each list and the coordinates that they look at there."""
        users: dict[int, list[int]] = {}
        for k, (_, _, lists) in enumerate(self.items):
            for t in lists.tolist():
                users.setdefault(t, []).append(k)
        self.lists = []
        for t, of in sorted(users.items()):
            cols = np.unique(np.concatenate([self.items[k][0] for k in of]))
            self.lists.append((t, cols, [(k, np.searchsorted(cols, self.items[k][0])) for k in of]))

    def impacts(self, n: np.ndarray, rows: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        m = 10 + (90 * n * self.n) // self.total
        return (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[rows])

    def tile(self, ids: np.ndarray, n: np.ndarray, ends: np.ndarray, cols: np.ndarray, tfs: np.ndarray, top: int) -> list[tuple[int, int, int]]:
        """(item, row, score) of the best of each item among these documents."""
        rows = np.repeat(np.arange(len(n)), np.diff(ends))
        x = np.zeros((len(n), self.width), np.float32)
        x[rows, cols] = self.impacts(n, rows, tfs.astype(np.int64))
        order = np.argsort(cols, kind="stable")
        start = np.searchsorted(cols[order], np.arange(self.width + 1))
        rows = rows[order]
        found: dict[int, list[np.ndarray]] = {}
        for t, dims, users in self.lists:
            docs = rows[start[t]:start[t + 1]]
            if not len(docs):
                continue
            part = x[docs[:, None], dims]
            turn, cuts = blocks(part)
            summary = np.maximum.reduceat(part[turn], cuts, axis=0).astype(float)
            docs, sizes = docs[turn], np.diff(np.append(cuts, len(docs)))
            for k, at in users:
                open_ = summary[:, at] @ self.items[k][1] >= self.floors[k]
                if open_.any():
                    found.setdefault(k, []).append(docs[np.repeat(open_, sizes)])
        out = []
        for k, lists in found.items():
            docs = np.unique(np.concatenate(lists))
            dims, weights, _ = self.items[k]
            score = x[docs[:, None], dims].astype(float) @ weights
            keep = (score >= self.floors[k]) & (score > 0)
            docs, score = docs[keep], score[keep]
            for j in np.lexsort((ids[docs], -score))[:top]:
                out.append((k, int(docs[j]), int(score[j])))
        return out


def blocks(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows, first row of each block): rows nearest to the same pivot row stand together."""
    n = len(part)
    if n <= BLOCK:
        return np.arange(n), np.zeros(1, np.int64)
    pivots = part[np.linspace(0, n - 1, min(MAX_PIVOTS, -(-n // BLOCK))).astype(np.int64)]
    near = (part @ pivots.T / np.maximum(np.linalg.norm(pivots, axis=1), 1)).argmax(axis=1)
    turn = np.argsort(near, kind="stable")
    fresh = np.diff(near[turn], prepend=-1) != 0
    place = np.arange(n) - np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return turn, np.flatnonzero(place % MAX_BLOCK == 0)


def _search(table: DataFrame, searcher: Searcher, top: int) -> DataFrame:
    """(item, doc_id, score): the best of each item, tile by tile, from a table of ``vectors``."""
    shared = table.sparkSession.sparkContext.broadcast(searcher)
    step = max(1, CELLS // searcher.width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        s.prepare()
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                b = batch.slice(lo, step)
                lists = [b.column(k) for k in (2, 3)]
                ends = lists[0].offsets.to_numpy()
                cols, tfs = (x.values.to_numpy()[ends[0]:ends[-1]] for x in lists)
                ids = b.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
                hits = s.tile(ids, b.column(1).to_numpy(), ends - ends[0], cols, tfs, top)
                if hits:
                    k, row, score = zip(*hits)
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), b.column(0).take(pa.array(row)), pa.array(score, pa.int64())],
                                                     names=["item", "doc_id", "score"])

    return table.mapInArrow(run, "item int, doc_id bigint, score bigint")


def _best(hits: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def _rank_block(docs: DataFrame, texts: list, top: int) -> DataFrame | None:
    """Ranking of the items with these texts; ``item`` is the place in the list."""
    wanted = [sorted(set(words)) for words in _terms(texts)]
    terms = sorted(set().union(*wanted))
    if not terms:
        return None
    column = {t: k for k, t in enumerate(terms)}
    table = written(vectors(docs, terms))
    n, total = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n:
        return None
    m = F.expr(f"10 + (90 * n * {n}L) div {total}L")
    entries = table.select(m.alias("m"), F.explode(F.arrays_zip("cols", "tfs")).alias("e")).select("m", F.col("e.cols").alias("t"), F.col("e.tfs").cast("bigint").alias("tf"))
    df, most = np.zeros(len(terms), np.int64), np.zeros(len(terms))
    for r in entries.groupBy("t").agg(F.count(F.lit(1)).alias("df"), F.expr("max((1000000000 * tf) div (1000 * tf + 8 * m))").alias("most")).collect():
        df[r.t], most[r.t] = r.df, r.most
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], float)
    items, probes = [], []
    for words in wanted:
        cols = np.array([column[w] for w in words], np.int64)
        cols = cols[df[cols] > 0]
        rare = cols[np.argsort(-weight[cols], kind="stable")]
        enough = int(np.searchsorted(np.cumsum(df[rare]), PROBE)) + 1
        items.append((cols, weight[cols], rare[:0]))
        probes.append((cols, weight[cols], rare[:enough]))
    floors = np.zeros(len(items))
    probe = Searcher(probes, floors, len(terms), n, total)
    for r in _best(_search(table, probe, top), top).filter(F.col("rank") == top).select("item", "score").collect():
        floors[r.item] = r.score
    for k, (cols, w, _) in enumerate(items):
        bound = w * most[cols]
        turn = np.argsort(bound, kind="stable")
        spare = int(np.searchsorted(np.cumsum(bound[turn]), floors[k]))  # lists whose sum stays under the floor
        items[k] = (cols, w, cols[turn[spare:]])
    return _best(_search(table, Searcher(items, floors, len(terms), n, total), top), top)


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item, from all documents."""
    spark = docs.sparkSession
    small_batches(spark, rows=2048)
    rows = written(items.select("item_id", F.col("text").cast("binary").alias("text")).withColumn("row", F.monotonically_increasing_id()))
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n_blocks = max(1, -(-n // ITEM_ROWS), -(-size // ITEM_BYTES))
    block = F.pmod(F.xxhash64("row"), F.lit(n_blocks))
    out = None
    for b in range(n_blocks):
        held = rows.filter(block == b).select("row", "text").collect()
        hits = _rank_block(docs, [r.text for r in held], top)
        if hits is None:
            continue
        place = spark.createDataFrame([(k, r.row) for k, r in enumerate(held)], "item int, row bigint")
        named = (hits.join(place, "item").join(rows.select("row", "item_id"), "row")
                 .select("item_id", "rank", "doc_id", "score"))
        out = named if out is None else out.unionByName(named)
    if out is None:
        kind = dict(items.dtypes)["item_id"]
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return out
