"""Phrase collocations per language by top-order marginalisation.

Each word starts one window: itself and the next two words of its piece (the lead columns), padded with ''
at the end of a piece.  Only these longest windows are counted; Spark's ROLLUP over (w1, w2, w3) sums the counted
windows to the counts of pairs, of words and of the language, so shorter n-grams are never exploded.

A phrase counts from ``MIN_COUNT`` occurrences on, and so do all its parts.  Words and continuations that cannot
be part of such a phrase are therefore padded as well: a first pass hashes words, pairs and triples into cells and
keeps one bit a cell, set if the cell was met ``MIN_COUNT`` times or more.  What is frequent always has its bit, so
no count that matters changes; rare ones that share its cell only make more windows than needed.  The bits follow the bytes
of text (``BYTES_A_CELL``) up to ``MAX_BITS``; fewer bits mean more windows, never other results.

Windows are made by numpy in Arrow batches, added up within a task first and then by Spark, whose rows hold
the words themselves.  A language, word or pair with a large share of the rows is one row per task and key.  A
text is read in pieces of ``SEGMENT`` bytes, so a task holds some windows, one text and its longest word.

Defined cases: null text counts as empty, null lang as 'und' (together with a lang of that name); texts without
words add nothing; repeated rows count each time; ids are never read; ties in the ranking go to the smaller
phrase in UTF-8 byte order, and no two phrases of a language are equal; an empty table gives no rows; other
columns, whatever their names, are never read."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.llm.textkit import BASE, BASE_INV, BYTE_VALUES, SEGMENT, _powers, as_bytes, mix, small_batches, written

MIN_COUNT = 10
#: Share of a longer candidate, in per cent, from which a candidate inside it is dropped.
INSIDE = 50
TOP = 2000
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: One cell for so many bytes of text, so that cells of rare pairs stay under MIN_COUNT.
BYTES_A_CELL = 16
#: 128 MB as a bitmap, held once by the driver and by each Python worker.
MIN_BITS, MAX_BITS = 16, 30
#: Bytes of text whose windows a task adds up at once, and cells.
GROUP = 1 << 23
FLUSH = 1 << 23
#: Tasks whose cells are added up together first.
TOGETHER = 256
CELL_ROWS = 1 << 16
_U = np.uint64
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[np.frombuffer(SEPARATORS, np.uint8)] = 2
_BREAK = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_powers_of: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers_of.get(int(base))
    if have is None or len(have) < n:
        have = _powers_of[int(base)] = _powers(base, max(n, SEGMENT + 4096))
    return have[:n]


def _segments(raw: bytes) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of about SEGMENT bytes, each cut after a byte between words."""
    at = 0
    while at < len(raw):
        m = _BREAK.search(raw, at + SEGMENT) if at + SEGMENT < len(raw) else None
        end = m.end() if m else len(raw)
        yield at, end
        at = end


def tokenise(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, fingerprint, number of separators before) of the words of lower-cased bytes."""
    parts, seps = [], 0
    for lo, hi in _segments(raw):
        buf = np.frombuffer(raw, np.uint8, hi - lo, lo)
        kind = _KIND[buf]
        gap = kind != 0
        edge = np.empty(len(buf) + 1, bool)
        edge[0], edge[-1] = not gap[0], not gap[-1]
        np.not_equal(gap[1:], gap[:-1], out=edge[1:-1])
        at = np.flatnonzero(edge)
        start, end = at[0::2], at[1::2]
        sums = np.empty(len(buf) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(BYTE_VALUES[buf] * _power(BASE, len(buf)), out=sums[1:])
        h = mix((sums[end] - sums[start]) * _power(BASE_INV, len(buf) + 1)[start] + (end - start).astype(np.uint64))
        where = np.flatnonzero(kind == 2)
        place = np.int64 if len(raw) >> 31 else np.int32
        parts.append(((start + lo).astype(place), (end + lo).astype(place), h, (np.searchsorted(where, start) + seps).astype(place)))
        seps += len(where)
    if not parts:
        none = np.zeros(0, np.int32)
        return none, none, np.zeros(0, np.uint64), none
    return tuple(np.concatenate(p) for p in zip(*parts))  # type: ignore[return-value]


class _Words:
    """Words of some texts, one after the other, with the language of each."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.names = sorted(set(langs))
        code = {x: k for k, x in enumerate(self.names)}
        self.raw = b"\n".join(texts)  # a separator: no piece goes over two texts
        self.start, self.end, self.h, piece = tokenise(self.raw)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.lang = np.array([code[x] for x in langs], np.int32)[np.searchsorted(ends, self.start, side="right")]
        self.next1 = np.zeros(len(self.h), bool)
        self.next2 = np.zeros(len(self.h), bool)
        self.next1[:-1] = piece[1:] == piece[:-1]
        self.next2[:-2] = piece[2:] == piece[:-2]

    def cells(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells of the words, and of the pairs and triples that start at each word that has enough after it."""
        seed = np.array([tokenise(b"x" + n.encode("utf-8", "surrogatepass").hex().encode())[2][0] for n in self.names], np.uint64)
        down = _U(64 - bits)
        word = mix(seed[self.lang] + self.h)
        pair = mix(word[:-1] * BASE + self.h[1:])
        triple = mix(pair[:-1] * BASE + self.h[2:])
        return tuple((x >> down).astype(np.uint32) for x in (word, pair, triple))


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[_Words]:
    texts: list[bytes] = []
    langs: list[str] = []
    held = 0
    for batch in batches:
        for raw, lang in zip(as_bytes(batch.column(0).to_pylist(), lower=True), batch.column(1).to_pylist()):
            if not raw:
                continue
            if texts and held + len(raw) > size:
                yield _Words(texts, langs)
                texts, langs, held = [], [], 0
            texts.append(raw)
            langs.append(lang)
            held += len(raw)
    if texts:
        yield _Words(texts, langs)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("binary").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))


def cell_bits(docs: DataFrame) -> int:
    """Base-two logarithm of the number of cells for these texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MAX_BITS, max(MIN_BITS, (size // BYTES_A_CELL).bit_length()))


def frequent_cells(docs: DataFrame, bits: int, min_count: int = MIN_COUNT) -> np.ndarray:
    """One bit for each of 2**bits cells of words, pairs and triples: whether they were met ``min_count`` times together.

    Tasks send the cells they met, 65,536 neighbours a row; rows of the same neighbours are added up in two
    steps, so a group holds a bounded number of them.  The driver gets the bits alone."""
    cap = min(min_count, 255)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            cell, n = np.unique(np.concatenate(held), return_counts=True)
            n = np.minimum(n, cap).astype(np.uint8)
            low = cell.astype(np.uint16)
            block, at = np.unique(cell >> np.uint32(16), return_index=True)
            cuts = [*at.tolist(), len(cell)]
            for k in range(0, len(block), 4096):
                part = range(k, min(len(block), k + 4096))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[k: k + 4096].astype(np.int32)), pa.array([low[cuts[j]:cuts[j + 1]].tobytes() for j in part], pa.binary()),
                     pa.array([n[cuts[j]:cuts[j + 1]].tobytes() for j in part], pa.binary())], names=["block", "low", "n"])

        size = 0
        for words in _groups(batches, SEGMENT):
            word, pair, triple = words.cells(bits)
            more = [word, pair[words.next1[:-1]], triple[words.next2[:-2]]]
            held += more
            size += sum(map(len, more))
            if size > FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def add(rows: pd.DataFrame) -> np.ndarray:
        total = np.zeros(CELL_ROWS, np.int64)
        for low, n in zip(rows["low"], rows["n"]):
            total[np.frombuffer(low, np.uint16)] += np.frombuffer(n, np.uint8)  # cells of a row differ
        return np.minimum(total, cap).astype(np.uint8)

    def some(rows: pd.DataFrame) -> pd.DataFrame:
        total = add(rows)
        low = np.flatnonzero(total).astype(np.uint16)
        return pd.DataFrame({"block": rows["block"][:1].values, "low": [low.tobytes()], "n": [total[low].tobytes()]})

    def last(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": rows["block"][:1].values, "bits": [np.packbits(add(rows) >= cap).tobytes()]})

    met = _texts(docs).mapInArrow(meet, "block int, low binary, n binary").withColumn("part", F.floor(F.spark_partition_id() / TOGETHER))
    some_of = met.groupBy("block", "part").applyInPandas(some, "block int, low binary, n binary")
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    for r in some_of.groupBy("block").applyInPandas(last, "block int, bits binary").toLocalIterator():
        part = np.frombuffer(r.bits, np.uint8)
        out[r.block * (CELL_ROWS // 8):][: len(part)] = part
    return out


def _joined(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Array:
    """Strings of the slices (bytes, start, size) of each part in turn, with a tab between two parts."""
    ends = np.cumsum(sum(size.astype(np.int64) for _, _, size in parts) + len(parts) - 1)
    out = np.full(ends[-1], 0x09, np.uint8)
    at = np.concatenate([[0], ends[:-1]])
    for raw, start, size in parts:
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(at, size) + step] = raw[np.repeat(start, size) + step]
        at = at + size + 1
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes()))


def windows(docs: DataFrame, bits: int, frequent: np.ndarray) -> DataFrame:
    """(gram, n): padded longest windows of each task's texts with their number there.  A gram is w1, w2, w3 and lang
    with tabs between (no word has one): one string makes smaller rows to shuffle than four."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def often(cell: np.ndarray) -> np.ndarray:
        return (shared.value[cell >> np.uint32(3)] >> (7 - (cell & np.uint32(7))).astype(np.uint8) & 1).astype(bool)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _groups(batches, GROUP):
            n = len(words.h)
            if not n:
                continue
            word, pair, triple = words.cells(bits)
            one = often(word)
            two = words.next1 & one
            two[:-1] &= one[1:] & often(pair)
            three = two & words.next2
            three[:-1] &= two[1:]
            three[:-2] &= often(triple)
            del word, pair, triple
            zero = _U(0)
            key = mix(words.lang.astype(np.uint64) + np.where(one, words.h, zero)) * BASE
            key[:-1] += np.where(two[:-1], words.h[1:], zero)
            key = mix(key) * BASE
            key[:-2] += np.where(three[:-2], words.h[2:], zero)
            _, at, many = np.unique(key, return_index=True, return_counts=True)
            near = words.h[at] & _U(0xFFFFFFFF00000000)  # windows with equal first words stand together: their rows compress
            near |= np.where(two[at], words.h[np.minimum(at + 1, n - 1)] >> _U(32), zero)
            turn = np.argsort(near)
            at, many = at[turn], many[turn]
            raw, size = np.frombuffer(words.raw, np.uint8), words.end - words.start
            names = [x.encode("utf-8", "surrogatepass") for x in words.names]
            name_size = np.array([len(x) for x in names])
            name = (np.frombuffer(b"".join(names) or b" ", np.uint8), np.cumsum(name_size) - name_size, name_size)
            for k in range(0, len(at), 1 << 16):
                i = at[k: k + (1 << 16)]
                parts = []
                for step, kept in ((0, one), (1, two), (2, three)):
                    j = np.minimum(i + step, n - 1)
                    parts.append((raw, words.start[j], np.where(kept[i], size[j], 0)))
                parts.append((name[0], name[1][words.lang[i]], name[2][words.lang[i]]))
                yield pa.RecordBatch.from_arrays([_joined(parts), pa.array(many[k: k + (1 << 16)].astype(np.int64))], names=["gram", "n"])

    return _texts(docs).mapInArrow(count, "gram string, n bigint")


def ngram_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, w1, w2, w3, n) of the words, pairs and triples met ``min_count`` times or more (absent words are
    ''), and of each language as a whole (all three '')."""
    spark = docs.sparkSession
    small_batches(spark)
    bits = cell_bits(docs)
    top = windows(docs, bits, frequent_cells(docs, bits, min_count)).groupBy("gram").agg(F.sum("n").alias("n"))
    field = F.split("gram", "\t", 4)
    top = top.select(*[field[k].alias(c) for k, c in enumerate(("w1", "w2", "w3", "lang"))], "n")
    rolled = spark.sql("""SELECT lang, w1, w2, w3, grouping_id() AS level, sum(n) AS n
                          FROM {top} GROUP BY lang, ROLLUP (w1, w2, w3)""", top=top)
    last, often = F.expr("CASE level WHEN 0 THEN w3 WHEN 1 THEN w2 WHEN 3 THEN w1 END"), F.col("n") >= min_count
    return (rolled.filter((F.col("level") == 7) | (last != "") & often)
            .select("lang", *[F.coalesce(c, F.lit("")).alias(c) for c in ("w1", "w2", "w3")], "n"))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in exact decimals."""
    big = lambda c: c.cast("decimal(19,0)")
    above = (F.lit(1_000_000).cast("decimal(7,0)") * big(a) * big(a)).cast("decimal(38,0)")
    return F.call_function("div", above, (big(left) * big(right)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of each language."""
    counts = written(ngram_counts(docs, min_count))
    whole = counts.filter("w1 = ''").select("lang", F.col("n").alias("total"))
    one = counts.filter("w1 <> '' and w2 = ''").select("lang", "w1", "n")
    two = counts.filter("w2 <> '' and w3 = ''").select("lang", "w1", "w2", "n")
    three = counts.filter("w3 <> ''")
    word = lambda c, n: one.select("lang", F.col("w1").alias(c), F.col("n").alias(n))
    pair = lambda c, d, n: two.select("lang", F.col("w1").alias(c), F.col("w2").alias(d), F.col("n").alias(n))
    a = F.col("n")
    pairs = two.join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
    longer = (three.select("lang", "n", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"))
              .groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")).agg(F.max("n").alias("longer")))
    pairs = (pairs.join(longer, ["lang", "w1", "w2"], "left").filter(F.coalesce(100 * F.col("longer") < inside * a, F.lit(True)))
             .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), a.alias("a"), "l", "r", _score(a, F.col("l"), F.col("r")).alias("score")))
    cuts = (three.join(word("w1", "l1"), ["lang", "w1"]).join(word("w3", "r2"), ["lang", "w3"])
            .join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"]).join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"]))
    s1, s2 = _score(a, F.col("l1"), F.col("r1")), _score(a, F.col("l2"), F.col("r2"))
    cuts = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), a.alias("a"), "l1", "r1", "l2", "r2", s1.alias("s1"), s2.alias("s2"))
    first = F.col("s1") <= F.col("s2")
    triples = cuts.select("lang", "phrase", "a", *[F.when(first, F.col(x)).otherwise(F.col(y)).alias(z)
                                                   for x, y, z in (("l1", "l2", "l"), ("r1", "r2", "r"), ("s1", "s2", "score"))])
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    spread = F.pmod(F.xxhash64("phrase"), F.lit(16))  # no task sorts all phrases of a language
    best = (pairs.unionByName(triples).withColumn("part", spread)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top))
    return (best.join(whole, "lang")
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))
