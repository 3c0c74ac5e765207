"""Token-ID output: documents as one stream of ids in files of range-coded blocks (see ``rangecoder``).

Documents are dealt to files by ranges of doc_id, sorted, tokenised and coded in one task per file;
texts cross the network once.  A file is the rows (file, block, docs, data) of one task: ``data`` is
the container of at most ``rangecoder.BLOCK`` ids, ``docs`` lists the documents that begin in the block
(id, offset of its first id, number of ids).  The table is Parquet below the session's checkpoint
folder, so it works on any file system that Spark reads.  A task holds the blocks that are coded
together and no more, whatever the length of a document.

Reading back streams the blocks of a file in order; checksums of documents run across blocks.

Ids are those of the tokenizers library, without added tokens.  Words between ASCII white space are
encoded once per worker and remembered (at most ``MAX_WORDS``): in vocabularies that lower-case and
whose pre-tokenizer drops white space, an id never depends on what is beyond it.

Defined cases: null text counts as empty (the end id alone); null ids sort first; repeated rows are
repeated documents, equal ids in the order of their texts' hashes, so every row's result is the same
whatever their order; an empty table gives an empty stream."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxframe.llm import rangecoder
from boxframe.llm.textkit import small_batches, written

END_ID = 1
MAX_WORDS = 1_000_000
_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")
_ODD = re.compile("[\x1c-\x1f]")  # str.split takes these for white space, the vocabulary does not
_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int32()), ("n", pa.int64())]))


class WordTokenizer:
    """Ids of texts, word by word, for a tokenizers file that drops white space."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.id_bits = max(6, (self.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for _, t in sorted(added.items())]
        self.parting = min(added) if added else -1
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(MAX_WORDS + 1, np.int64)
        self.used = 0

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words one after the other, number of ids of each word).  Words go to the library
        as one text with a special token between them, which parts them as separate texts would; if
        one of them holds such a token, each goes alone."""
        if self.special:
            text = self.special[0].join(words)
            if sum(text.count(t) for t in self.special) == len(words) - 1:
                ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                cuts = np.flatnonzero(ids == self.parting)
                return ids[ids != self.parting], np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
        lists = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        return np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists])

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 2000):
            part = words[at:at + 2000]
            ids, sizes = self._encode(part)
            k, n = len(self.index), len(ids)
            while self.used + n > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
            self.flat[self.used: self.used + n] = ids
            self.starts[k + 1: k + 1 + len(part)] = self.used + sizes.cumsum()
            self.used += n
            self.index.update(zip(part, range(k, k + len(part))))

    def ids(self, text: str) -> np.ndarray:
        if text.isascii() and "<|" not in text:
            text = text.lower()  # as the vocabulary does; fewer words to learn
        words = text.split() if not _ODD.search(text) else [w for w in _SPACE.split(text) if w]
        out = []
        for at in range(0, len(words), MAX_WORDS // 2):
            part = words[at:at + MAX_WORDS // 2]
            new = [w for w in dict.fromkeys(part) if w not in self.index]
            if len(self.index) + len(new) > MAX_WORDS:
                self._reset()
                new = list(dict.fromkeys(part))
            if new:
                self._learn(new)
            k = np.fromiter(map(self.index.__getitem__, part), np.int64, len(part))
            lo = self.starts[k]
            n = self.starts[k + 1] - lo
            ends = n.cumsum()
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.flat[np.repeat(lo - ends + n, n) + np.arange(total)])
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def write_ids(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of ``docs`` in ascending doc_id order; returns the written blocks
    (file, block, docs, data)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        file, block, size = TaskContext.get().partitionId(), 0, rangecoder.BLOCK
        held: list[np.ndarray] = []  # ids not written yet
        begun: list[tuple[int | None, int, int]] = []  # (doc_id, offset in held, ids)
        n = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, begun, n, block
            ids = np.concatenate(held) if held else np.zeros(0, np.uint32)
            count = -(-n // size) if last else n // size
            cut = [ids[i * size:(i + 1) * size] for i in range(count)]
            lists: list[list] = [[] for _ in cut]
            rest = []
            for doc, at, k in begun:
                if at // size < count:
                    lists[at // size].append({"doc_id": doc, "at": at % size, "n": k})
                else:
                    rest.append((doc, at - count * size, k))
            data = rangecoder.encode_blocks(cut, tok.id_bits)
            for lo in range(0, count, 256):
                hi = min(count, lo + 256)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * (hi - lo), pa.int32()), pa.array(range(block + lo, block + hi), pa.int64()),
                     pa.array(lists[lo:hi], _DOCS), pa.array(data[lo:hi], pa.binary())], names=["file", "block", "docs", "data"])
            block += count
            held, begun = [ids[count * size:]], rest
            n = len(held[0])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(tok.ids(text), np.uint32(end_id))
                begun.append((doc, n, len(ids)))
                held.append(ids)
                n += len(ids)
                if n >= rangecoder.LANES * size:
                    yield from flush(False)
        yield from flush(True)

    text = F.coalesce("text", F.lit(""))
    ordered = (docs.select(F.col("doc_id").cast("bigint"), text.alias("text"))
               # the last two part repeated ids, so that they need not meet in one task
               .repartitionByRange("doc_id", F.xxhash64("text"), F.monotonically_increasing_id())
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    return written(ordered.mapInArrow(run, "file int, block bigint, docs array<struct<doc_id:bigint,at:int,n:bigint>>, data binary"))


def read_ids(blocks: DataFrame) -> DataFrame:
    """(file, doc_id, at, n_tokens, ids_crc32) of every document in written blocks; ``at`` counts the ids
    before it in its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "doc_id", "at", "n_tokens", "ids_crc32"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        pending: list[tuple] = []
        open_doc: list | None = None  # [file, doc_id, at, ids, crc, ids still to come]
        file, before = None, 0

        def decode() -> Iterator[pa.RecordBatch]:
            nonlocal open_doc, file, before
            out = []
            for (f, docs, _), ids in zip(pending, rangecoder.decode_blocks([p[2] for p in pending])):
                if f != file:
                    file, before = f, 0
                raw = ids.astype("<u4")
                if open_doc is not None:
                    k = min(open_doc[5], len(raw))
                    open_doc[4] = zlib.crc32(raw[:k].tobytes(), open_doc[4])
                    open_doc[5] -= k
                    if not open_doc[5]:
                        out.append(tuple(open_doc[:5]))
                        open_doc = None
                for d in docs:
                    lo, n = d["at"], d["n"]
                    k = min(n, len(raw) - lo)
                    row = [f, d["doc_id"], before + lo, n, zlib.crc32(raw[lo:lo + k].tobytes()), n - k]
                    if row[5]:
                        open_doc = row
                    else:
                        out.append(tuple(row[:5]))
                before += len(raw)
            pending.clear()
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))):
                pending.append(row)
                if len(pending) == rangecoder.LANES:
                    yield from decode()
        if pending:
            yield from decode()
        if open_doc is not None:
            raise ValueError("a file ends inside a document")

    small_batches(blocks.sparkSession)
    return (blocks.repartition("file").sortWithinPartitions("file", "block").select("file", "block", "docs", "data")
            .mapInArrow(run, "file int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"))


def document_ids(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the written blocks."""
    blocks = write_ids(docs, path, end_id)
    rows = written(read_ids(blocks))
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("s"))
    # one row per file: ids in the files before it
    base = sums.select("file", F.coalesce(F.sum("s").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return (rows.join(base, "file").select("doc_id", (F.col("base") + F.col("at")).cast("bigint").alias("start"), "n_tokens", "ids_crc32"))
