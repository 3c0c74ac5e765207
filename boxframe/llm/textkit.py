"""Shared helpers: table readers, word and shingle fingerprints over batches of UTF-8 texts.

Words are maximal runs of bytes other than space and 0x09-0x0D, so a word never depends on
Unicode tables.  Fingerprints are 64-bit: every byte goes through a table of random 64-bit
values, a polynomial over them is taken modulo 2^64 with prefix sums, and the result is mixed.
All words of a batch are hashed by a handful of numpy calls."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from boxframe.session import ensure_checkpoint_dir

SEP = 0x0A
_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240607))
BYTE_VALUES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = _U(0x9E3779B97F4A7C15)  # odd, so its powers can be inverted modulo 2^64
BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes hashed at once; temporary arrays are a few times eight bytes each of these.
SEGMENT = 1 << 19


def small_batches(spark: SparkSession, rows: int = 512, size: str = "8m") -> None:
    """Arrow batches of few rows, so that a Python worker holds little of long texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


_POW = _powers(BASE, SEGMENT + 1)
_INV = _powers(BASE_INV, SEGMENT + 1)


def _segment_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word start offsets, word fingerprints) of one buffer of at most SEGMENT bytes."""
    space = IS_SPACE[buf]
    edge = np.empty(len(buf) + 1, bool)
    edge[0] = not space[0]
    edge[-1] = not space[-1]
    np.not_equal(space[1:], space[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    start, end = at[0::2], at[1::2]
    if not len(start):
        return start, np.zeros(0, np.uint64)
    sums = np.empty(len(buf) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[buf] * _POW[: len(buf)], out=sums[1:])
    h = (sums[end] - sums[start]) * _INV[start]
    return start, mix(h + (end - start).astype(np.uint64))


def _long_words(raw: bytes) -> np.ndarray:
    """Word fingerprints of one text longer than SEGMENT, cut at white space.  A single word
    longer than a segment is hashed by folding the fingerprints of its pieces."""
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + SEGMENT)
        if end < len(raw):
            cut = max(raw.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut > at:
                end = cut
            elif not IS_SPACE[raw[at]]:
                stop, h = at, _U(0)
                while stop < len(raw) and not IS_SPACE[raw[stop]]:
                    nxt = min(len(raw), stop + SEGMENT)
                    piece = np.frombuffer(raw, np.uint8, nxt - stop, stop)
                    gap = np.flatnonzero(IS_SPACE[piece])
                    piece = piece[: gap[0]] if len(gap) else piece
                    h = mix(np.array([h]) * BASE + _segment_words(piece)[1])[0] if len(piece) else h
                    stop += len(piece)
                out.append(np.array([h], np.uint64))
                at = stop
                continue
            else:
                end = at + 1
        out.append(_segment_words(np.frombuffer(raw, np.uint8, end - at, at))[1])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def word_hashes(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Per text, in order, the fingerprints of its words (any number of texts, any length)."""
    group: list[bytes] = []
    held = 0

    def flush() -> Iterator[np.ndarray]:
        if not group:
            return
        buf = np.frombuffer(b"\n".join(group), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in group])
        if len(buf):
            start, h = _segment_words(buf)
        else:
            start, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        cuts = np.searchsorted(start, ends)
        at = 0
        for c in cuts:
            yield h[at:c]
            at = c

    for t in texts:
        if len(t) >= SEGMENT // 2:
            yield from flush()
            group, held = [], 0
            yield _long_words(t)
            continue
        if held + len(t) + 1 > SEGMENT:
            yield from flush()
            group, held = [], 0
        group.append(t)
        held += len(t) + 1
    yield from flush()


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of the k-word windows of one text, in order (one for the whole sequence
    when the text has between 1 and k-1 words; none without words)."""
    n = len(words)
    if n == 0:
        return words
    w = min(n, k)
    h = np.full(n - w + 1, w, np.uint64)
    for j in range(w):
        h = mix(h * BASE + words[j: j + n - w + 1])
    return h


def as_bytes(values, lower: bool = False) -> list[bytes]:
    """Column of str, bytes or None to bytes; ``lower`` folds A-Z only."""
    out = []
    for v in values:
        b = b"" if v is None or v != v else (v.encode("utf-8", "surrogatepass") if isinstance(v, str) else bytes(v))
        out.append(b.lower() if lower else b)
    return out


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table below the session's checkpoint folder: lineage is cut and the measured size is
    known to the optimizer."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
