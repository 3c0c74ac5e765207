"""Token counts by compiled finite-state transducers (see ``transducer``).

Counts equal those of the tokenizers library for a byte-level BPE file, without added tokens; special
strings inside a text are cut out first and count as one token each, as the library does by default.
One narrow pass over the texts, no shuffle.  Long texts are cut before white space that follows a
word, where no pre-token can reach across, so memory is bounded by ``PIECE`` characters.

Defined cases: null text counts as empty (0 bytes, 0 tokens); repeated rows get equal counts; null
ids stay null."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.textkit import small_batches
from boxframe.llm.transducer import Merger, Splitter

LIMIT = 512
PIECE = 1 << 19


@lru_cache(maxsize=2)
def _machines(path: str) -> tuple[Splitter, Merger]:
    return Splitter(), Merger(path)


def pieces(text: str, special: list[str]) -> tuple[list[str], int]:
    """(parts without special strings, each of about PIECE characters at most; special strings met)."""
    parts = re.split("|".join(map(re.escape, sorted(special, key=len, reverse=True))), text) if special and any(s in text for s in special) else [text]
    out = []
    for part in parts:
        at = 0
        while len(part) - at > PIECE:
            cut = part.rfind(" ", at + 1, at + PIECE)
            while cut > at and part[cut - 1].isspace():
                cut = part.rfind(" ", at + 1, cut)
            if cut <= at:
                nxt = re.compile(r"(?<=\S) ").search(part, at + PIECE)
                if nxt is None:
                    break
                cut = nxt.start()
            out.append(part[at:cut])
            at = cut
        out.append(part[at:])
    return out, len(parts) - 1


def count_texts(texts: list[str], path: str) -> list[int]:
    """Tokens of each text."""
    splitter, merger = _machines(path)
    counts = [0] * len(texts)
    group: list[str] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        if not group:
            return
        joined = "\n".join(group) + "\n"
        ends = np.cumsum([len(g) + 1 for g in group]) - 1
        starts = splitter.starts(joined, ends)
        first = np.searchsorted(starts, ends)  # each end is a start of its own
        at = starts.tolist()
        cached, count = merger.words.get, merger.count
        lo = 0
        for own, hi in zip(owner, first.tolist()):
            n = 0
            for a, b in zip(at[lo:hi], at[lo + 1:hi + 1]):
                word = joined[a:b]
                n += cached(word) or count(word)
            counts[own] += n
            lo = hi + 1
        group.clear()
        owner.clear()

    for i, text in enumerate(texts):
        parts, met = pieces(text, merger.special)
        counts[i] += met
        for part in parts:
            if part:
                group.append(part)
                owner.append(i)
                held += len(part) + 1
                if held > PIECE:
                    flush()
                    held = 0
    flush()
    return counts


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document under the vocabulary file ``path``,
    which every executor has in the same place."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(count_texts(list(texts), path), dtype="int64")

    text = F.coalesce("text", F.lit(""))
    return (docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), count(text).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
