"""MinHash near-duplicates with sequential Bayesian verification.

Two documents are linked when the Jaccard similarity of their sets of distinct k-word shingles
reaches ``threshold``; the classes are the connected components of these links.

1. Every text gives its shingle set (64-bit fingerprints), a 128-bit fingerprint of the whole set and
   MinHash bands, in one pass over the documents.  Documents with equal sets become one node (a
   partial minimum), so a group of copies of any size costs one node from here on.
2. Bands are chosen so that a pair at the threshold shares none with at most ``BAND_MISS``.
   Round one compares every node with one hub only, the node of its buckets that shares buckets with
   most others (of a group of copies that is the text they derive from): at most one candidate per
   node.  Then components are taken.
3. Round two covers the rest: in buckets that still hold several components, nodes outside the
   largest one are compared with the nodes of other components.  Buckets are laid out in blocks of
   ``BLOCK`` nodes; a task holds two blocks and compares their signatures as matrices.  All pairs of
   the bucket are looked at, but a task returns only links that join two components, so fewer rows
   than it has nodes.  After it, every pair that shares a band was either compared or is in one
   component.
4. Comparing is sequential: after each batch of ``BATCH`` signature values, a pair is pruned when the
   posterior probability of reaching the threshold (uniform prior) is under ``MISS``.  Survivors are
   verified exactly on their full shingle sets.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text with fewer than k words
is one shingle of all its words; texts without words, and null texts, have an empty set and link with
nothing; repeated rows form one node; a component's id is its smallest id that is not null (null if
there is none); a row is kept when its id equals the component's."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.graph import components
from boxframe.llm.textkit import as_bytes, mix, shingles, small_batches, word_hashes
from boxframe.session import cut_lineage

SIGNATURE = 128
#: Chance that a pair exactly at the threshold shares no band.
BAND_MISS = 5e-5
#: Chance below which a pair is given up before its sets are compared.
MISS = 1e-5
BATCH = 16
BLOCK = 256
_RNG = np.random.Generator(np.random.PCG64(77))
_A = _RNG.integers(0, 1 << 32, SIGNATURE, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, SIGNATURE, dtype=np.uint64).astype(np.uint32)
_SET_SALT = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))


def band_rows(threshold: float) -> int:
    """Signature values in a band: as many as ``BAND_MISS`` allows."""
    best = 1
    for r in range(1, 17):
        if (1.0 - threshold ** r) ** (SIGNATURE // r) <= BAND_MISS:
            best = r
    return best


def least_matches(threshold: float) -> list[int]:
    """For 16, 32, ... compared values, the least number of matches that is not pruned.  With a
    uniform prior, P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(BATCH, SIGNATURE + 1, BATCH):
        below, m = 0.0, 0
        while m <= n:
            below += math.comb(n + 1, m) * threshold ** m * (1.0 - threshold) ** (n + 1 - m)
            if below >= MISS:
                break
            m += 1
        out.append(m)
    return out


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    return np.unique(shingles(words, k))


def set_key(s: np.ndarray) -> bytes:
    """128-bit fingerprint of a set, whatever the order."""
    return b"".join(np.add.reduce(mix(s ^ salt)).tobytes() for salt in _SET_SALT)


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash signature of a set that is not empty."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(out, (x[at:at + 1024, None] * _A + _B).min(0), out=out)
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    n = SIGNATURE // rows
    h = np.arange(n, dtype=np.uint64)
    for j in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[j: n * rows: rows])
    return h


def fingerprints(docs: DataFrame, k: int, threshold: float) -> DataFrame:
    """(doc_id, n_shingles, node, bands, v) of every document; node and bands are null without words, v is
    a hash of the text."""
    rows = band_rows(threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, words in zip(b["doc_id"], word_hashes(as_bytes(b["text"], lower=True))):
                s = shingle_set(words, k)
                if len(s):
                    out.append((doc, len(s), set_key(s), band_keys(signature(s), rows).view(np.int64)))
                else:
                    out.append((doc, 0, None, None))
            yield pd.DataFrame({"doc_id": pd.array([r[0] for r in out], "Int64"), "n_shingles": [r[1] for r in out],
                                "node": [r[2] for r in out], "bands": [r[3] for r in out], "v": b["v"].to_numpy()})

    return (docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text")).withColumn("v", F.xxhash64("text"))
            .mapInPandas(run, "doc_id bigint, n_shingles bigint, node binary, bands array<bigint>, v bigint"))


def chosen_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, v, text) of the rows that ``nodes`` (node, rep, v) name by id and text hash: one for each
    node, besides repeated rows, also when many texts share an id or have none."""
    pick = nodes.select("node", F.col("rep").alias("__rep"), F.col("v").alias("__v"))
    return (docs.select("doc_id", F.col("text").cast("binary").alias("text")).withColumn("v", F.xxhash64("text"))
            .join(pick, F.col("doc_id").eqNullSafe(F.col("__rep")) & (F.col("v") == F.col("__v"))).select("node", "v", "text"))


def _payload(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, sig, items) of ``nodes`` (node, rep, v), from the texts they name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for node, words in zip(b["node"], word_hashes(as_bytes(b["text"], lower=True))):
                s = shingle_set(words, k)
                if len(s) and set_key(s) == bytes(node):  # another text may have the same hash
                    out.append((node, signature(s).tobytes(), s.tobytes()))
            yield pd.DataFrame(out, columns=["node", "sig", "items"])

    return (chosen_texts(docs, nodes).groupBy("node", "v").agg(F.any_value("text").alias("text"))  # repeated rows once
            .select("node", "text").mapInPandas(run, "node binary, sig binary, items binary"))


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Exact test on two sorted sets, in hundredths so that a tie with the threshold counts."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) * 100 < round(threshold * 100) * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= round(threshold * 100) * (len(a) + len(b) - both)


def survives(sa: np.ndarray, sb: np.ndarray, least: list[int]) -> bool:
    """Whether two signatures pass every batch."""
    matches = 0
    for i, need in enumerate(least):
        matches += int((sa[i * BATCH:(i + 1) * BATCH] == sb[i * BATCH:(i + 1) * BATCH]).sum())
        if matches < need:
            return False
    return True


def _verified(pairs: DataFrame, payload: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose signatures survive and whose sets are similar."""
    least = least_matches(threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            keep = []
            for sa, sb, ia, ib in zip(p["sig_a"], p["sig_b"], p["items_a"], p["items_b"]):
                ok = survives(np.frombuffer(sa, np.uint32), np.frombuffer(sb, np.uint32), least)
                keep.append(ok and similar(np.frombuffer(ia, np.uint64), np.frombuffer(ib, np.uint64), threshold))
            yield p.loc[np.array(keep, bool), ["a", "b"]]

    side = lambda c: payload.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("items").alias(f"items_{c}"))
    # a is the varied side; b may be one hub for very many pairs and is joined last, where Spark splits it
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "sig_b", "items_a", "items_b")
            .mapInPandas(run, "a binary, b binary"))


def _links(members: DataFrame, payload: DataFrame, threshold: float) -> DataFrame:
    """Similar pairs (a, b) that join different components of a bucket.  ``members`` is (h, node, comp)
    of buckets with several components."""
    least, rows_in_band = least_matches(threshold), band_rows(threshold)
    counts = members.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
    major = counts.groupBy("h").agg(F.max(F.struct("c", "comp")).alias("m"), F.sum("c").alias("size"))
    rows = members.join(major.select("h", F.col("m.comp").alias("major"), "size"), "h")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)).cast("int")
    # a node's block within its bucket; a block holds about BLOCK nodes
    rows = rows.withColumn("blocks", blocks).withColumn("blk", F.pmod(F.xxhash64("node", "h"), F.col("blocks")).cast("int"))
    minor = F.col("comp") != F.col("major")
    # block pairs are named once, by (lower, upper); a node meets all blocks, as one side or the other
    left = rows.filter(minor).select("h", "node", "comp", "blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), F.lit(True).alias("minor"))
    # a block is needed by the blocks that hold minor nodes, itself included
    where = rows.filter(minor).select("h", F.col("blk").alias("other")).distinct()
    right = rows.join(where, "h").select("h", "node", "comp", "blk", "other", F.lit(False).alias("minor"))
    # task (h, p, q): minor nodes of block p against all nodes of block q
    laid = left.select("h", F.col("blk").alias("p"), F.col("other").alias("q"), "node", "comp", "minor").unionByName(
        right.select("h", F.col("other").alias("p"), F.col("blk").alias("q"), "node", "comp", "minor"))
    laid = laid.join(payload, "node")

    def compare(part: pd.DataFrame, out: list) -> None:
        """Links of one task (h, p, q): its minor nodes against the other side, pairs with most matches
        first; pairs that earlier links have brought together are skipped."""
        side = part["minor"].to_numpy(bool)
        if side.all() or not side.any():
            return
        sig = np.frombuffer(b"".join(part["sig"]), np.uint32).reshape(len(part), SIGNATURE)
        names, comp = np.unique(part["comp"].to_numpy(), return_inverse=True)
        node, items = part["node"].to_numpy(), part["items"].to_numpy()
        at_a, at_b = np.flatnonzero(side), np.flatnonzero(~side)
        ia, ib = np.nonzero(comp[at_a][:, None] != comp[at_b][None, :])
        ia, ib = at_a[ia], at_b[ib]
        matches = np.zeros(len(ia), np.int64)
        for i, need in enumerate(least):
            cut = slice(i * BATCH, (i + 1) * BATCH)
            matches += (sig[ia, cut] == sig[ib, cut]).sum(1)
            go = matches >= need
            ia, ib, matches = ia[go], ib[go], matches[go]
        root = list(range(len(names)))

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        # a pair that also shares an earlier band is compared in that bucket, which holds both components too
        keys = np.stack([band_keys(x, rows_in_band) for x in sig]).view(np.int64)
        own = np.flatnonzero((keys == part["h"].iloc[0]).all(0))
        if len(own):
            first = ~(keys[ia, : own[0]] == keys[ib, : own[0]]).any(1)
            ia, ib, matches = ia[first], ib[first], matches[first]
        order = np.argsort(-matches, kind="stable")
        for x, y, ca, cb in zip(ia[order].tolist(), ib[order].tolist(), comp[ia[order]].tolist(), comp[ib[order]].tolist()):
            ra, rb = find(ca), find(cb)
            if ra != rb and similar(np.frombuffer(items[x], np.uint64), np.frombuffer(items[y], np.uint64), threshold):
                root[ra] = rb
                out.append((node[x], node[y]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows arrive sorted by (h, p, q); a task's rows are held until the next one begins
        held = None
        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            key = rows[["h", "p", "q"]].to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1)]
            out: list = []
            for lo, hi in zip(cuts, cuts[1:]):
                compare(rows.iloc[lo:hi], out)
            held = rows.iloc[cuts[-1]:]
            yield pd.DataFrame(out, columns=["a", "b"])
        if held is not None and len(held):
            out = []
            compare(held, out)
            yield pd.DataFrame(out, columns=["a", "b"])

    return (laid.repartition("h", "p", "q").sortWithinPartitions("h", "p", "q")
            .mapInPandas(run, "a binary, b binary").distinct())


def near_duplicates(docs: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, node, comp, component_id, kept) of every document row; ``comp`` names the class
    by one of its nodes (null without words)."""
    small_batches(docs.sparkSession)
    marks = cut_lineage(fingerprints(docs, k, threshold))
    nodes = (marks.filter("node is not null").groupBy("node")
             .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("bands").alias("bands")))
    banded = nodes.select("node", F.explode("bands").alias("h"))
    buckets = banded.groupBy("h").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = cut_lineage(banded.join(buckets, "h"))
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = members.join(weight, "node").groupBy("h").agg(F.max(F.struct("weight", "node")).alias("hub"))
    # v belongs to a row of the id rep (null if none has an id)
    light = marks.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.coalesce(F.min_by("v", "doc_id"), F.min("v")).alias("v"))
    payload = cut_lineage(_payload(docs, members.select("node").distinct().join(light, "node"), k))

    best = members.select("h", "node").join(hubs, "h").groupBy("node").agg(F.max("hub").alias("hub"))
    first = best.select(F.col("node").alias("a"), F.col("hub.node").alias("b")).filter("a <> b")
    roots = components(_verified(first, payload, threshold))

    label = members.join(roots, "node", "left").select("h", "node", F.coalesce("root", "node").alias("comp"))
    mixed = label.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("h")
    rest = cut_lineage(label.join(mixed, "h"))
    linked = cut_lineage(_links(rest, payload, threshold))
    comp = rest.select("node", "comp").distinct()
    bridges = (linked.join(comp.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a")
               .join(comp.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b")
               .select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    merged = components(bridges)

    final = (light.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node"))
             .join(merged.select(F.col("node").alias("comp"), F.col("root").alias("merged")), "comp", "left")
             .select("node", "rep", "copies", F.coalesce("merged", "comp").alias("comp")))
    low = final.groupBy("comp").agg(F.min("rep").alias("component_id"), F.sum("copies").alias("size"))
    # only classes of several documents need a look-up
    named = final.join(low.filter("size > 1"), "comp").select("node", "comp", "component_id")
    return (marks.select("doc_id", "n_shingles", "node").join(named, "node", "left")
            .select("doc_id", "n_shingles", "node", F.coalesce("comp", "node").alias("comp"),
                    F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents (all their columns) without near-duplicates: of each class the one with the smallest
    id stays.  Rows that share their id with another row are told apart by their texts; of those that
    are alike in both, one stays.  Documents without words link with nothing and stay."""
    marks = cut_lineage(near_duplicates(docs, k, threshold))
    gone = marks.filter(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    repeated = marks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.col("doc_id").alias("__twice"))
    once = docs.join(repeated, F.col("doc_id").eqNullSafe(F.col("__twice")), "left_anti")
    once = once.join(gone, F.col("doc_id").eqNullSafe(F.col("__gone")), "left_anti")
    # ids with several rows: a row stays if its set's class bears its id, once per class
    twice = docs.join(repeated, F.col("doc_id").eqNullSafe(F.col("__twice")), "left_semi")
    if not twice.isEmpty():
        own = docs.columns
        keyed = with_node(twice, k).withColumnRenamed("doc_id", "__id")
        kept = (marks.filter("kept").select("doc_id", "node", "comp").distinct()
                .select(F.col("doc_id").alias("__kid"), F.col("node").alias("__knode"), F.col("comp").alias("__comp")))
        rows = (keyed.join(kept, F.col("__id").eqNullSafe(F.col("__kid")) & F.col("__node").eqNullSafe(F.col("__knode")))
                .withColumnRenamed("__id", "doc_id"))
        words = rows.filter("__node is not null").dropDuplicates(["__comp"])
        once = once.unionByName(words.select(*own)).unionByName(rows.filter("__node is null").select(*own))
    return once


def with_node(docs: DataFrame, k: int) -> DataFrame:
    """``docs`` with column __node, the fingerprint of the shingle set (null without words)."""

    @F.pandas_udf("binary")
    def node(texts: pd.Series) -> pd.Series:
        sets = (shingle_set(w, k) for w in word_hashes(as_bytes(texts, lower=True)))
        return pd.Series([set_key(s) if len(s) else None for s in sets], dtype=object)

    return docs.withColumn("__node", node(F.col("text").cast("binary")))
