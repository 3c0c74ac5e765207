"""Quality rules: hashed n-gram log-likelihood ratio, with DataFrame functions only.

Words and word pairs of a text are hashed into buckets, whose number follows the corpus (``n_buckets``).
Two multinomials over the buckets are counted: the trusted target (every document labelled good) and the
raw corpus (all documents).  A text's score is the sum of log(target / raw) over its n-grams, divided by
their number.  The cut is learned from all labelled rows through a histogram of scores (``BINS`` cells
per label): the cell border with the best balanced accuracy.  Every document then gets a verdict; nothing
is random.

The texts are read once for their size, once for the counts per bucket and once for the scores, which are
summed per document from a join with the table of ratios.  Ids of good documents and ratios are broadcast
where they fit (``SMALL_IDS``, ``SMALL_TABLE``), so no text is shuffled; beyond that, bucket numbers of the
documents with an id are shuffled for the target, and n-grams with one row of numbers for the score.  The
driver sees sums and the histogram.

Defined cases: null text counts as empty; texts without n-grams score 0 (and fail the base rule);
repeated rows get equal results; null ids are scored but have no label; without labels of both kinds
the cut is minus infinity, so only the base rules decide."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.llm.textkit import written
from boxframe.session import cut_lineage

#: Least number of buckets, and the buckets for the square root of the bytes of text beyond it: distinct
#: n-grams grow with a power of the corpus (Heaps' law).
BUCKETS = 1 << 15
PER_ROOT_BYTE = 16
#: Good ids and buckets up to which the table is broadcast (a few hundred MB as a hash table).
SMALL_IDS = 2_000_000
SMALL_TABLE = 1 << 22
BINS = 200
#: Scores outside +-SPAN share the outermost cells.
SPAN = 2.0
SPACE = "[\\x20\\x09-\\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_buckets(docs: DataFrame) -> int:
    """Number of buckets for these texts: a power of two, without an upper bound."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    want = PER_ROOT_BYTE * math.isqrt(size)
    return max(BUCKETS, 1 << max(0, want - 1).bit_length())


def _grams(buckets: int = BUCKETS) -> Column:
    """Buckets of the words and word pairs of column ``words``."""
    return F.expr(
        f"concat(transform(words, w -> pmod(xxhash64(w), {buckets}L)),"
        f" slice(transform(words, (w, i) -> pmod(xxhash64(w, get(words, i + 1)), {buckets}L)),"
        " 1, greatest(size(words) - 1, 0)))")


def base_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every document.

    Repeated three-word windows are found by sorting (window hash, position) inside the row; the words
    they cover are counted from the gaps between the sorted positions."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", text.alias("text")).withColumn("words", words(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(_BLANKS)) != "")
    d = (d.withColumn("lines", lines)
         .withColumn("wins", F.expr(
             "array_sort(slice(transform(words, (w, i) -> struct(xxhash64(w, get(words, i + 1), get(words, i + 2)) as h, i as p)),"
             " 1, greatest(size(words) - 2, 0)))")))
    again = F.expr("filter(wins, (x, i) -> (i > 0 and get(wins, i - 1).h = x.h) or get(wins, i + 1).h = x.h)")
    d = d.withColumn("at", F.array_sort(F.transform(again, lambda x: x["p"])))
    return d.select(
        "doc_id", "words", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr("aggregate(transform(at, (p, i) -> least(3, coalesce(get(at, i + 1), p + 3) - p)), 0L, (a, x) -> a + x)")
        .alias("n_repeat_words"))


def target_ids(labels: DataFrame, max_target: int | None = None) -> DataFrame:
    """Ids of the documents whose labels all say good; of at most ``max_target`` by a hash of the id, if given."""
    good = labels.select("doc_id", "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1")
    if max_target is not None:
        good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_target)
    return good.select("doc_id")


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """(g, ratio): log(target / raw) of each bucket of the corpus, both smoothed by one count."""
    good = written(target_ids(labels))
    grams = docs.select("doc_id", words(F.col("text")).alias("words")).withColumn("g", _grams(buckets)).drop("words")
    one, raw, target = F.lit(1), F.count(F.lit(1)).alias("raw"), F.count("t").alias("target")
    if good.count() <= SMALL_IDS:
        marked = grams.join(F.broadcast(good.withColumn("t", one)), "doc_id", "left")
        counts = marked.select("t", F.explode_outer("g").alias("g")).groupBy("g").agg(raw, target)  # outer: no filter that repeats the array
    else:  # documents without a label stay where they are
        everywhere = grams.select(F.explode_outer("g").alias("g")).groupBy("g").agg(raw, F.lit(0).cast("bigint").alias("target"))
        trusted = (grams.join(good, "doc_id").select(F.explode_outer("g").alias("g")).groupBy("g")
                   .agg(F.lit(0).cast("bigint").alias("raw"), F.count(one).alias("target")))
        counts = everywhere.unionByName(trusted).groupBy("g").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    counts = written(counts.filter("g is not null"))  # null: texts without words
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    a, b = float((total.target or 0) + buckets), float((total.raw or 0) + buckets)
    return counts.select("g", (F.log((F.col("target") + 1) / F.lit(a)) - F.log((F.col("raw") + 1) / F.lit(b))).alias("ratio"))


def _cut(scored: DataFrame, labels: DataFrame) -> float:
    """Score under which documents are rejected."""
    cell = F.floor((F.greatest(F.least(F.col("score"), F.lit(SPAN)), F.lit(-SPAN)) + SPAN) * (BINS / (2 * SPAN)))
    truth = (labels.select("doc_id", "quality").dropna().groupBy("doc_id")
             .agg(F.min("quality").alias("q"), F.max("quality").alias("q2")).filter("q = q2 and q in (0, 1)"))
    rows = (scored.select("doc_id", cell.cast("int").alias("cell")).join(truth, "doc_id")
            .groupBy("cell", "q").count().collect())
    n = {q: sum(r["count"] for r in rows if r.q == q) for q in (0, 1)}
    if not n[0] or not n[1]:
        return -math.inf
    best, at, bad, good = -1.0, [], 0, 0
    hist = {(r.cell, r.q): r["count"] for r in rows}
    for c in range(BINS + 2):  # rejecting the cells under c
        gain = bad / n[0] - good / n[1]
        if gain > best + 1e-12:
            best, at = gain, []
        if abs(gain - best) <= 1e-12:
            at.append(c)
        bad += hist.get((c, 0), 0)
        good += hist.get((c, 1), 0)
    return at[0] * (2 * SPAN / BINS) - SPAN


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, the base columns, base_failed, kept, score) of every document."""
    buckets = n_buckets(docs)
    ratios = log_ratios(docs, labels, buckets)
    ratios = F.broadcast(ratios) if buckets <= SMALL_TABLE else ratios
    # ids may repeat or be null: rows are told apart by their place in the input
    rows = base_rules(docs).withColumn("g", _grams(buckets)).drop("words").withColumn("row", F.monotonically_increasing_id())
    own = [c for c in rows.columns if c not in ("g", "row")]
    scored = cut_lineage(rows.select("row", *own, F.explode_outer("g").alias("g")).join(ratios, "g", "left").groupBy("row", *own)
                         .agg((F.coalesce(F.sum("ratio"), F.lit(0.0)) / F.greatest(F.count("g"), F.lit(1))).alias("score")).drop("row"))
    cut = _cut(scored, labels)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (scored.withColumn("base_failed", failed)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("score") >= cut)).alias("kept"), "score"))
