"""Mixing sources to target weights: iterative proportional fitting, with DataFrame functions only.

Documents fall into cells (source, language, topic); a cell's mass is its number of tokens (words).
Raking scales the cells to the target share of each source, then each language, then each topic, and
over again (``SWEEPS`` times).  The draw is a hash of (seed, doc_id).  There are two ways to sample:

* ``sample_mixed`` (and ``mix_sources``): the probability of a document is its cell's factor over the
  largest factor, so expected token shares follow the raked table, but the rarest cell sets how much
  of the corpus stays.
* ``sample_balanced`` (the pipeline's): the mass-weighted mean of the factors is 1, as raking keeps the
  whole mass, and a document stays with its cell's factor as probability.  Cells with factors above 1
  stay whole, once; the share of the target's tokens that they would need as repeats is logged
  (``unmet_share``).  A rare cell takes from the others no more than its own target.

Texts are read once to make one row of numbers per document; cells are summed map-side, so a hot source
is a few partial sums.  The raking runs on the cell table, written to the session's checkpoint folder
after each sweep; joins with it leave broadcasting to its measured size.

A topic is a bucket of the document's longest word (ties: the greatest one): the tables have no
topics of their own.  Any other column can be passed.

Defined cases: null source, language or topic is the category ``?``; null text counts as empty;
documents without tokens bear no mass and are kept; repeated rows share one draw; null ids draw as the
empty id; empty tables give empty results."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.llm.rules import words
from boxframe.llm.textkit import written

TOPICS = 8
SWEEPS = 6
#: Target shares are the present token shares to this power, made to sum to one.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.5}
SEED = "mix-1"


def topic_of(text: Column) -> Column:
    """Bucket (0 to TOPICS - 1) of the longest word; -1 without words."""
    longest = F.array_max(F.transform(words(text), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    return F.coalesce(F.pmod(F.conv(F.substring(F.md5(longest.cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(TOPICS)), F.lit(-1))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """Uniform number in [0, 1) from the id."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / 4294967296.0


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """(dim, goal): the token shares of ``dim`` to ``power``, scaled to the whole mass."""
    m = cells.groupBy(dim).agg(F.sum("mass").alias("m"))
    total = m.agg(F.sum("m").alias("t"), F.sum(F.pow("m", F.lit(power))).alias("p")).first()
    return m.select(dim, (F.pow("m", F.lit(power)) / F.lit(total.p or 1.0) * F.lit(float(total.t or 0))).alias("goal"))


def rake(cells: DataFrame, goals: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (dimensions, mass) with column w: masses scaled so that each dimension's sums meet
    its goals (the last one exactly, the others in the limit)."""
    w = cells.withColumn("w", F.col("mass").cast("double"))
    for _ in range(sweeps):
        for dim, goal in goals.items():
            now = w.groupBy(dim).agg(F.sum("w").alias("now")).join(goal, dim)
            w = w.join(now.select(dim, (F.col("goal") / F.col("now")).alias("f")), dim).withColumn("w", F.col("w") * F.col("f")).drop("f")
        w = written(w)
    return w


def marks(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens), one row per document row."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(c)
    return docs.select("doc_id", name("source"), name("lang"), topic_of(F.col("text")).cast("string").alias("topic"),
                       F.size(words(F.col("text"))).cast("bigint").alias("n_tokens"))


def cell_probabilities(rows: DataFrame, temper: dict[str, float] | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """(source, lang, topic, mass, factor, prob) of the cells of ``rows`` that have tokens."""
    temper = temper or TEMPER
    cells = written(rows.groupBy(*temper).agg(F.sum("n_tokens").alias("mass")).filter("mass > 0"))
    goals = {d: written(tempered(cells, d, p)) for d, p in temper.items()}
    raked = rake(cells, goals, sweeps).withColumn("factor", F.col("w") / F.col("mass"))
    top = raked.agg(F.max("factor")).first()[0] or 1.0
    return written(raked.select(*temper, "mass", "factor", (F.col("factor") / F.lit(top)).alias("prob")))


def mix_sources(docs: DataFrame, temper: dict[str, float] | None = None, sweeps: int = SWEEPS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, weight, prob, kept) of every document; ``weight`` is the
    document's tokens under the raked table."""
    temper = temper or TEMPER
    rows = written(marks(docs))
    cells = cell_probabilities(rows, temper, sweeps)
    prob = F.coalesce("prob", F.lit(1.0))
    return (rows.join(cells, list(temper), "left")
            .select("doc_id", "source", "lang", "topic", "n_tokens",
                    (F.col("n_tokens") * F.coalesce("factor", F.lit(1.0))).alias("weight"), prob.alias("prob"),
                    (draw(F.col("doc_id"), seed) < prob).alias("kept")))


def unmet_share(cells: DataFrame) -> float:
    """Share of the target's tokens that documents kept once do not give: factors above 1 ask for repeats."""
    r = cells.agg(F.sum(F.col("mass") * F.greatest(F.col("factor") - 1, F.lit(0.0))).alias("over"),
                  F.sum(F.col("mass") * F.col("factor")).alias("all")).first()
    return (r["over"] or 0.0) / (r["all"] or 1.0)


def _sampled(docs: DataFrame, cells: DataFrame, prob: Column, dims: list[str], seed: str) -> DataFrame:
    """The documents whose draw is under ``prob`` of their cell."""
    key = {"source": F.coalesce(F.col("source").cast("string"), F.lit("?")),
           "lang": F.coalesce(F.col("lang").cast("string"), F.lit("?")),
           "topic": topic_of(F.col("text")).cast("string")}
    own = docs.columns
    d = docs.withColumns({f"__mix_{c}": key[c] for c in dims})
    cells = cells.select(*(F.col(c).alias(f"__mix_{c}") for c in dims), prob.alias("__mix_prob"))
    return (d.join(cells, [f"__mix_{c}" for c in dims], "left")
            .filter(draw(F.col("doc_id"), seed) < F.coalesce("__mix_prob", F.lit(1.0))).select(*own))


def sample_mixed(docs: DataFrame, temper: dict[str, float] | None = None, sweeps: int = SWEEPS, seed: str = SEED) -> DataFrame:
    """The sampled documents with all their columns; ``mix_sources`` keeps the same ones."""
    temper = temper or TEMPER
    return _sampled(docs, cell_probabilities(marks(docs), temper, sweeps), F.col("prob"), list(temper), seed)


def sample_balanced(docs: DataFrame, temper: dict[str, float] | None = None, sweeps: int = SWEEPS, seed: str = SEED) -> DataFrame:
    """The documents with all their columns, sampled by min(1, factor), each once."""
    temper = temper or TEMPER
    cells = cell_probabilities(marks(docs), temper, sweeps)
    logging.getLogger(__name__).warning("mixing: %.2f %% of the target's tokens unmet, as no document is repeated", 100 * unmet_share(cells))
    return _sampled(docs, cells, F.least("factor", F.lit(1.0)), list(temper), seed)
