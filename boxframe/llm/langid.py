"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Letters are lower-cased, every run of other characters becomes one space, and n-grams of one to ``MAX_N`` characters
are hashed into ``DIMS`` dimensions.  A document's vector is term frequency times inverse document frequency, scaled
to length one.  Weights are learned by follow-the-regularised-leader with L1 and L2 penalties (proximal, one
document at a time), so most stay exactly zero; then one temperature is fitted to learnable documents that
were kept out of the descent, and the score is the calibrated probability of the predicted language.

Document frequencies cover all learnable documents (text, a language, and crc32(doc_id) mod 3 other than 1).
Weights come from at most ``MAX_TRAIN`` of them, ``MAX_PER_LANG`` of a language at most, chosen by a hash of the id
and the text and read one partition at a time.  All documents are scored in one narrow pass; tasks hold the rows of
weights that are not zero.

Defined cases: a text that is null or has no letter is 'und' with score 0, as are all texts if nothing can be
learned; with one language only every other text gets it; null ids count as held out; documents with a null lang
are scored and never learned from; repeated rows get equal results and weigh as often as they occur; ties go to the
language that sorts first; long texts are read in pieces of ``PIECE`` characters; an empty table gives no rows;
other columns, whatever their names, are never read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxframe.llm.textkit import mix, small_batches, written

#: Learnable documents that the weights come from.
MAX_TRAIN = 8000
MAX_PER_LANG = 2000
DIMS = 1 << 17
MAX_N = 3
PIECE = 1 << 20
#: Descent: step size, its damping, penalties, passes.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 0.01, 3
#: Every so-many-th chosen document fits the temperature instead of the weights.
CALIBRATE = 5
UNKNOWN = "und"
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Table of all code points: is it a letter (made once per worker)."""
    if not _letters:
        _letters.append(np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000))
    return _letters[0]


def _ngrams(points: np.ndarray) -> Iterator[np.ndarray]:
    """Dimensions of the n-grams of each order, one for every start."""
    h = points.astype(np.uint64)
    key = h
    for n in range(1, MAX_N + 1):
        if n > 1:
            if len(h) < n:
                return
            key = key[:-1] * _STEP + h[n - 1:] + _U(1)
        yield (mix(key + _U(n)) >> _U(64 - (DIMS - 1).bit_length())).astype(np.int32)


def pieces(text: str) -> Iterator[np.ndarray]:
    """Code points of a text in pieces: lower-case letters, one space for all between them; pieces share
    ``MAX_N`` - 1 characters, so no n-gram is lost, and those inside the shared part count twice.  Nothing for a
    text without letters."""
    letter = _is_letter()
    for at in range(0, len(text), PIECE):
        part = text[max(0, at - MAX_N + 1): at + PIECE].lower()
        p = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        ok = letter[p]
        if not ok.any():
            continue
        p = np.where(ok, p, 0x20)
        keep = ok.copy()
        keep[0] = True
        keep[1:] |= ok[:-1]
        yield p[keep]


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(dimensions, frequencies) of a text's n-grams; empty without letters."""
    total = None
    for p in pieces(text or ""):
        for dims in _ngrams(p):
            n = np.bincount(dims, minlength=DIMS)
            total = n if total is None else total + n
    if total is None:
        return np.zeros(0, np.int32), np.zeros(0)
    dims = np.flatnonzero(total)
    return dims.astype(np.int32), total[dims].astype(float)


def unit(dims: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Vector of a document at its dimensions."""
    x = tf * idf[dims]
    return x / np.sqrt(x @ x)


def learnable(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(documents with a letter, documents holding each dimension) over all learnable documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIMS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen = np.zeros(DIMS, bool)
                for p in pieces(text):
                    for dims in _ngrams(p):
                        seen[dims] = True
                df[:-1] += seen
                df[-1] += seen.any()
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["dim", "df"])

    df = np.zeros(DIMS + 1, np.int64)
    for r in learnable(docs).select("text").mapInArrow(count, "dim int, df bigint").groupBy("dim").agg(F.sum("df").alias("df")).collect():
        df[r.dim] = r.df
    return int(df[-1]), df[:-1]


def training_rows(docs: DataFrame, max_train: int, per_lang: int) -> DataFrame:
    """(lang, x) of the chosen documents in a fixed random order; ``x`` holds their dimensions and frequencies."""
    order = [F.xxhash64("doc_id", "text"), F.col("doc_id"), F.col("text")]
    short = learnable(docs).select("doc_id", F.col("lang"), F.xxhash64("text").alias("text"))
    ranked = short.withColumn("part", F.pmod(F.xxhash64("text", "doc_id"), F.lit(64)))  # no task ranks a whole language
    for by in (["lang", "part"], ["lang"]):
        ranked = ranked.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("k") <= per_lang)
    chosen = ranked.orderBy(*order, "lang").limit(max_train).select("doc_id", "lang", "text").distinct()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [counts(t) for t in b["text"]]
            out = pd.DataFrame({"lang": b["lang"], "turn": b["turn"], "dims": [d.tobytes() for d, _ in found],
                                "tf": [v.astype(np.float32).tobytes() for _, v in found]})
            yield out[out["dims"].str.len() > 0]

    rows = learnable(docs).select("doc_id", "lang", "text").join(
        F.broadcast(chosen.withColumnRenamed("text", "code")),  # at most max_train rows of three numbers
        ["doc_id", "lang"]).filter(F.xxhash64("text") == F.col("code"))
    return (written(rows.select("lang", "text", F.xxhash64("code", "doc_id").alias("turn")).mapInPandas(
        read, "lang string, turn bigint, dims binary, tf binary")))


class Model:
    """Weights of the dimensions that have any, one column a language."""

    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, idf: np.ndarray, temperature: float = 1.0):
        rows = np.flatnonzero((weights != 0).any(axis=1))
        self.langs, self.bias, self.idf, self.temperature = langs, bias, idf, temperature
        self.place = np.zeros(len(weights), np.int32)  # 0: no weights
        self.place[rows] = np.arange(1, len(rows) + 1)
        self.table = np.zeros((len(rows) + 1, len(langs)))
        self.table[1:] = weights[rows]

    def logits(self, text: str | None) -> np.ndarray | None:
        """Log odds of each language, None without letters."""
        dims, tf = counts(text)
        return unit(dims, tf, self.idf) @ self.table[self.place[dims]] + self.bias if len(dims) else None


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_leader(rows, langs: list[str], idf: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) after ``epochs`` passes of FTRL-proximal over ``rows()`` of (language, dims, tf)."""
    place = {x: k for k, x in enumerate(langs)}
    shape = (len(idf) + 1, len(langs))  # the last row is the bias, without penalties
    z, g2 = np.zeros(shape), np.zeros(shape)
    l1 = np.full((shape[0], 1), L1)
    l2 = np.full((shape[0], 1), L2)
    l1[-1] = l2[-1] = 0.0

    def weights(at):
        out = -(z[at] - np.sign(z[at]) * l1[at]) / ((BETA + np.sqrt(g2[at])) / ALPHA + l2[at])
        return np.where(np.abs(z[at]) <= l1[at], 0.0, out)

    for _ in range(epochs):
        for lang, dims, tf in rows():
            at = np.append(dims, shape[0] - 1)
            x = np.append(unit(dims, tf, idf), 1.0)
            w = weights(at)
            g = softmax(x @ w)
            g[place[lang]] -= 1.0
            grad = x[:, None] * g
            sigma = (np.sqrt(g2[at] + grad * grad) - np.sqrt(g2[at])) / ALPHA
            z[at] += grad - sigma * w
            g2[at] += grad * grad
    full = weights(np.arange(shape[0]))
    return full[:-1], full[-1]


def fit_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """Temperature with the least log loss, from a fixed grid (1 without rows)."""
    if not len(truth):
        return 1.0
    grid = 2.0 ** np.arange(-6, 6.01, 0.125)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit_languages(docs: DataFrame, max_train: int = MAX_TRAIN, per_lang: int = MAX_PER_LANG) -> Model | None:
    """Model learned from the learnable documents, None without any."""
    sample = training_rows(docs, max_train, per_lang)
    langs = sorted(r.lang for r in sample.select("lang").distinct().collect())
    if not langs:
        return None
    n, df = document_frequencies(docs)
    idf = np.log((1 + n) / (1 + df)) + 1
    ordered = sample.repartitionByRange(16, "turn").sortWithinPartitions("turn", "lang", "dims")
    ordered = written(ordered)

    def rows(calibrate: bool):
        # one partition at a time; a turn is a hash, so languages are mixed
        for r in ordered.orderBy("turn", "lang", "dims").toLocalIterator():
            if (r.turn % CALIBRATE == 0) == calibrate:
                yield r.lang, np.frombuffer(r.dims, np.int32), np.frombuffer(r.tf, np.float32)

    weights, bias = follow_leader(lambda: rows(False), langs, idf)
    logits, truth = [], []
    for lang, dims, tf in rows(True):
        logits.append(unit(dims, tf, idf) @ weights[dims] + bias)
        truth.append(langs.index(lang))
    return Model(langs, weights, bias, idf, fit_temperature(np.array(logits).reshape(-1, len(langs)), np.array(truth, int)))


def predict_languages(docs: DataFrame, max_train: int = MAX_TRAIN, per_lang: int = MAX_PER_LANG) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    model = fit_languages(docs, max_train, per_lang)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            names, scores = [], []
            for t in texts:
                z = m.logits(t) if m is not None else None
                p = softmax(z / m.temperature) if z is not None else None
                names.append(UNKNOWN if p is None else m.langs[int(p.argmax())])
                scores.append(0.0 if p is None else float(p.max()))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))
    return (docs.select("doc_id", held.alias("held_out"), predict("text").alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))
