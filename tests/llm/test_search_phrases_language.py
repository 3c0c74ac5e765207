"""Ranked search and collocations against brute force, language identification by held-out accuracy; odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxframe.llm import langid, lexical, phrases
from tests.conftest import SF_SMALL
from tests.llm.conftest import rows_to_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- ranked search ------------------------------------------------------------------------------

def terms(text):
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_ranking(docs, items, top=10):
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n, total = len(held), sum(len(w) for _, w in held)
    df = Counter(w for _, ws in held for w in set(ws))
    out = []
    for item, text in items:
        scores = []
        for i, ws in held:
            tf, m = Counter(ws), 100 - 90 + (90 * len(ws) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10 ** 9 * tf[w]) // (1000 * tf[w] + 8 * m))
                    for w in set(terms(text)) if w in tf)
            if s > 0:
                scores.append((-s, i is not None, i if i is not None else 0))
        out += [(item, k + 1, i if known else None, -s) for k, (s, known, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def ranking(docs, items, **kw):
    out = lexical.rank_documents(docs, items, **kw)
    assert [t for _, t in out.dtypes] == ["bigint", "int", "bigint", "bigint"]
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in out.collect()), key=repr)


ITEM_SCHEMA = "item_id bigint, text string, doc_id bigint, score double, item int, rank int, row bigint"


def to_items(spark, items):
    return spark.createDataFrame([(i, t, 5, 1.0, 2, 3, 4) for i, t in items], ITEM_SCHEMA)


def test_ranking_equals_brute_force_on_odd_rows(spark, odd_docs, odd_rows):
    texts = [t for _, t, _, _ in odd_rows]
    items = [(1, texts[0]), (2, None), (3, ""), (4, "ONE"), (5, "word that is nowhere ..."), (6, texts[3][:90] + " one"), (6, texts[3][:90] + " one"),
             (7, "é 日本 ½ one"), (None, texts[5]), (9, texts[-3][:3000]), (10, "a b c d e f g h")]
    got = ranking(odd_docs, to_items(spark, items))
    assert got == brute_ranking([(i, t) for i, t, _, _ in odd_rows], items)


def test_ranking_with_small_tiles_blocks_and_item_blocks(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 4))) for _ in range(150)]
    docs = [(k, " ".join(rng.choice(words[: rng.randrange(2, 150)]) for _ in range(rng.randrange(1, 60)))) for k in range(400)]
    docs += [(1000 + k, docs[k][1]) for k in range(50)]
    items = [(k, " ".join(rng.sample(words, rng.randrange(1, 12)))) for k in range(40)]
    monkeypatch.setattr(lexical, "CELLS", 1 << 13)
    monkeypatch.setattr(lexical, "ITEM_ROWS", 15)
    monkeypatch.setattr(lexical, "PROBE", 12)
    frame = rows_to_docs(spark, [(i, t, "en", "s") for i, t in docs])
    assert ranking(frame, to_items(spark, items)) == brute_ranking(docs, items)
    assert ranking(frame, to_items(spark, items), top=3) == brute_ranking(docs, items, 3)


def test_summaries_bound_their_blocks_and_blocks_are_skipped():
    rng = np.random.default_rng(0)
    part = np.where(rng.random((300, 40)) < 0.2, rng.integers(1, 10 ** 6, (300, 40)), 0).astype(np.float32)
    part[:150, :20] = 0
    part[150:, 20:] = 0
    turn, cuts = lexical.blocks(part)
    assert sorted(turn.tolist()) == list(range(300)) and np.diff(np.append(cuts, 300)).max() <= lexical.MAX_BLOCK
    summary = np.maximum.reduceat(part[turn], cuts, axis=0)
    for k, (lo, hi) in enumerate(zip(cuts, [*cuts[1:], 300])):
        assert (summary[k] == part[turn[lo:hi]].max(axis=0)).all()
    w = np.r_[np.ones(20), np.zeros(20)]
    scores, bounds = part[turn] @ w, summary @ w
    floor = np.sort(scores)[-10]
    assert (bounds < floor).sum() >= 3  # halves are told apart


def test_ranking_of_empty_tables(spark, odd_docs, no_docs):
    none = to_items(spark, [(1, "one")]).filter("false")
    assert ranking(no_docs, to_items(spark, [(1, "one")])) == [] and ranking(odd_docs, none) == []


# --- collocations -------------------------------------------------------------------------------

def brute_phrases(rows, min_count, top=2000):
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = [w for w in re.split("[\x20\x09]+", piece) if w]
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        n, rows_ = sum(v for p, v in c.items() if len(p) == 1), []
        often = {p: v for p, v in c.items() if len(p) > 1 and v >= min_count}
        for p, a in often.items():
            if len(p) == 2 and any(q[:2] == p or q[1:] == p for q, b in often.items() if len(q) == 3 and 100 * b >= 50 * a):
                continue
            s, _, left, right = min((10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows_.append((-s, -a, " ".join(p).encode(), left, right))
        out += [(lang, k + 1, p.decode(), -a, left, right, n, -s) for k, (s, a, p, left, right) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def found_phrases(docs, **kw):
    out = phrases.collocations(docs, **kw)
    assert [t for _, t in out.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    return sorted(tuple(r) for r in out.collect())


def test_phrases_equal_brute_force_on_odd_rows(spark, odd_docs, odd_rows):
    rows = [(t, lang) for _, t, lang, _ in odd_rows]
    want = brute_phrases(rows, 2)
    assert len(want) > 300 and found_phrases(odd_docs, min_count=2) == want
    assert found_phrases(odd_docs, min_count=2, top=7) == brute_phrases(rows, 2, 7)


def test_phrases_with_few_cells_pieces_and_separators(spark, monkeypatch):
    """All pairs share cells, texts are cut into short segments, a word is longer than a segment."""
    rng = random.Random(8)
    words = ["a", "B", "é", "x y", "z" * 300, "c\x00d"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "\t ", ".", "\n", " ; ", "\x0b"]) for _ in range(rng.randrange(1, 200))) for _ in range(60)]
    rows = [(t, rng.choice(["en", None, "und"])) for t in texts] + [(texts[0], "en")] * 30
    monkeypatch.setattr(phrases, "SEGMENT", 256)
    monkeypatch.setattr(phrases, "FLUSH", 64)
    monkeypatch.setattr(phrases, "GROUP", 700)
    frame = rows_to_docs(spark, [(k, t, lang, "s") for k, (t, lang) in enumerate(rows)])
    assert found_phrases(frame) == brute_phrases(rows, 10)


def test_phrase_scores_pass_64_bits(spark):
    big = spark.createDataFrame([(3_000_000_000, 4_000_000_000, 3_000_000_001)], "a bigint, l bigint, r bigint")
    got = big.select(phrases._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).first().s
    assert got == 10 ** 6 * 3_000_000_000 ** 2 // (4_000_000_000 * 3_000_000_001)


def test_phrases_of_an_empty_table(no_docs):
    assert found_phrases(no_docs) == []


# --- language identification --------------------------------------------------------------------

def languages(docs, **kw):
    out = langid.predict_languages(docs, **kw)
    assert [t for _, t in out.dtypes] == ["bigint", "boolean", "string", "double"]
    return out.collect()


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = languages(docs)
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    right = [r.lang_pred == truth[r.doc_id] for r in held]
    assert np.mean(right) >= 0.95
    assert abs(np.mean([r.score for r in held]) - np.mean(right)) < 0.1  # calibrated


def test_held_out_labels_are_never_read(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    wrong = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    key = lambda rows: sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in rows)
    assert key(languages(docs)) == key(languages(wrong))


def test_ngram_counts_by_brute_force():
    text = "Éa1b  ÉA​日本"
    want = re.sub(r"[\W\d_]+", " ", text.lower())
    grams = Counter(want[i:i + n] for n in (1, 2, 3) for i in range(len(want) - n + 1))
    dims, tf = langid.counts(text)
    assert tf.sum() == sum(grams.values()) and sorted(tf) == sorted(grams.values())
    assert len(langid.counts("12 ++ ​")[0]) == 0


def test_long_texts_lose_no_ngram(monkeypatch):
    text = "abcdefghij klmnop" * 5
    whole = set(langid.counts(text)[0])
    monkeypatch.setattr(langid, "PIECE", 8)
    assert set(langid.counts(text)[0]) == whole


def test_languages_on_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = languages(odd_docs)
    assert len(rows) == len(odd_rows)
    for r in rows:
        if r.doc_id in (300, 301, 302):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is None:
            assert r.held_out
        else:
            assert r.lang_pred in ("en", "fr", "de")
    assert languages(no_docs) == []
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in languages(unlabelled)} == {("und", 0.0)}


def test_descent_learns_and_temperature_calibrates():
    rng = np.random.default_rng(1)
    idf = np.ones(50)
    rows = []
    for k in range(400):
        y = k % 2
        dims = np.unique(np.r_[rng.integers(0, 20, 4) + 20 * y, rng.integers(40, 50, 3)]).astype(np.int32)
        rows.append((["p", "q"][y], dims, np.ones(len(dims))))
    w, b = langid.follow_leader(lambda: iter(rows), ["p", "q"], idf)
    assert (w[:20, 0] > 0).all() and (w[20:40, 1] > 0).all()
    logits = np.array([langid.unit(d, t, idf) @ w[d] + b for _, d, t in rows])
    truth = np.array([k % 2 for k in range(400)])
    assert (logits.argmax(1) == truth).mean() == 1.0
    noisy = truth.copy()
    noisy[::5] = 1 - noisy[::5]
    t = langid.fit_temperature(logits * 10, noisy)
    assert abs(langid.softmax(logits * 10 / t).max(1).mean() - 0.8) < 0.05


@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_collocations"])
def test_queries_equal_their_sql(spark, duck, name):
    from boxframe.llm import queries
    got = queries.QUERIES[name](spark, SF_SMALL)
    want = duck.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in want.description]
    assert set(cols) == set(got.columns)
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(want.fetchall())
