"""The operators against brute force, on odd rows and on the small tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from boxframe.llm import (chat, decontam, mixing, neardup, pagetext, quality, queries, rangecoder, rules, tokencount,
                          tokenids, toxicity)
from boxframe.llm.textkit import load
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, k):
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else (frozenset({tuple(w)}) if w else frozenset())


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


# --- 1 quality classifier

def test_quality_learns_only_from_rows_not_held_out(spark):
    d = queries.op1_quality_classifier(spark, "/root/testdata/sf0.01").join(load(spark, "/root/testdata/sf0.01", "labels"), "doc_id").collect()
    held = [r for r in d if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in d)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in d)
    assert quality.training_rows(labels_of(spark, [(i, 1, 0) for i in range(300)]), max_train=20).count() == 20


def test_quality_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = labels_of(spark, [(i, i % 2, 0) for i in range(12)] + [(3, 0, 0), (3, 1, 0), (None, 1, 0), (5, None, 0)])
    got = quality.score_quality(odd_docs, labels).collect()
    assert len(got) == len(odd_rows) and all(r.score is not None for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True, True]
    assert len({r.score for r in got if r.doc_id == 305}) == 1
    assert quality.score_quality(no_docs, labels).count() == 0
    none = quality.score_quality(odd_docs, labels_of(spark, []))
    assert none.filter("predicted = 0").count() == 0
    assert quality.keep_good(odd_docs, labels_of(spark, [])).columns == odd_docs.columns


# --- 2 quality rules

def base_columns(text):
    text = text or ""
    w = WORD.findall(text)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {p for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_rules_base_columns(spark, odd_docs, odd_rows, no_docs):
    extra = [(400, "a a a a b", "en", "s"), (401, "x y z\nx y z\n\nq", "en", "s"), (402, "#a |b <c>\n" * 40, "en", "s")]
    from tests.llm.conftest import rows_to_docs
    docs = odd_docs.unionByName(rows_to_docs(spark, extra))
    labels = labels_of(spark, [(i, 1, 0) for i in range(6)] + [(402, 0, 0), (100, 0, 0)])
    got = rules.apply_rules(docs, labels).collect()
    text = collections.defaultdict(list)
    for i, t, *_ in odd_rows + extra:
        text[i].append(base_columns(t))
    have = collections.defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed))
        assert not (r.base_failed and r.kept)
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in text.items()}
    assert rules.apply_rules(no_docs, labels).count() == 0
    assert rules.apply_rules(docs, labels_of(spark, [])).filter("kept = base_failed").count() == 0


def test_rules_score_is_the_ratio_of_counts(spark):
    docs, labels = load(spark, SF_SMALL, "documents"), load(spark, SF_SMALL, "labels")
    grams = docs.select("doc_id", rules.words(F.col("text")).alias("words")).withColumn("g", rules._grams()).select("doc_id", "g").collect()
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    raw, target = np.ones(rules.BUCKETS), np.ones(rules.BUCKETS)
    for r in grams:
        np.add.at(raw, r.g, 1)
        if r.doc_id in good:
            np.add.at(target, r.g, 1)
    table = np.log(target / target.sum()) - np.log(raw / raw.sum())
    got = {r.doc_id: r for r in rules.apply_rules(docs, labels).collect()}
    for r in grams:
        assert got[r.doc_id].score == pytest.approx(table[r.g].sum() / max(1, len(r.g)), abs=1e-9)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    both = [(got[i].kept, q) for i, q in truth.items() if not got[i].base_failed]
    assert np.mean([k == bool(q) for k, q in both]) > 0.9


def test_rules_plan_has_no_python(spark):
    docs, labels = load(spark, SF_SMALL, "documents"), load(spark, SF_SMALL, "labels")
    for df in (rules.base_rules(docs), mixing.marks(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    assert rules.target_ids(labels, 7).count() == 7


def test_rules_count_every_good_document(spark, monkeypatch):
    """No size limit on the target, buckets that follow the corpus, and the same scores without broadcasts."""
    many = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert rules.target_ids(many).count() == 60_000
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(2000)), lambda i: F.md5(i.cast("string"))))
    assert [rules.n_buckets(spark.range(n).select(text.alias("text"))) for n in (0, 1, 100, 10_000)] == [1 << 15, 1 << 15, 1 << 16, 1 << 19]
    docs, labels = load(spark, SF_SMALL, "documents"), load(spark, SF_SMALL, "labels")
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("bigint")))
    rows = lambda: sorted((str(r.doc_id), r.n_words, r.kept, round(r.score, 9)) for r in rules.apply_rules(docs, labels).collect())
    want = rows()
    assert len(want) == docs.count()
    monkeypatch.setattr(rules, "SMALL_IDS", 0)
    monkeypatch.setattr(rules, "SMALL_TABLE", 0)
    assert rows() == want


# --- 3 token ids, 4 token counts

def id_stream(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORD_BPE)
    out, at = collections.defaultdict(list), 0
    for i, text in sorted(((i, x or "") for i, x in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], "<u4")
        out[i].append((at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out, at


def test_token_ids_read_back(spark):
    rows = [(r.doc_id, r.text) for r in load(spark, SF_SMALL, "documents").collect()]
    want, _ = id_stream(rows)
    got = {r.doc_id: [(r.start, r.n_tokens, r.ids_crc32)] for r in queries.op3_token_ids(spark, SF_SMALL).collect()}
    assert got == want


def test_token_ids_odd_rows(spark, odd_docs, odd_rows, no_docs, monkeypatch):
    got = tokenids.document_ids(odd_docs, WORD_BPE).collect()
    want, total = id_stream([(r[0], r[1]) for r in odd_rows])
    assert len(got) == len(odd_rows) and sum(r.n_tokens for r in got) == total
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in by.items()} == {k: sorted(x[1:] for x in v) for k, v in want.items()}
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)  # no gap and no overlap, in id order
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert tokenids.document_ids(no_docs, WORD_BPE).count() == 0


def test_token_counts_equal_the_library(spark, odd_docs, odd_rows, no_docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE_BPE)
    import random
    rng = random.Random(3)
    letters = list(" \n\t'strevlmdaE1.!é ß日 ")
    texts = ["", "  ", "don't we'll 've 'r' 'l 'lx I'm' ''s", "a  b\n\n c \n d\t\te ", "x<|endoftext|>y <|endoftext|>", "'", "'re's", "½ ² Ⅷ"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    want = [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
    assert tokencount.count_texts(texts, BYTE_BPE) == want
    got = tokencount.token_counts(odd_docs, BYTE_BPE).collect()
    expect = sorted((len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for _, x, *_ in odd_rows)
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == expect and all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert tokencount.token_counts(no_docs, BYTE_BPE).count() == 0


def test_token_counts_of_pieces_and_full_tables(monkeypatch):
    from boxframe.llm import transducer
    monkeypatch.setattr(tokencount, "PIECE", 50)
    text = "some words  and\n\n more <|endoftext|> don't 12 " * 30
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE_BPE)
    want = len(t.encode(text, add_special_tokens=False).ids)
    assert tokencount.count_texts([text], BYTE_BPE) == [want]
    monkeypatch.setattr(transducer, "MAX_STATES", 40)
    monkeypatch.setattr(transducer, "MAX_WORDS", 5)
    assert tokencount.count_texts([text, "z" * 500], BYTE_BPE) == [want, len(t.encode("z" * 500, add_special_tokens=False).ids)]


# --- 5 mixing

def test_mixing_meets_targets(spark, odd_docs, odd_rows, no_docs):
    rows = mixing.mix_sources(load(spark, "/root/testdata/sf0.01", "documents"), sweeps=12).collect()
    total = sum(r.n_tokens for r in rows)
    for dim, power in mixing.TEMPER.items():
        mass, got = collections.Counter(), collections.Counter()
        for r in rows:
            mass[r[dim]] += r.n_tokens
            got[r[dim]] += r.weight
        scale = sum(m ** power for m in mass.values())
        for k, m in mass.items():
            assert got[k] == pytest.approx(total * m ** power / scale, rel=2e-2)
    assert all(0 < r.prob <= 1 for r in rows) and max(r.prob for r in rows) == pytest.approx(1)
    got = mixing.mix_sources(odd_docs).collect()
    assert len(got) == len(odd_rows) and {r.source for r in got} == {"s0", "s1", "s2", "?"}
    assert all(r.kept for r in got if not r.n_tokens)
    kept = sorted((str(r.doc_id), r.n_tokens) for r in got if r.kept)
    sample = mixing.sample_mixed(odd_docs)
    assert sample.columns == odd_docs.columns and sorted((str(r.doc_id), len(WORD.findall(r.text or ""))) for r in sample.collect()) == kept
    assert mixing.mix_sources(no_docs).count() == 0 and mixing.sample_mixed(no_docs).count() == 0


def test_mixing_matches_its_sql(spark, duck):
    got = [tuple(r) for r in queries.op5_mixing(spark, SF_SMALL).select("doc_id", "weight", "prob", "kept").orderBy("doc_id").collect()]
    want = duck.execute(f"SELECT doc_id, weight, prob, kept FROM ({queries.ORACLE_SQL['op5_mixing']}) ORDER BY doc_id").fetchall()
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0] and g[3] == w[3] and g[1:3] == pytest.approx(w[1:3])


def test_pipeline_mixing_stands_one_odd_source(spark):
    """One row of a null source does not thin out the others."""
    import corpus_pipeline
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    odd = spark.createDataFrame([(-1, "odd " * 20, "en", None, 80)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    plain, mixed = ([r.doc_id for r in corpus_pipeline.mixing_stage(spark, d, "").collect()] for d in (docs, docs.unionByName(odd.select(*docs.columns))))
    assert -1 in mixed and len(set(mixed)) == len(mixed)
    assert len(plain) > 0.6 * docs.count() and len(mixed) > 0.95 * len(plain)
    cells = mixing.cell_probabilities(mixing.marks(docs)).collect()
    want = sum(r.mass * max(0, r.factor - 1) for r in cells) / sum(r.mass for r in cells)
    assert 0 < want < 0.4 and mixing.unmet_share(mixing.cell_probabilities(mixing.marks(docs))) == pytest.approx(want)


# --- 6 decontamination

def test_decontamination_brute_force(spark, odd_docs, odd_rows, no_docs):
    docs, items = load(spark, "/root/testdata/sf0.01", "documents"), load(spark, "/root/testdata/sf0.01", "benchmark")
    got = {(r.doc_id, r.item_id, r.n_found) for r in decontam.contained_items(docs, items).collect()}
    want = set()
    parts = [(r.item_id, shingle_set(r.text, 5)) for r in items.collect()]
    for r in docs.collect():
        s = shingle_set(r.text, 5)
        want |= {(r.doc_id, i, len(s & p)) for i, p in parts if p and 5 * len(s & p) >= 4 * len(p)}
    assert got == want and got
    words = odd_rows[2][1].split()
    long_words = [r for r in odd_rows if r[0] == 307][0][1].split()
    items = spark.createDataFrame(
        [(1, " ".join(words[10:50])), (2, " ".join(long_words[30000:30030])), (3, "one"), (4, ""), (5, None), (6, " ".join(words[10:50])),
         (7, " ".join(words[10:40]) + " q r s t u v w x y z q r s"), (8, "no such words are in there")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contained_items(odd_docs, items).collect()}
    assert got == {(d, i) for d in (2, 102, 202) for i in (1, 6)} | {(307, 2), (303, 3), (304, 3)}
    rest = decontam.drop_contaminated(odd_docs, items)
    assert rest.columns == odd_docs.columns and rest.count() == len(odd_rows) - 6
    assert decontam.contained_items(no_docs, items).count() == 0
    assert decontam.contained_items(odd_docs, items.limit(0)).count() == 0


def test_sketch_always_meets_a_containing_document():
    for n in range(1, 400):
        m = decontam.sketch_size(n, 0.8)
        assert m > n - decontam.needed(n, 0.8) and m <= n


# --- 7 chat

def test_chat_escape_is_reversible():
    import random
    rng = random.Random(1)
    bits = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "</SYS>>", "ROLE ", "a", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(8)))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text and not re.search(r"</?s>|\[/?INST\]|<</?SYS>>|\[ROLE |\[/ROLE\]", hidden)
        role = rng.choice(["user", "assistant", "system", "x y]", ""])
        assert chat.read_turn(chat.format_turn(role, text)[0]) == (role, text)


def test_chat_layouts(spark):
    records = [
        '{"role": "user", "text": "a"}', '{"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": null}]}',
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}', '{"prompt": "p", "response": "r"}',
        '{"instruction": "i", "input": "n", "output": "o"}', '{"instruction": "i", "output": "o"}', '{"x": 1}', "not json", None, "[]",
        '{"messages": []}']
    want = [[("user", "a")], [("system", "s"), ("user", "")], [("user", "q"), ("assistant", "r")], [("user", "p"), ("assistant", "r")],
            [("user", "i\n\nn"), ("assistant", "o")], [("user", "i"), ("assistant", "o")], [], [], [], [], []]
    assert [chat.turns_of(r)[1] for r in records] == want
    df = spark.createDataFrame(list(enumerate(records)), "conv_id bigint, record string").withColumn("seq", F.lit(0))
    out = chat.format_records(df)
    assert chat.unknown_layouts(out).first().n_records == 5
    assert chat.conversation_digests(out).count() == 6


def test_chat_digests(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s> [INST]"), (1, 1, "assistant", "</s> [INST]"), (2, 5, "assistant", None),
            (2, 3, None, "x"), (None, 0, "user", "n"), (3, None, "user", "u"), (4, 0, "assistant", "long " * 100000)]
    conv = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(chat.turn_records(conv))).collect()}
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t or 0, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].loss_chars) == (len(turns), len(learned))
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    assert chat.conversation_digests(chat.format_conversations(chat.turn_records(conv.limit(0)))).count() == 0


# --- 8 pages

def test_pages(spark):
    page = ('<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>";</script></head><body><header>Top</header>'
            '<nav><ul><li>Menu {0}</ul></nav><div class="ad">Buy {0}</div><main><article><h1>Head {0} &amp; co</h1><p>First  <b>bold{0}</b>\n x<p>Second<br>line'
            '<aside>side</aside><form><input value="v">send</form><div class="comments"><p>Reader says {0}</div><pre>a   b</pre></article></main>'
            "<!-- <p>gone</p> --><footer>&copy; {0}</footer></body></html>")
    rows = [(i, f"https://Host.example/p{i}", page.format(f"w{i}")) for i in range(6)]
    rows += [(6, "nohost", page.format("w6")), (7, None, None), (8, "https://a.example/x", ""), (9, "https://a.example/y", "<body><div>plain <i>te</i>xt</div>tail"),
             (None, "https://host.example/", page.format("n")), (0, rows[0][1], rows[0][2]), (10, "https://b.example/", "<article><p>cut o"),
             (11, "https://b.example/2", "<p>" + "long " * 50000)]
    got = pagetext.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    for i in [*range(7), None]:
        w = "n" if i is None else f"w{i}"
        assert text[i] == f"Head {w} & co\nFirst bold{w} x\nSecond line\na b"
    assert text[7] == "" and text[8] == "" and text[9] == "plain text\ntail" and text[10] == "cut o" and len(text[11]) == 249999
    assert all(r.n_chars == len(r.text) for r in got)
    assert pagetext.extract_pages(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_pages_table(spark):
    import html
    pages = {r.page_id: r.html for r in load(spark, SF_SMALL, "pages").collect()}
    for r in queries.op8_html_extraction(spark, SF_SMALL).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(x for x in blocks if x)


def test_pages_named_wrappers_and_implicit_closes():
    """Class names of the page's frame and of wrappers do not empty it; an implied end tag ends an ad."""
    body = "<p>First long line of the story<p>Second long line of the story"
    want = "First long line of the story\nSecond long line of the story"
    nothing = frozenset()
    for page in (f'<body class="has-sidebar"><div>{body}</div></body>', f'<body><article class="post comments-open">{body}</article></body>',
                 f'<body><div class="with-nav"><div class="nav">Home</div>{body}</div></body>', f'<main id="social">{body}</main>'):
        assert pagetext.extract(page, nothing, False) == want
    assert pagetext.extract(f'<body><div class="comments"><p>me too</div>{body}</body>', nothing, False) == want
    page = f'<body><p class="ad">Buy{body}</body>'
    assert [n for k, n, _ in pagetext.events(page) if k == "close"] == ["p", "p", "p", "body"]
    ad = [t for t, n in pagetext.page_tokens(page) if n == "body/p.ad"]
    assert len(ad) == 2 and pagetext.extract(page, frozenset(ad), False) == want


# --- 9 toxicity

def test_toxicity(spark, odd_docs, odd_rows, no_docs):
    d = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in load(spark, d, "labels").collect()}
    rows = queries.op9_toxicity(spark, d).collect()
    assert all(0 <= r.expected_severity <= 2 and r.severity in (0, 1, 2) for r in rows)
    held = [r for r in rows if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.toxic for r in held if truth[r.doc_id]]) > 0.85
    assert np.mean([r.toxic for r in held if not truth[r.doc_id]]) < 0.02


def test_toxicity_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = labels_of(spark, [(i, 1, i % 2) for i in range(12)] + [(3, 0, 0), (3, 1, 1), (None, 1, 1), (5, 1, None)])
    got = toxicity.score_toxicity(odd_docs, labels).collect()
    assert len(got) == len(odd_rows) and all(r.expected_severity is not None for r in got)
    assert toxicity.score_toxicity(no_docs, labels).count() == 0
    assert not any(r.toxic for r in toxicity.score_toxicity(odd_docs, labels_of(spark, [])).collect())


# --- 10 near-duplicates

def classes(rows, k, threshold):
    """Smallest linked id per row by comparing all pairs."""
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= round(100 * threshold) * len(a | b):
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        ids = [x for x in (low.get(r), doc) if x is not None]
        low[r] = min(ids) if ids else None
    return sorted((str(rows[i][0]), len(s), str(low[find(i)])) for i, s in enumerate(sets))


@pytest.mark.parametrize("k,threshold", [(3, 0.85), (5, 0.8)])
def test_near_duplicates_brute_force(spark, odd_docs, odd_rows, k, threshold):
    rows = [(r[0], r[1]) for r in odd_rows]
    got = neardup.near_duplicates(odd_docs, k, threshold).collect()
    have = sorted((str(r.doc_id), r.n_shingles, str(r.component_id if r.n_shingles else r.doc_id)) for r in got)
    assert have == classes(rows, k, threshold)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_table(spark):
    rows = [(r.doc_id, r.text) for r in load(spark, SF_SMALL, "documents").collect()]
    got = queries.op10_near_duplicates(spark, SF_SMALL).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == classes(rows, 3, 0.85)


def test_near_duplicates_of_one_id(spark):
    """Many texts under one id or without id: each node meets its own text only."""
    rows = [(None if i % 3 else 7, " ".join(f"w{(i % 20) * 100 + j}" for j in range(40)) + f" end{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = neardup.fingerprints(df, 3, 0.85).collect()
    nodes = spark.createDataFrame([(r.node, r.doc_id, r.v) for r in marks], "node binary, rep bigint, v bigint")
    assert neardup.chosen_texts(df, nodes).count() == len({r.node for r in marks}) == 60
    got = neardup.near_duplicates(df, 3, 0.85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == classes(rows, 3, 0.85)


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Chains of near copies in one bucket of many blocks."""
    import random
    rng = random.Random(11)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        w = list(words)
        for j in range(i // 6):
            w[(j * 14) % 150] = f"z{i // 6}{j}"
        w[rng.randrange(150)] = f"r{i}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(neardup, "BLOCK", 4)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = neardup.near_duplicates(df, 3, 0.85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == classes(rows, 3, 0.85)


def test_keep_one(spark, odd_docs, odd_rows, no_docs):
    rest = neardup.keep_one(odd_docs)
    assert rest.columns == odd_docs.columns
    kept = [(r.doc_id, r.text) for r in rest.collect()]
    got = collections.Counter(x[2] for x in classes(kept, 5, 0.8) if x[1])
    assert max(got.values()) == 1  # one of each group
    assert len(got) == len({x[2] for x in classes([(i, r[1]) for i, r in enumerate(odd_rows)], 5, 0.8) if x[1]})
    assert sum(not shingle_set(t, 5) for _, t in kept) == sum(not shingle_set(r[1], 5) for r in odd_rows)
    assert neardup.keep_one(no_docs).count() == 0


def test_pruning_bounds():
    least = neardup.least_matches(0.85)
    assert least == sorted(least) and least[-1] < 0.85 * neardup.SIGNATURE
    from math import comb
    n, m = 128, least[-1]
    p = lambda m: sum(comb(n + 1, i) * 0.85 ** i * 0.15 ** (n + 1 - i) for i in range(m + 1))
    assert p(m) >= neardup.MISS > p(m - 1)
    for t in (0.8, 0.85):
        r = neardup.band_rows(t)
        assert (1 - t ** r) ** (neardup.SIGNATURE // r) <= neardup.BAND_MISS
