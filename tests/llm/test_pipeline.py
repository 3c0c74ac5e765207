"""The corpus pipeline against its stages by brute force."""

import corpus_pipeline
from boxframe.llm.textkit import load, written
from tests.conftest import SF_SMALL
from tests.llm.test_operators import classes, id_stream, shingle_set


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "token_ids"]
    docs = load(spark, SF_SMALL, "documents")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(written(stage(spark, kept[-1], SF_SMALL)))
        assert kept[-1].columns == docs.columns
    rows = [[(r.doc_id, r.text) for r in k.collect()] for k in kept]
    good = {r.doc_id for r in load(spark, SF_SMALL, "labels").filter("quality = 1").collect()}
    assert len(good & {i for i, _ in rows[1]}) > 0.9 * len(good)  # learned from a few dozen labels here
    # near-duplicates: the smallest id of each class of what the first stage kept
    assert sorted(str(i) for i, _ in rows[2]) == sorted(x[0] for x in classes(rows[1], 5, 0.8) if x[0] == x[2] or not x[1])
    items = [shingle_set(r.text, 5) for r in load(spark, SF_SMALL, "benchmark").collect()]
    clean = [i for i, t in rows[2] if not any(p and 5 * len(p & shingle_set(t, 5)) >= 4 * len(p) for p in items)]
    assert sorted(i for i, _ in rows[3]) == sorted(clean)
    assert set(rows[4]) <= set(rows[3]) and rows[4]
    want, _ = id_stream(rows[4])
    got = {r.doc_id: [(r.start, r.n_tokens, r.ids_crc32)] for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == want


def test_entry_lists_the_queries():
    import __spark_entry__ as e
    names = e.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
