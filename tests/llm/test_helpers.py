import random

import numpy as np
import pytest

from boxframe.llm import gbdt, ordinal, rangecoder
from boxframe.llm.graph import components
from boxframe.llm.textkit import SEGMENT, shingles, word_hashes


def test_word_hashes_follow_bytes_split():
    rng = random.Random(1)
    texts = [b"", b"  ", b"a b a", b"\x0b\x0ca\r\nb", "é ü".encode(), b"y" * (3 * SEGMENT),
             b" ".join(b"w%d" % rng.randrange(10 ** 6) for _ in range(SEGMENT // 3)), b"a " + b"y" * (3 * SEGMENT) + b" b"]
    known = {}
    for t, h in zip(texts, word_hashes(texts)):
        assert len(h) == len(t.split())
        for w, x in zip(t.split(), h):
            assert known.setdefault(w, x) == x
    assert len(set(known.values())) == len(known)


def test_shingles():
    a, b = word_hashes([b"a b c a b c", b"a b"])
    assert len(shingles(a, 3)) == 4 and len(set(shingles(a, 3))) == 3
    assert len(shingles(b, 3)) == 1 and len(shingles(a[:0], 3)) == 0


def test_components_against_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)] + [(200, k) for k in range(201, 260)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_range_coder_round_trip_and_damage():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 49408, n).astype(np.uint32) for n in (1, 2, 300, 2048)]
    blocks += [np.zeros(2048, np.uint32), np.full(9, 49407, np.uint32), np.tile(np.arange(7, dtype=np.uint32), 200)]
    data = rangecoder.encode_blocks(blocks, 16)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(blocks, rangecoder.decode_blocks(data)))
    assert len(data[4]) < 400 and len(data[6]) < 600  # what repeats is predicted
    # a block is coded alone: alone or in company, the same bytes
    assert rangecoder.encode_blocks(blocks[2:3], 16) == data[2:3]
    for at in (5, 20, len(data[2]) - 1):
        bad = bytearray(data[2])
        bad[at] ^= 1
        with pytest.raises(ValueError):
            rangecoder.decode_blocks([bytes(bad)])


def test_trees_learn_and_match_node_by_node():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    m = gbdt.fit(x[:2000], y[:2000], trees=30, depth=3)
    assert ((m.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95

    def walk(row):
        total = m.prior
        for f, c, leaf in zip(m.feature, m.cut, m.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + (row[f[node]] > c[node])
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))
    assert np.allclose(m.score(x[:50]), [walk(r) for r in x[:50]])
    assert gbdt.fit(x[:0], y[:0]).score(x[:1])[0] > 0.5


def test_ordinal_gradient_and_order():
    rng = np.random.default_rng(4)
    n = 600
    dense = rng.random((n, 6)) < 0.3
    z = dense @ np.array([2.0, 1.0, 0, 0, -1.0, 3.0]) + rng.logistic(size=n)
    grades = np.digitize(z, [1.0, 3.0])
    rows, cols = np.nonzero(dense)
    w, cuts = ordinal.fit(rows, cols, grades, 6, 3)
    assert cuts[0] < cuts[1] and w[5] > w[0] > w[1] > w[4]
    p = ordinal.grade_probabilities(dense @ w, cuts)
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    assert np.allclose(p @ np.arange(3), ordinal.expected_grade(dense @ w, cuts))

    def loss(w, cuts):
        return -np.log(ordinal.grade_probabilities(dense @ w, cuts)[np.arange(n), grades]).mean()
    best = loss(w, cuts)
    for k in range(6):
        for step in (-0.05, 0.05):
            v = w.copy()
            v[k] += step
            assert loss(v, cuts) > best - 1e-4
