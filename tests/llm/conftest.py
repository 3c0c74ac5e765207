import random

import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, node string, h string, a string"


def rows_to_docs(spark, rows):
    """Documents with the usual columns and extra ones whose names clash with inner ones."""
    full = [(i, t, lang, src, None if t is None else len(t), 9.9, "x", "y", "z") for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOC_SCHEMA).repartition(3)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empties, repeated rows, equal ids with other texts, near copies, one very long text."""
    rng = random.Random(5)
    base = [prose(rng, 120) for _ in range(12)]
    rows = [(i, t, "en", "s0") for i, t in enumerate(base)]
    for k, t in enumerate(base[:5]):  # near copies: one word changed
        w = t.split()
        w[60] = "changed"
        rows.append((100 + k, " ".join(w), "fr", None))
        rows.append((200 + k, t.upper(), None, "s1"))  # equal after A-Z folding
    rows += [(300, None, "en", "s0"), (301, "", "en", "s0"), (302, " \n\t ", None, None), (303, "one", "en", "s1"),
             (304, "ONE", "en", "s1"), (None, base[6], "en", "s2"), (None, None, None, None),
             (305, base[7], "en", "s0"), (305, base[7], "en", "s0"), (306, base[8], "en", "s0"), (306, "other words here", "en", "s0"),
             (307, prose(rng, 60000), "de", "s2"), (308, "x" * 700000, "de", "s2"), (309, "é ü ß 日本   \x1c ½", "de", "s2")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return rows_to_docs(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
