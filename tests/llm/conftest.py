import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, rid string, size int, shard string"


def make_texts(seed=5):
    """Documents with near and exact copies, shared passages, nulls, empties, ties, repeated rows and a very long text."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6)))
    words = lambda n: [word() for _ in range(n)]
    base, passage = words(120), words(70)
    out = []
    for i in range(12):  # edited copies of one text
        w = list(base)
        for _ in range(i // 3):
            w[r.randrange(len(w))] = word()
        out.append(" ".join(w))
    out += [" ".join(base)] * 4
    out += [" ".join(words(30) + passage + words(20)) for _ in range(6)]
    out += ["the " * 300, "a b c d", "a b c d", "A B C D", "x", "", " \t\n", None, None, "12 345 ... !!", "é" * 60 + " ß ñ 你好", "line one two\nline one two\nother words here\n" * 8]
    out += [" ".join(words(9000))]
    out += [" ".join(words(r.randint(1, 90))) for _ in range(15)]
    return out


@pytest.fixture(scope="session")
def rows():
    texts = make_texts()
    made = [(100 + 7 * i % 200 + 200 * (i // 200), t, ("en", "de", None)[i % 3], ("s1", "s1", "s2", None)[i % 4], 1, 9, "clash", 3, "x") for i, t in enumerate(texts)]
    return [*made, made[3], (None, texts[0], "en", "s1", 1, 9, "clash", 3, "x"), (None, "only here once", "en", "s2", 1, 9, "clash", 3, "x")]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def unique(spark, rows):
    """Rows with distinct non-null ids, for comparisons by doc_id."""
    seen, out = set(), []
    for r in rows:
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return spark.createDataFrame(out, SCHEMA).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
