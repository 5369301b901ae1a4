"""The source divergence audit against every group times every term in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least_docs, top=10):
    """Rows of (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    n, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall(text.encode().lower().decode())  # of bytes, lower() maps A-Z alone
        n[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang in {r[1] for r in rows}:
        kept = [t for t, d in docs[lang].items() if d >= least_docs]
        groups = sorted({r[2] for r in rows if r[1] == lang})
        p, whole = {}, Counter()
        for s in groups:
            whole.update(n[lang, s])
        for s, c in [*((s, n[lang, s]) for s in groups), (None, whole)]:
            total = sum(c[t] for t in kept)
            p[s] = {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s)
            term = sorted((-f(p[s][t], p[None][t]), t.encode(), t) for t in kept if n[lang, s][t] and p[s][t] > p[None][t])[:top]
            for part, ranked in (("pair", pair), ("term", term)):
                out |= {(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(ranked, 1)}
    return out


def told(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("least", [1, 3, 10])
def test_divergence(docs, least):
    from lakequery.llm.source_divergence import source_divergence

    given = [(r.text, r.lang, r.source) for r in docs.select("text", "lang", "source").collect()]
    want = brute(given, least)
    assert told(source_divergence(docs, least)) == want
    assert {x[2] for x in want} == {"pair", "term"}


def test_many_sources(spark, monkeypatch):
    """Groups of very unequal sizes, terms of one source alone, groups without terms, ties, and characters of all kinds; texts cut into many slices."""
    from lakequery.llm import common, source_divergence as m

    r = random.Random(4)
    pool = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)] + ["Größe", "größe", "GRÖSSE", "你好", "naïve x", " sep", "\U0001f600", "a\x00b", "x_y", "A1B2"]
    rows = []
    for i in range(400):
        s = "big" if r.random() < 0.5 else f"s{r.randrange(9)}"
        own = [f"only{s}"] if r.random() < 0.5 else []
        text = " ".join(r.choice(pool[: 20 if s == "big" else 160]) for _ in range(r.randrange(60))) + "\t" + " ".join(own)
        rows.append((text, r.choice(["en", "de", "", None]), s))
    rows += [("", "en", "silent"), (None, "en", None), ("12 -- 34", "en", "digits"), ("alone in its language", "xx", "one"), ("", "yy", "a"), ("", "yy", "b"), (None, None, None)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    cut = common.slices
    monkeypatch.setattr(m, "slices", lambda batches, limit: cut(batches, limit=2_000))
    want = brute(rows, 3)
    assert told(m.source_divergence(df, 3)) == want
    assert ("yy", "a", "pair", "b", 0, 1) in want and not any(x[0] == "xx" and x[2] == "pair" for x in want)
    assert told(m.source_divergence(df, 10**6)) == brute(rows, 10**6)


def test_nothing(empty):
    from lakequery.llm.source_divergence import source_divergence

    assert source_divergence(empty).count() == 0


def test_large_counts(spark):
    """Shares stay exact where the product with a thousand million would leave a long."""
    from pyspark.sql import functions as F

    from lakequery.llm.source_divergence import _p

    given = [(0, 1, 1), (7, 100, 3), (10**12 - 1, 10**12, 17), (3 * 10**14, 9 * 10**14, 10**9), (0, 0, 0)]
    got = spark.createDataFrame(given, "c long, t long, v long").select("c", "t", "v", _p(F.col("c"), F.col("t"), F.col("v")).alias("p")).collect()
    assert {tuple(x) for x in got} == {(c, t, v, 1 + 10**9 * (c + 2) // (t + 2 * v) if t + 2 * v else None) for c, t, v in given}
