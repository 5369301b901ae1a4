"""Spelling groups against deletions in plain Python, and the automaton against its words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(rows, least, drop):
    found = Counter()
    for k, t in rows:
        for run in RUN.findall(t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if h % drop == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            if len(run) >= 6:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least}


def plain_near(words):
    """By the places and remainders of all deletions."""
    cut, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            cut[i, w[:i] + w[i + 1 :]].add(w)
    for (_, rest), same in cut.items():
        for w in same:
            near[w] |= same - {w}
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    return near


def plain_groups(rows, least=5, drop=199, ratio=5):
    n = plain_counts(rows, least, drop)
    near = plain_near(set(n))
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def told(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(seed, size=60):
    """Texts of misspelt words: stems of equal letters, long shared halves, repeated letters, all of Latin-1, other scripts."""
    r = random.Random(seed)
    letters = "abcdeéßÿÀ×"
    stems = ["aaaaaa", "aaaaaaaa", "abababab", "commonheadxyzw", "commonheadwxyz", "grandes", "Grandes", "straße", "Àlpages", "naïveté"] + ["".join(r.choice(letters) for _ in range(r.randint(5, 11))) for _ in range(size)]

    def odd(w):
        if r.random() > 0.25:
            return w
        i, kind = r.randrange(len(w)), r.randrange(3)
        return w[:i] + ("" if kind == 0 else r.choice(letters)) + w[i + (kind != 2) :]

    texts = [" ".join(odd(odd(r.choice(stems[: 8 + i % len(stems)]))) for _ in range(r.randrange(150))) for i in range(120)]
    return [*enumerate(texts), (None, "grandes 1 grandes-grandes"), (None, None), (7, ""), (7, texts[3]), (7, texts[3]), (500, "日本語grandesЖgrandésĀgrandes")]


@pytest.mark.parametrize("block", [40_000, 60, 1])
def test_groups(spark, block):
    """With small blocks, crowded halves are halved again, down to single letters."""
    from lakequery.llm.spelling_variants import spelling_groups

    rows = made(3)
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, word string, n int").repartition(5)
    want = plain_groups(rows)
    assert told(spelling_groups(df, block=block)) == want
    assert sum(x[1] is not None for x in want) > 30 and max(x[4] for x in want) > 5


def test_small_and_shared_tables(docs, empty):
    from lakequery.llm.spelling_variants import spelling_groups

    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert told(spelling_groups(docs, least=2, drop=5)) == plain_groups(given, least=2, drop=5)
    assert spelling_groups(empty).count() == 0


def test_automaton():
    from lakequery.llm.spelling_variants import Automaton

    r = random.Random(5)
    words = sorted({"".join(r.choice("abé") for _ in range(r.randint(1, 7))) for _ in range(400)})
    a = Automaton(words)
    assert [a.number(w) for w in words] == list(range(len(words)))  # perfect hashing
    assert a.number("") is None and a.number("zz") is None and a.number(words[5] + "qq") is None
    # minimal: states of equal completions are one
    ends = lambda s: frozenset(({""} if a.final[s] else set()) | {c + e for c, (t, _) in a.arcs[s].items() for e in ends(t)})
    assert len({ends(s) for s in range(len(a.arcs))}) == len(a.arcs)
    near = plain_near(set(words))
    for w in words:
        assert {words[i] for i in a.near(w, 0, len(w))} - {w} == near[w]
        half = len(w) // 2
        assert {words[i] for i in a.near(w, half, len(w))} - {w} <= near[w]
    assert Automaton([]).near("abc", 0, 3) == set()


def test_chain_of_forms(spark):
    """Forms of forms lead to one root, each with five times the count of the one before."""
    from lakequery.llm.spelling_variants import spelling_groups

    chain = ["abcdefgh"]
    for i in range(4):
        chain.append(chain[-1][:i] + "z" + chain[-1][i + 1 :])
    rows = [(i, " ".join([w] * 5 ** (5 - i))) for i, w in enumerate(chain)]
    got = told(spelling_groups(spark.createDataFrame(rows, "doc_id long, text string"), drop=10**9))
    assert got == plain_groups(rows, drop=10**9)
    assert {x[2] for x in got} == {"abcdefgh"} and len(got) == 5
