"""SimHash components against all pairs of fingerprints, and the ball's links against planted distances."""

import random
import re

import numpy as np
import pytest
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    w = WORDS.findall((text or "").encode().lower().decode())
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, radius=3):
    """Class of each distinct fingerprint, from all pairs."""
    v = np.array(sorted(set(fps)), dtype=np.uint64)
    parent = list(range(len(v)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= radius).tolist():
            parent[find(i)] = find(i + 1 + j)
    return {int(x): find(i) for i, x in enumerate(v)}


def test_fingerprints(docs, empty):
    from lakequery.llm.ball_simhash import ball_components

    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    of = [plain_fingerprint(t) for _, t in given]
    group = classes(of)
    least = {}
    for (k, _), f in zip(given, of, strict=True):
        if k is not None:
            least[group[f]] = min(k, least.get(group[f], k))
    want = sorted(((k, f"{f:016x}", least.get(group[f])) for (k, _), f in zip(given, of, strict=True)), key=str)
    assert sorted((tuple(r) for r in ball_components(docs).collect()), key=str) == want
    assert len(set(group.values())) < len(group)  # links between different fingerprints
    assert ball_components(empty).count() == 0


def test_long_text_in_blocks(monkeypatch):
    from lakequery.llm import ball_simhash as m

    r = random.Random(8)
    text = " ".join(r.choice(["Aa", "b", "Éc", "d", "ee"]) for _ in range(700))
    monkeypatch.setattr(m, "BLOCK", 64)
    assert m.fingerprint(m.shingle_hashes(text.encode())) == plain_fingerprint(text)
    assert [m.fingerprint(m.shingle_hashes(t.encode())) for t in ("", " \t", "One", "one  TWO")] == [0, 0, plain_fingerprint("one"), plain_fingerprint("one two")]


@pytest.mark.parametrize("seed", [1, 2])
def test_ball(spark, seed):
    """Planted distances of 1 to 5 bits in either half and across both, chains, a crowd around one fingerprint, and the ends of the range."""
    from pyspark.sql import functions as F

    from lakequery.llm.ball_simhash import ball_links, with_partners

    r = random.Random(seed)
    flip = lambda x, bits: x ^ sum(1 << b for b in bits)
    fps = {0, 1, 7, 1 << 63, 2**64 - 1, 2**64 - 8, (1 << 63) | 3}
    for d in range(1, 6):
        for span in (range(32), range(32, 64), range(64)):
            for _ in range(12):
                x = r.getrandbits(64)
                fps |= {x, flip(x, r.sample(span, d))}
    x = r.getrandbits(64)
    for _ in range(40):  # a chain of three bits each
        fps.add(x)
        x = flip(x, r.sample(range(64), 3))
    x = r.getrandbits(64)
    fps |= {flip(x, r.sample(range(64), r.randrange(8))) for _ in range(400)}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    some = {x.fp % 2**64 for x in with_partners(nodes).collect()}
    links = {(x.u % 2**64, x.v % 2**64) for x in ball_links(nodes.where(F.col("fp").isin([f - 2**64 if f >= 2**63 else f for f in some]))).collect()}
    assert all((u ^ v).bit_count() <= 3 for u, v in links)
    parent = {f: f for f in fps}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for u, v in links:
        parent[find(u)] = find(v)
    want = classes(fps)
    mine = {f: find(f) for f in fps}
    assert len(set(mine.values())) == len(set(want.values())) == len({(mine[f], want[f]) for f in fps})
    assert len(set(want.values())) < len(fps) - 200
