"""Recall of the decontamination's radius against a full comparison, for items of all lengths, with and without repeated shingles."""

import random
from collections import Counter

import numpy as np
import pytest

LENGTHS = (14, 24, 54, 104, 204, 404, 804, 1000)


def similarity(a, b):
    x, y = (Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (a, b))
    return sum((x & y).values()) / sum((x | y).values())


def changed(r, item, kind):
    """The item with changes of one kind, as many as the threshold allows."""
    fresh = lambda: f"n{r.randrange(10**9)}"
    at = {"end": lambda n: len(item) - n, "middle": lambda n: (len(item) - n) // 2, "start": lambda n: 0}
    best = None
    for n in range(1, len(item)):
        if kind == "random":
            w = list(item)
            for i in r.sample(range(len(w)), n):
                w[i] = fresh()
            step = w
        elif kind == "cycle":  # a phrase of three words again and again
            step = item[: len(item) - n] + ["ha", "he", "hi"] * (n // 3) + ["ha", "he"][: n % 3]
        else:  # a run of one word
            i = at[kind](n)
            step = item[:i] + ["again"] * n + item[i + n :]
        s = similarity(item, step)
        if s < 0.8:
            if kind != "random" or n > len(item) // 3:
                break
            continue
        best = step
    return best


@pytest.mark.parametrize("kind", ["random", "start", "middle", "end", "cycle"])
def test_recall(kind):
    from lakequery.llm.simhash_decontam import RADIUS, Items

    r = random.Random(kind)
    missed, tried = Counter(), 0
    for size in LENGTHS:
        for k in range(12):
            pool = [f"w{r.randrange(10**9 if k % 2 else 40)}" for _ in range(size)]  # every other item repeats its words
            doc = changed(r, pool, kind)
            if doc is None:
                continue
            tried += 1
            around = [f"x{r.randrange(10**9)}" for _ in range(30)]
            text = " ".join([*around, *doc, *around[::-1]]).encode()
            found = Items([(1, " ".join(pool).encode())], 0.8, RADIUS).matches([text])[0]
            missed[size] += not found
    assert tried > 60 and sum(missed.values()) == 0, missed


def test_numbered_windows():
    """Sliding fingerprints against those of each window by itself, on texts that repeat shingles."""
    from lakequery.llm.common import U64, mix
    from lakequery.llm.simhash_decontam import fingerprints

    r = np.random.default_rng(6)

    def alone(window):
        seen, votes = Counter(), [0] * 64
        for g in window.tolist():
            seen[g] += 1
            h = int(mix(np.array([(g + seen[g] * 0x9E3779B97F4A7C15) % 2**64], dtype=U64))[0])
            for b in range(64):
                votes[b] += 1 if h >> b & 1 else -1
        return sum(1 << b for b in range(64) if votes[b] > 0)

    for distinct, count in ((3, 7), (40, 25), (10**6, 9), (1, 12)):
        grams = r.integers(0, 2**63, distinct, dtype=np.uint64)[r.integers(0, distinct, 260)]
        for first in (np.arange(260 - count + 1), np.array([0, 1, 5, 90, 91, 260 - count])):
            assert fingerprints(grams, first, count).tolist() == [alone(grams[i : i + count]) for i in first.tolist()]
    long = r.integers(0, 50, 20_000).astype(np.uint64)  # more than one stretch
    at = np.array([0, 8190, 8191, 8192, 16_500, 19_900])
    assert fingerprints(long, np.arange(19_991), 10)[at].tolist() == [alone(long[i : i + 10]) for i in at.tolist()]
    assert len(fingerprints(long, at[:0], 10)) == 0
