"""Working columns clash with no column of the input."""

import random

import pytest
from pyspark.sql import functions as F

from lakequery.functions import rank
from lakequery.functions.text import fresh
from lakequery.operators import joins


def test_fresh():
    assert fresh(["a", "_V", "__p"], "v", "q") == ["__v", "__q"] and fresh([], "x") == ["_x"]


def test_inputs_keep_their_columns(spark):
    df = spark.createDataFrame([(1, 5, 7, "k"), (2, 4, 8, "k"), (3, 9, 9, "j")], "_rn int, _v int, _w int, _n string")
    assert sorted(map(tuple, rank.top_n(df, ["_n"], [F.asc("_v")]).collect())) == [(2, 4, 8, "k"), (3, 9, 9, "j")]
    odd = spark.createDataFrame([(i, 10 * i) for i in (3, 1, 2)], "_v int, _p int")
    assert sorted(map(tuple, rank.running(odd, [F.asc("_v")], F.col("_p"), "_b").collect())) == [(1, 10, 10), (2, 20, 30), (3, 30, 60)]
    assert sorted(map(tuple, rank.mode_by(df, ["_n"], "_v", "m").collect())) == [("j", 9, 1), ("k", 4, 1)]
    p = spark.createDataFrame([(0.01, 1), (0.02, 2)], "_x double, _bucket int")
    assert sorted((r._x, r._bucket, round(r.f, 9)) for r in rank.benjamini_hochberg(p, "_x", "f").collect()) == [(0.01, 1, 0.02), (0.02, 2, 0.02)]
    left, right = spark.createDataFrame([("abcdef", 1, 2)], "_l string, _p int, _n int"), spark.createDataFrame([("abcdeg", 3)], "_r string, _m int")
    assert list(map(tuple, joins.blocked_pairs(left, right, "_l", "_r").collect())) == [("abcdef", 1, 2, "abcdeg", 3)]
    docs = spark.createDataFrame([("x y", "own")], "_t string, hit string")
    assert list(map(tuple, joins.keyword_hits(docs, [("a", "x")], F.col("_t")).collect())) == [("x y", "own", "a", "x")]


@pytest.mark.parametrize("grouped", [False, True])
def test_rates_over_many_scales(spark, grouped):
    """P-values from 1e-300 to beyond 1, with ties, zeros and nulls."""
    r = random.Random(3)
    rows = [(r.choice("ab"), r.choice([10 ** -r.uniform(0, 300), r.random(), r.randrange(8) / 8, 0.0, 1.0, 2.0**-r.randrange(60), None])) for _ in range(700)]
    got = rank.benjamini_hochberg(spark.createDataFrame(rows, "k string, p double").repartition(3), "p", "f", ["k"] if grouped else None).collect()
    assert sorted(((x.k, x.p) for x in got), key=str) == sorted(rows, key=str)
    for x in got:
        if x.p is None:
            assert x.f is None
            continue
        mine = sorted(p for k, p in rows if p is not None and (not grouped or k == x.k))
        want = min([1.0] + [q * len(mine) / sum(z <= q for z in mine) for q in set(mine) if q >= x.p])
        assert x.f == pytest.approx(want, rel=1e-12)
