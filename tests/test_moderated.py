"""Moderated statistics against plain numpy."""

import math

import numpy as np
import pytest

from lakequery.operators import moderated as m

LONG = "id string, sample string, value double"


def test_special_functions():
    euler = 0.57721566490153286
    assert m.digamma(1) == pytest.approx(-euler, abs=1e-14) and m.digamma(0.5) == pytest.approx(-euler - 2 * math.log(2), abs=1e-13)
    assert m.trigamma(1) == pytest.approx(math.pi**2 / 6, abs=1e-13) and m.trigamma(0.5) == pytest.approx(math.pi**2 / 2, abs=1e-12)
    for x in (0.01, 0.7, 3.0, 250.0):
        assert m.trigamma_inverse(m.trigamma(x)) == pytest.approx(x, rel=1e-10)
    t = np.array([0.0, 1.0, -2.5, 40.0, 1e-9])
    assert m.two_sided(t, np.full(5, 1.0)) == pytest.approx([1 - 2 / math.pi * math.atan(abs(x)) for x in t], rel=1e-11)  # Cauchy
    assert m.two_sided(t, np.full(5, 2.0)) == pytest.approx([1 - abs(x) / math.sqrt(2 + x * x) for x in t], rel=1e-9, abs=1e-15)
    assert m.two_sided(t, np.full(5, np.inf)) == pytest.approx([math.erfc(abs(x) / math.sqrt(2)) for x in t])
    big = m.two_sided(np.array([3.0]), np.array([1e7]))[0]
    assert big == pytest.approx(math.erfc(3 / math.sqrt(2)), rel=1e-5)
    assert np.isnan(m.two_sided(np.array([np.nan, 1.0]), np.array([3.0, np.nan]))).all()


def plain_t(values, groups, contrast):
    """values: ids x samples with nan for missing ones."""
    names = sorted(set(groups))
    at = {g: [i for i, x in enumerate(groups) if x == g] for g in names}
    fits = []
    for row in values:
        by = {g: row[at[g]][~np.isnan(row[at[g]])] for g in names}
        df = sum(max(0, len(x) - 1) for x in by.values())
        ss = sum(((x - x.mean()) ** 2).sum() for x in by.values() if len(x))
        fits.append((by, df, ss / df if df else math.nan))
    s2 = np.array([f[2] for f in fits if f[1]])
    d = np.array([f[1] for f in fits if f[1]])
    s2 = np.maximum(s2, 1e-5 * np.sort(s2)[(len(s2) - 1) // 2])
    e = np.log(s2) - np.array([m.digamma(x / 2) for x in d]) + np.log(d / 2)
    spread = e.var(ddof=1) - np.mean([m.trigamma(x / 2) for x in d])
    d0 = 2 * m.trigamma_inverse(spread) if spread > 0 else math.inf
    s0 = math.exp(e.mean() + m.digamma(d0 / 2) - math.log(d0 / 2)) if spread > 0 else math.exp(e.mean())
    out = []
    for by, df, own in fits:
        if any(not len(by[g]) for g, w in contrast.items() if w):
            out.append((None,) * 4)
            continue
        fc = sum(w * by[g].mean() for g, w in contrast.items())
        post = s0 if math.isinf(d0) else (d0 * s0 + (df * own if df else 0)) / (d0 + df)
        t = fc / math.sqrt(post * sum(w * w / len(by[g]) for g, w in contrast.items() if w))
        total = min(df + d0, d.sum())
        out.append((fc, t, total, m.two_sided(np.array([t]), np.array([total]))[0]))
    return out


@pytest.mark.parametrize("spread", [0.8, 0.0])
def test_moderated_t(spark, spread):
    """With variances that differ, and with ones that differ by chance alone, where the prior's degrees are infinite or nearly so."""
    r = np.random.default_rng(3)
    groups = ["a", "a", "a", "b", "b", "b", "c", "c"]
    sd = np.exp(r.normal(0, spread, 80))
    values = r.normal(size=(80, 8)) * sd[:, None] + 10
    values[:8, 3:6] += 4
    values[r.random(values.shape) < 0.05] = np.nan
    values[20] = np.nan
    values[20, 0] = 5.0  # one value only
    values[21, 3:6] = np.nan  # no value of b
    rows = [(f"p{i:02}", f"s{j}", float(v)) for i, row in enumerate(values) for j, v in enumerate(row)] + [("p00", "other", 99.0), (None, "s0", 1.0), ("p00", "s0", None)]
    samples = spark.createDataFrame([(f"s{j}", g) for j, g in enumerate(groups)] + [("unused", "z")], "sample string, grp string")
    contrasts = {"b_a": {"b": 1.0, "a": -1.0}, "mix": {"a": 0.5, "b": 0.5, "c": -1.0}}
    got = {(x.contrast, x.id): x for x in m.moderated_t(spark.createDataFrame(rows, LONG).repartition(3), samples, contrasts).collect()}
    assert len(got) == 160
    for name, weights in contrasts.items():
        want = plain_t(values, groups, weights)
        p = [w[3] for w in want if w[3] is not None]
        for i, w in enumerate(want):
            x = got[name, f"p{i:02}"]
            if w[0] is None:
                assert (x.log_fc, x.t, x.PValue, x.FDR_genome) == (None,) * 4
                continue
            assert (x.log_fc, x.t, x.df_total) == pytest.approx(w[:3], rel=1e-9) and x.PValue == pytest.approx(w[3], rel=1e-8)
            assert x.FDR_genome == pytest.approx(min(1.0, min(q * len(p) / sum(z <= q for z in p) for q in p if q >= w[3])), rel=1e-8)


def plain_factors(y):
    """y: ids x samples."""
    y = y[y.sum(axis=1) > 0]
    lib = y.sum(axis=0)
    ok = lib > 0
    q = np.array([np.quantile(y[:, j] / lib[j], 0.75) if ok[j] else np.nan for j in range(y.shape[1])])
    ref = int(np.nanargmin(np.abs(q - np.nanmean(q))))

    def ranks(x):
        return np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])

    f = np.full(y.shape[1], np.nan)
    for j in np.flatnonzero(ok):
        o, r = y[:, j], y[:, ref]
        keep = (o > 0) & (r > 0)
        o, r = o[keep], r[keep]
        ratio, mean = np.log2((o / lib[j]) / (r / lib[ref])), (np.log2(o / lib[j]) + np.log2(r / lib[ref])) / 2
        v = (lib[j] - o) / lib[j] / o + (lib[ref] - r) / lib[ref] / r
        n = len(o)
        if not n or np.abs(ratio).max() < 1e-6:
            f[j] = 0
            continue
        inside = lambda x, trim: (ranks(x) >= math.floor(n * trim) + 1) & (ranks(x) <= n - math.floor(n * trim))
        k = inside(ratio, 0.3) & inside(mean, 0.05)
        f[j] = (ratio[k] / v[k]).sum() / (1 / v[k]).sum() if k.any() else 0
    return np.where(np.isnan(f), 1.0, 2 ** (f - np.nanmean(f)))


def test_scaling_factors(spark):
    r = np.random.default_rng(5)
    y = r.poisson(np.exp(r.normal(2, 1.5, (300, 1))) * np.array([1, 2, 0.5, 1, 3]) * r.choice([1, 1, 1, 6], (300, 5))).astype(float)
    y[:20] = 0
    y[20:60, 1] = 0
    for table in (y, np.column_stack([y[:, :2], np.zeros(300)]), np.column_stack([y[:, :1], y[:, :1]])):
        rows = [(f"g{i}", f"s{j}", int(v)) for i, row in enumerate(table) for j, v in enumerate(row) if v or i % 2 or not table[:, j].any()] + [("g1", "s0", None)]
        got = {x.sample: x.factor for x in m.scaling_factors(spark.createDataFrame(rows, "id string, sample string, n long").repartition(4)).collect()}
        want = plain_factors(table)
        assert [got[f"s{j}"] for j in range(table.shape[1])] == pytest.approx(want.tolist(), rel=1e-9)
    assert m.scaling_factors(spark.createDataFrame([], "id string, sample string, n long")).count() == 0


def test_nothing_to_fit(spark):
    none = spark.createDataFrame([], LONG)
    samples = spark.createDataFrame([("s1", "a"), ("s2", "b")], "sample string, grp string")
    assert m.moderated_t(none, samples, {"x": {"a": 1.0, "b": -1.0}}).count() == 0
    one = spark.createDataFrame([("p", "s1", 1.0), ("p", "s2", 2.0)], LONG)  # no variance can be told
    (x,) = m.moderated_t(one, samples, {"x": {"a": 1.0, "b": -1.0}}).collect()
    assert (x.log_fc, x.t, x.PValue, x.FDR_genome) == (-1.0, None, None, None)
