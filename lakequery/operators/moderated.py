"""Moderated statistics of many measured ids at once: group means and residual variances by aggregation, variances drawn towards a common prior (empirical
Bayes), t-tests of contrasts with them, and trimmed-mean scaling factors of counts.

Tables are long: one row for each id and sample. Only the few numbers of the prior and of the samples reach the driver."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from lakequery.functions.rank import benjamini_hochberg, running
from lakequery.sources.tables import persist_table

#: Shares of ids left out at either end, by log-ratio and by mean log-count.
RATIO_TRIM, MEAN_TRIM = 0.3, 0.05
#: Variances below this part of the median count as this part of it.
FLOOR = 1e-5


def digamma(x: float) -> float:
    out = 0.0
    while x < 12:
        out -= 1 / x
        x += 1
    y = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y * (1 / 132 - y * 691 / 32760)))))


def trigamma(x: float) -> float:
    out = 0.0
    while x < 12:
        out += 1 / (x * x)
        x += 1
    y = 1 / (x * x)
    return out + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y * (1 / 30 - y * (5 / 66 - y * 691 / 2730)))))


def trigamma_inverse(value: float) -> float:
    """x with trigamma(x) = value, by halving in the logarithm; trigamma falls."""
    low, high = -40.0, 40.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if trigamma(math.exp(mid)) > value else (low, mid)
    return math.exp((low + high) / 2)


def _beta_share(a: np.ndarray, b: float, x: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function at x, with rest = 1 - x, by its continued fraction from the side on which that converges fast."""
    swap = x > (a + 1) / (a + b + 2)
    p, q, z, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, rest, x), np.where(swap, x, rest)
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(lgamma(p + q) - lgamma(p) - lgamma(q) + p * np.log(z) + q * np.log(y)) / p
    tiny = 1e-300
    c, d = np.ones_like(z), 1 - (p + q) * z / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    f = d.copy()
    for m in range(1, 400):
        for num in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            f = f * step
        if np.all(np.abs(step - 1) < 1e-15):
            break
    share = np.where(z <= 0, 0.0, front * f)
    return np.where(swap, 1 - share, share)


def two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P-values of t with df degrees of freedom, which may be infinite."""
    t, df = np.abs(np.asarray(t, dtype=float)), np.asarray(df, dtype=float)
    out = np.full(len(t), np.nan)
    normal, ok = np.isinf(df) & ~np.isnan(t), np.isfinite(df) & (df > 0) & ~np.isnan(t)
    out[normal] = [math.erfc(x / math.sqrt(2)) for x in t[normal]]
    if ok.any():
        with np.errstate(over="ignore"):
            square = t[ok] * t[ok]
            out[ok] = _beta_share(df[ok] / 2, 0.5, df[ok] / (df[ok] + square), square / (df[ok] + square))
    return out


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    p = two_sided(t.to_numpy(dtype=float, na_value=np.nan), df.to_numpy(dtype=float, na_value=np.nan))
    return pd.Series(p).where(~np.isnan(p), None)


def group_fit(values: DataFrame, samples: DataFrame, groups: list[str]) -> DataFrame:
    """id, df, s2, mean, and m_i and n_i (mean and number of values of the i-th group) of long values (id, sample, value) and samples (sample, grp). Values that are no finite
    number, and samples of no group, are left out; s2 is null where no group has two values."""
    s = samples.select(F.col("sample").alias("in_sample"), "grp").where(F.col("grp").isin(groups))
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf"))
    each = values.where(finite & F.col("id").isNotNull()).join(s, F.col("sample") == F.col("in_sample"))
    by = each.groupBy("id", "grp").agg(F.count("*").alias("n"), F.avg("value").alias("m"), (F.var_pop("value") * F.count("*")).alias("ss"))
    of = lambda g, c: F.max(F.when(F.col("grp") == g, F.col(c)))
    wide = [x for i, g in enumerate(groups) for x in (of(g, "m").alias(f"m_{i}"), F.coalesce(of(g, "n"), F.lit(0)).alias(f"n_{i}"))]
    fit = by.groupBy("id").agg(F.sum(F.col("n") - 1).alias("df"), F.sum("ss").alias("ss"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"), *wide)
    return fit.withColumn("s2", F.when(F.col("df") > 0, F.col("ss") / F.col("df"))).drop("ss")


def prior(fit: DataFrame) -> tuple[float, float, float]:
    """(d0, s0 squared, sum of all df): the scaled F distribution that the variances of a fit follow. Infinite d0 says that they differ by no more than chance."""
    some = fit.where("df > 0 and s2 is not null")
    row = some.agg(F.percentile_approx("s2", 0.5, 1_000_000).alias("mid"), F.sum("df").alias("df"), F.count("*").alias("n")).first()
    if not row["n"]:
        return math.nan, math.nan, 0.0
    degrees = [int(r["df"]) for r in some.select("df").distinct().collect()]  # no more than there are samples
    look = lambda f: F.create_map(*(F.lit(x) for d in degrees for x in (d, f(d))))[F.col("df").cast("int")]
    s2 = F.greatest("s2", F.lit(FLOOR * row["mid"]))
    e = F.log(s2) - look(lambda d: digamma(d / 2) - math.log(d / 2))
    got = some.where(s2 > 0).agg(F.avg(e).alias("m"), F.var_samp(e).alias("v"), F.avg(look(lambda d: trigamma(d / 2))).alias("t")).first()
    if got["m"] is None:
        return math.nan, math.nan, float(row["df"])
    spread = (got["v"] if got["v"] is not None and not math.isnan(got["v"]) else 0.0) - got["t"]
    if spread <= 0:
        return math.inf, math.exp(got["m"]), float(row["df"])
    d0 = 2 * trigamma_inverse(spread)
    return d0, math.exp(got["m"] + digamma(d0 / 2) - math.log(d0 / 2)), float(row["df"])


def moderated_t(values: DataFrame, samples: DataFrame, contrasts: dict[str, dict[str, float]]) -> DataFrame:
    """id, contrast, log_fc, mean, t, df_total, PValue, FDR_genome for each id and contrast (coefficients by group). A variance is the mean of the id's own and
    the prior's, weighted by their degrees of freedom; together these are no more than all ids have. Where a group of the contrast has no value, or nothing can be told of the variance, all is
    null but id and contrast. False-discovery rates are taken over the ids of each contrast."""
    groups = sorted({g for c in contrasts.values() for g in c})
    fit = persist_table(group_fit(values, samples, sorted(groups)))
    d0, s0, pooled = prior(fit)
    own = F.coalesce("df", F.lit(0)).cast("double")
    if math.isinf(d0):
        post, total = F.lit(s0), F.lit(math.inf)
    elif math.isnan(d0):
        post, total = F.lit(None).cast("double"), F.lit(None).cast("double")
    else:
        post, total = (F.lit(d0 * s0) + own * F.coalesce("s2", F.lit(0.0))) / (F.lit(d0) + own), own + d0
    total = F.least(total, F.lit(pooled)) if pooled else F.lit(None).cast("double")
    out = None
    for name, weights in contrasts.items():
        at = {groups.index(g): float(w) for g, w in weights.items() if w}
        there = F.lit(True)
        fc, unscaled = F.lit(0.0), F.lit(0.0)
        for i, w in at.items():
            there = there & (F.col(f"n_{i}") > 0)
            fc = fc + F.col(f"m_{i}") * w
            unscaled = unscaled + F.lit(w * w) / F.nullif(F.col(f"n_{i}"), F.lit(0))
        t = F.when(there, fc / F.sqrt(post * unscaled))
        rows = fit.select("id", F.lit(name).alias("contrast"), F.when(there, fc).alias("log_fc"), "mean", t.alias("t"), F.when(there, total).alias("df_total"))
        rows = benjamini_hochberg(rows.withColumn("PValue", t_p_value("t", "df_total")), "PValue", "FDR_genome")
        out = rows if out is None else out.union(rows)
    return out


def _average_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """df with the rank of a value within its sample, ties at their mean; by running counts over range partitions, so that no task sees a sample as a whole."""
    n = df.groupBy(F.col("sample").alias("rs"), F.col(value).alias("rv")).agg(F.count("*").alias("c"))
    n = running(n, [F.asc("rs"), F.asc("rv")], F.col("c"), "upto")
    sizes = df.groupBy(F.col("sample").alias("os")).agg(F.count("*").alias("size"))
    first = sizes.select("os", (F.sum("size").over(W.orderBy("os").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")).alias("ahead"))  # a row for each sample
    n = n.join(first, F.col("rs") == F.col("os")).select("rs", "rv", (F.col("upto") - F.col("ahead") - F.col("c") + (F.col("c") + 1) / 2).alias(name))
    return df.join(n, (F.col("sample") == F.col("rs")) & (F.col(value) == F.col("rv"))).drop("rs", "rv")


def scaling_factors(counts: DataFrame) -> DataFrame:
    """sample, lib_size, factor of long counts (id, sample, n): the weighted mean log-ratio of each sample to one reference sample, over the ids that are left when the ends by ratio and by mean
    are trimmed, scaled so that the factors' logarithms add up to 0. The reference is the sample whose upper quartile of relative counts is nearest to
    the mean of all. Missing rows count as 0, ids without any count are left out; a sample without counts has factor 1 and takes no part."""
    n = counts.where("id is not null and sample is not null").groupBy("id", "sample").agg(F.sum(F.coalesce("n", F.lit(0))).cast("double").alias("n"))
    n = persist_table(n)
    ids = n.where("n > 0").select("id").distinct()
    all_ids = ids.count()
    libs = n.groupBy("sample").agg(F.sum("n").alias("lib"), F.count_if(F.col("n") > 0).alias("held"))
    full = n.where("n > 0").join(libs.select(F.col("sample").alias("ls"), "lib"), F.col("sample") == F.col("ls")).select("id", "sample", "n", "lib")
    # the upper quartile with all the zeros that have no row
    place = (all_ids - 1) * 0.75
    low = math.floor(place)
    dense = _average_rank(full.withColumn("share", F.col("n") / F.col("lib")), "share", "r").groupBy("sample", "share").agg(F.first("r").alias("r"), F.count("*").alias("c"))
    dense = dense.join(libs.select(F.col("sample").alias("hs"), "held"), F.col("sample") == F.col("hs"))
    last = F.lit(all_ids) - F.col("held") + F.col("r") + (F.col("c") - 1) / 2 - 1  # place, from 0, of the value's last occurrence
    at = lambda k: F.coalesce(F.min(F.when(last >= k, F.col("share"))), F.lit(0.0))
    first = last - F.col("c") + 1
    lowest = F.min(first)
    pick = lambda k: F.when(lowest > k, F.lit(0.0)).otherwise(at(k))
    quartiles = dense.groupBy("sample").agg((pick(low) + (pick(low + 1) - pick(low)) * (place - low)).alias("q"))
    rows = {r["sample"]: r["q"] for r in quartiles.collect()}  # one for each sample
    if not rows:
        return libs.select("sample", F.col("lib").alias("lib_size"), F.lit(1.0).alias("factor"))
    mean = math.fsum(rows.values()) / len(rows)
    reference = min(sorted(rows), key=lambda s: abs(rows[s] - mean))
    ref = full.where(F.col("sample") == reference).select(F.col("id").alias("ri"), F.col("n").alias("rn"), F.col("lib").alias("rl"))
    both = full.join(ref, F.col("id") == F.col("ri"))
    o, r = F.col("n") / F.col("lib"), F.col("rn") / F.col("rl")
    both = both.select("sample", F.log2(o / r).alias("ratio"), ((F.log2(o) + F.log2(r)) / 2).alias("mean"), ((F.col("lib") - F.col("n")) / F.col("lib") / F.col("n") + (F.col("rl") - F.col("rn")) / F.col("rl") / F.col("rn")).alias("v"))
    ranked = _average_rank(_average_rank(persist_table(both), "ratio", "rr"), "mean", "mr")
    sizes = both.groupBy(F.col("sample").alias("zs")).agg(F.count("*").alias("size"), F.max(F.abs("ratio")).alias("most"))
    ranked = ranked.join(sizes, F.col("sample") == F.col("zs"))
    within = lambda c, trim: F.col(c).between(F.floor(F.col("size") * trim) + 1, F.col("size") - F.floor(F.col("size") * trim))
    kept = ranked.where(within("rr", RATIO_TRIM) & within("mr", MEAN_TRIM))
    f = kept.groupBy(F.col("sample").alias("fs")).agg((F.sum(F.col("ratio") / F.col("v")) / F.sum(1 / F.col("v"))).alias("f"), F.max("most").alias("most"))
    f = f.select("fs", F.when((F.col("most") < 1e-6) | F.col("f").isNull() | F.isnan("f"), F.lit(0.0)).otherwise(F.col("f")).alias("f"))
    out = libs.join(f, F.col("sample") == F.col("fs"), "left").select("sample", "lib", F.when(F.col("lib") > 0, F.coalesce("f", F.lit(0.0))).alias("f"))
    middle = out.agg(F.avg("f").alias("middle"))
    return out.crossJoin(middle).select("sample", F.col("lib").alias("lib_size"), F.coalesce(F.pow(F.lit(2.0), F.col("f") - F.col("middle")), F.lit(1.0)).alias("factor"))  # one row
