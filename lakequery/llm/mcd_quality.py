"""Quality rules: robust multivariate outliers of text statistics, per language and source.

The minimum-covariance-determinant estimate of a group is the mean and covariance of the three quarters of its rows with the
smallest determinant. Three starts (median and deviations; all rows; spatial signs) are improved by concentration steps, each from the rows nearest by
Mahalanobis distance to their mean and covariance, until the determinant falls by less than a hundredth; the start
with the least determinant wins. A step is one aggregation of all rows into bins of their distance (32 to an octave), so a group of any size is spread over all
tasks, only counts, means and products of bins come together, and the result does not depend on how rows are dealt.

Groups are language and source, language, and all rows. The estimate of a group is drawn towards that of the group above as if PRIOR of its rows were
there too, which settles small groups without a rule of their own. The covariance has a floor, so that a statistic that hardly varies rejects no small
deviation; it binds only where a group varies less, and each statistic can reject a document by itself. The number of
words is no part of the vector: length tells nothing of quality, and all rates are taken over it."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.llm.common import Rolling, bounded, coded, hash64, materialize, mix, slices, split_words, texts_of

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
DIMS = 4
STARTS = 3
KEPT_SHARE = 0.75
#: Bins of a statistic to a unit, for medians; of a squared distance to an octave, for the nearest rows.
FINE, OCTAVE = 256, 32
#: The share by which a determinant must fall for another step, and steps at most.
LEAST_FALL, MOST_STEPS = 0.01, 30
#: Rows of the group above that take part in a group's estimate.
PRIOR = 30
#: Standard deviations, of the transformed statistics, that the covariance has at least. In a group that varies less, and with the cut of TAIL,
#: a statistic rejects alone at about: a mean word of 2.8 or 8.7 for 5 letters, 2 % symbols, 30 % repeated lines, 20 % repeated words.
FLOORS = (0.11, 0.25, 0.79, 0.7)
#: Odds at which a row of a normal group would be rejected.
TAIL = 1e-3
#: Groups up to which their estimates are broadcast (about a kilobyte each); those of more are joined by shuffle.
BROADCAST_GROUPS = 20_000


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    words, starts = split_words(texts)
    n = np.diff(starts)
    chars = np.array([len(t.translate(None, SPACE).decode("utf-8", "replace")) for t in texts], dtype=np.int64)
    symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], dtype=np.int64)
    lines, dup = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        full = [x for x in t.split(b"\n") if x.strip()]
        lines[i], dup[i] = len(full), len(full) - len(set(full))
    repeat = np.zeros(len(texts), dtype=np.int64)
    if len(words) > 2:
        codes, distinct = coded(words)
        owner = np.repeat(np.arange(len(texts)), n)
        at = np.arange(len(words) - 2)
        at = at[owner[at] == owner[at + 2]]
        key = Rolling(hash64(distinct)[codes]).of(at, at + 3) + mix(owner[at].astype(np.uint64))
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[count[back] > 1]
        covered = np.zeros(len(words), dtype=bool)
        for k in range(3):
            covered[twice + k] = True
        repeat = np.bincount(owner[covered], minlength=len(texts)).astype(np.int64)
    return {"n_words": n.astype(np.int64), "word_chars": chars, "n_symbols": symbols, "n_lines": lines, "n_dup_lines": dup, "n_repeat_words": repeat}


@bounded
def _measure(batches):
    for b in slices(batches, limit=2_000_000):
        s = statistics(texts_of(b))
        keep = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), *(pa.array(x) for x in s.values())], names=[*keep, *s])


def transformed() -> list[Column]:
    """The vector: mean word length, and rates of symbols, repeated lines and repeated words, on log scales."""
    rate = lambda a, b: F.log1p(F.lit(100.0) * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return [F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))), rate("n_symbols", "word_chars"), rate("n_dup_lines", "n_lines"), rate("n_repeat_words", "n_words")]


def chi2_cdf(x: float, dims: int) -> float:
    """For an even number of dimensions."""
    return 1.0 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))


def chi2_quantile(p: float, dims: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, dims) < p else (lo, mid)
    return hi


#: By which the covariance of the nearest three quarters falls short of that of a normal group.
SHRINK = KEPT_SHARE / chi2_cdf(chi2_quantile(KEPT_SHARE, DIMS), DIMS + 2)


def _distance(x: Column, mean: Column, inverse: Column) -> Column:
    d = [x[i] - mean[i] for i in range(DIMS)]
    terms = [d[i] * d[j] * inverse[i * DIMS + j] for i in range(DIMS) for j in range(DIMS)]
    return sum(terms[1:], terms[0])


def _floored(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """Inverse and determinant of a covariance with its variances, in units of the floors and along its own axes, raised to one where they are less."""
    unit = np.outer(FLOORS, FLOORS)
    var, axes = np.linalg.eigh(cov / unit)
    var = np.maximum(var, 1.0)
    return (axes / var) @ axes.T / unit, float(np.prod(var))


FIT = "g string, k int, rows long, mean array<double>, cov array<double>, inverse array<double>, det double"


def _fit_row(g: str, k: int, rows: int, mean: np.ndarray, cov: np.ndarray) -> tuple:
    inverse, det = _floored(cov)
    return g, k, rows, list(map(float, mean)), cov.ravel().tolist(), inverse.ravel().tolist(), det


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["g", "k", "rows", "mean", "cov", "inverse", "det"])


def _moments(n: float, s, q) -> tuple[np.ndarray, np.ndarray]:
    mean = np.asarray(s, dtype=float) / n
    return mean, np.asarray(q, dtype=float).reshape(DIMS, DIMS) / n - np.outer(mean, mean)


def _started(batches):
    """The three starts of each group."""
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            scale = np.asarray(r.scale, dtype=float)
            mean, cov = _moments(r.n, r.s, r.q)
            signs = np.asarray(r.u, dtype=float).reshape(DIMS, DIMS) / r.n * DIMS * np.outer(scale, scale)
            starts = ((np.asarray(r.m, dtype=float), np.diag(scale**2)), (mean, cov), (np.asarray(r.m, dtype=float), signs))
            out += [_fit_row(r.g, k, r.n, m, c) for k, (m, c) in enumerate(starts)]
        yield _frame(out)


def _concentrated(batches):
    """Estimates from the counts, sums and products of the nearest rows."""
    for pdf in batches:
        yield _frame([_fit_row(r.g, r.k, r.rows, mean, cov * SHRINK) for r in pdf.itertuples(index=False) for mean, cov in [_moments(r.n, r.s, r.q)]])


def _known(df: DataFrame) -> DataFrame:
    """Broadcast a table of groups only once their number is known to be bounded."""
    return F.broadcast(df) if df.count() <= BROADCAST_GROUPS else df


def _sums(x: Column) -> list[Column]:
    return [F.count("*").alias("n"), F.array(*(F.sum(x[i]) for i in range(DIMS))).alias("s"), F.array(*(F.sum(x[i] * x[j]) for i in range(DIMS) for j in range(DIMS))).alias("q")]


def _medians(values: DataFrame, name: str) -> DataFrame:
    """(mg, rows, name) of values (g, x): the middle of the bin that holds each statistic's lower median."""
    bins = values.select("g", F.posexplode(F.transform("x", lambda v: F.floor(v * FINE))).alias("i", "bin")).groupBy("g", "i", "bin").agg(F.count("*").alias("n"))
    each = W.partitionBy("g", "i")
    bins = bins.withColumns({"upto": F.sum("n").over(each.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)), "rows": F.sum("n").over(each)})
    half = bins.where("upto * 2 >= rows").groupBy("g", "i").agg(F.min("bin").alias("bin"), F.first("rows").alias("rows"))
    return half.groupBy(F.col("g").alias("mg")).agg(F.max("rows").alias("rows"), F.array(*(F.max(F.when(F.col("i") == i, (F.col("bin") + 0.5) / FINE)) for i in range(DIMS))).alias(name))


def estimates(vectors: DataFrame) -> DataFrame:
    """(g, k, rows, mean, cov, inverse, det) of each group g of vectors (g, x), from the start k that comes to the least determinant."""
    x = F.col("x")
    middle = materialize(_medians(vectors, "m"), "mcd-medians")
    off = vectors.join(_known(middle.select("mg", "m")), vectors["g"] == F.col("mg")).select("g", F.transform(F.arrays_zip("x", "m"), lambda z: F.abs(z["x"] - z["m"])).alias("x"))
    spread = _medians(off, "mad").select(F.col("mg").alias("sg"), F.array(*(F.greatest(F.col("mad")[i] * 1.4826, F.lit(FLOORS[i])) for i in range(DIMS))).alias("scale"))
    scaled = materialize(middle.join(spread, F.col("mg") == F.col("sg")).select("mg", "m", "scale"), "mcd-spread")
    z = [(x[i] - F.col("m")[i]) / F.col("scale")[i] for i in range(DIMS)]
    rows = vectors.join(_known(scaled), vectors["g"] == F.col("mg")).withColumn("z", F.array(*z))
    norm = F.greatest(sum((F.col("z")[i] * F.col("z")[i] for i in range(1, DIMS)), F.col("z")[0] * F.col("z")[0]), F.lit(1e-12))
    signs = F.array(*(F.sum(F.col("z")[i] * F.col("z")[j] / norm) for i in range(DIMS) for j in range(DIMS))).alias("u")
    start = rows.groupBy("g").agg(*_sums(x), signs, F.first("m").alias("m"), F.first("scale").alias("scale"))
    fit = materialize(start.mapInPandas(_started, FIT), "mcd-fit")
    done, moving = None, fit
    for step in range(MOST_STEPS):
        # far start values of the determinant are no estimates yet, so the first step always counts
        packed = moving.groupBy(F.col("g").alias("fg")).agg(F.max("rows").alias("rows"), F.collect_list(F.struct("k", "mean", "inverse")).alias("starts"))
        far = vectors.join(_known(packed), vectors["g"] == F.col("fg")).select("g", "x", "rows", F.explode("starts").alias("e"))
        bin_ = F.floor(F.log2(_distance(x, F.col("e.mean"), F.col("e.inverse")) + 1.0 / 64) * OCTAVE)
        bins = far.groupBy("g", F.col("e.k").alias("k"), "rows", bin_.alias("bin")).agg(*_sums(x))
        before = F.coalesce(F.sum("n").over(W.partitionBy("g", "k").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        near = bins.withColumn("before", before).where(F.col("before") < F.col("rows") * KEPT_SHARE)
        add = lambda c, n: F.array(*(F.sum(F.col(c)[i]) for i in range(n))).alias(c)
        near = near.groupBy("g", "k", "rows").agg(F.sum("n").alias("n"), add("s", DIMS), add("q", DIMS * DIMS))
        new = materialize(near.mapInPandas(_concentrated, FIT), "mcd-fit")
        was = moving.select(F.col("g").alias("wg"), F.col("k").alias("wk"), F.struct("g", "k", "rows", "mean", "cov", "inverse", "det").alias("was"))
        falls = (F.lit(step == 0)) | (F.col("det") < F.col("was.det") * (1 - LEAST_FALL))
        both = new.join(was, (F.col("g") == F.col("wg")) & (F.col("k") == F.col("wk"))).withColumn("falls", falls)
        stay = both.where(~F.col("falls")).select("was.*")
        done = stay if done is None else done.union(stay)
        moving = both.where("falls").select(*new.columns)
        if moving.isEmpty():
            break
    best = done.union(moving).groupBy("g").agg(F.min_by(F.struct("k", "rows", "mean", "cov", "inverse", "det"), F.struct("det", "k")).alias("b"))
    return materialize(best.select("g", "b.*"), "mcd-best")


def _drawn(mean: np.ndarray, cov: np.ndarray, rows: float, above: tuple) -> tuple[np.ndarray, np.ndarray]:
    w = rows / (rows + PRIOR)
    return w * mean + (1 - w) * above[0], w * cov + (1 - w) * above[1]


def _settled(batches):
    """Estimates of the groups of language and source, drawn towards those above."""
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            get = lambda e: (np.asarray(e["mean"], dtype=float), np.asarray(e["cov"], dtype=float).reshape(DIMS, DIMS), e["rows"])
            drawn = get(r.every)[:2]
            for e in (r.lang_fit, r.leaf_fit):
                drawn = _drawn(*get(e), drawn)
            out.append((r.leaf, drawn[0].tolist(), _floored(drawn[1])[0].ravel().tolist()))
        yield pd.DataFrame(out, columns=["pg", "mean", "inverse"])


def judge(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept of every document.

    base_failed: under 50 words, or more than half of them in repeated 3-word windows; such rows take no part in the
    estimates and have a null distance. A null or empty text has no words. Null lang and source are groups of their own. A table
    without a row that passes the base gives no distance. Repeated rows are judged each. Other columns are ignored."""
    measured = docs.select("doc_id", "lang", "source", "text").mapInArrow(
        _measure, ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", "lang", "source")) + ", n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    part = lambda c, t: [F.coalesce(c, F.lit("")).alias(t), F.col(c).isNull().alias(t + "n")]
    lang, leaf = F.to_json(F.struct(*part("lang", "l"))), F.to_json(F.struct(*part("lang", "l"), *part("source", "s")))
    rows = materialize(measured.select("*", failed.alias("base_failed"), F.array(*transformed()).alias("x"), lang.alias("g_lang"), leaf.alias("g_leaf")), "mcd-rows")
    good = rows.where("not base_failed")
    fit = estimates(good.select(F.explode(F.array("g_leaf", "g_lang", F.lit("{}"))).alias("g"), "x"))
    named = lambda g, e: fit.select(F.col("g").alias(g), F.struct("rows", "mean", "cov").alias(e))
    groups = good.select(F.col("g_leaf").alias("leaf"), F.col("g_lang").alias("of")).distinct()
    groups = groups.join(named("lg", "leaf_fit"), F.col("leaf") == F.col("lg")).join(named("ag", "lang_fit"), F.col("of") == F.col("ag"))
    groups = groups.join(F.broadcast(named("eg", "every").where("eg = '{}'")), F.col("eg") == "{}")  # one row
    settled = materialize(groups.select("leaf", "leaf_fit", "lang_fit", "every").mapInPandas(_settled, "pg string, mean array<double>, inverse array<double>"), "mcd-settled")
    out = rows.join(_known(settled), F.col("g_leaf") == F.col("pg"), "left")
    out = out.withColumn("distance", F.when(~F.col("base_failed"), _distance(F.col("x"), F.col("mean"), F.col("inverse"))))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= chi2_quantile(1 - tail, DIMS))
    return out.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"))
