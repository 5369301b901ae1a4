"""Joins that Catalyst can't infer from a plain statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequery.functions.text import fresh, letter_counts, ratio_bound


def anti_any(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of left of which no key occurs in right: one anti join a key, where NOT EXISTS with OR would be a nested loop."""
    for k in keys:
        left = left.join(right.select(k).distinct(), k, "left_anti")
    return left


def unordered_pairs(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct pairs a < b of a value within each key; values are made distinct before the self-join, all in one dealing by key."""
    d = df.select(*keys, value).where(F.col(value).isNotNull()).repartition(*keys).distinct()
    a, b = d.withColumnRenamed(value, f"{value}_a"), d.withColumnRenamed(value, f"{value}_b")
    return a.join(b, keys).where(F.col(f"{value}_a") < F.col(f"{value}_b"))


def partners(df: DataFrame, key: str, value: str, of: Column) -> DataFrame:
    """Other values that share a key with the given value, and on how many keys."""
    mine = df.where(of).select(key).distinct()
    return df.join(mine, key, "left_semi").where(~of).groupBy(value).agg(F.countDistinct(key).alias("shared"))


def blocked_pairs(left: DataFrame, right: DataFrame, left_name: str, right_name: str, prefix: int = 4, step: int = 5, least: float = 0.0) -> DataFrame:
    """Pairs whose compact names share their first characters, whose lengths are in the same or a neighbouring bucket, and whose
    sequence ratio may reach `least` by their lengths and letters. The join is by prefix and exact length, so a frequent prefix
    is spread over lengths; pairs below the bounds are never made into rows."""
    ln, lp, ll, rn, rp, rl = fresh([*left.columns, *right.columns], "ln", "lp", "ll", "rn", "rp", "rl")
    n = F.length(left_name)
    near = F.filter(F.sequence(F.greatest((F.floor(n / step) - 1) * step, F.lit(1)), (F.floor(n / step) + 2) * step - 1), lambda m: F.lit(2.0) * F.least(m, n) >= F.lit(least) * (m + n))
    lk = left.withColumns({lp: F.substring(left_name, 1, prefix), ll: letter_counts(F.col(left_name)), ln: F.explode(near)})
    rk = right.withColumns({rp: F.substring(right_name, 1, prefix), rl: letter_counts(F.col(right_name)), rn: F.length(right_name).cast("long")})
    may = ratio_bound(F.length(left_name), F.length(right_name), F.col(ll), F.col(rl)) >= least
    return lk.join(rk, (F.col(lp) == F.col(rp)) & (F.col(ln) == F.col(rn)) & may).drop(lp, ll, ln, rp, rl, rn)


def reconcile(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Every key with the class matched, missing or unexpected."""
    e, a = expected.select(key).distinct().withColumn("_e", F.lit(1)), actual.select(key).distinct().withColumn("_a", F.lit(1))
    both = e.join(a, key, "full")
    return both.select(key, F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").otherwise("matched").alias("class"))


def keyword_hits(docs: DataFrame, terms: list[tuple[str, str]], text: Column) -> DataFrame:
    """(topic, term) of a bounded list of terms that occur in each text; the list becomes one array of tests, compiled with the rest and no join. The text's expression is evaluated once."""
    body, hit = fresh(docs.columns, "body", "hit")
    found = F.array_compact(F.array(*(F.when(F.contains(body, F.lit(w)), F.struct(F.lit(t).alias("topic"), F.lit(w).alias("term"))) for t, w in terms)))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    # the generator stays apart from the projection below it, which makes the text once
    return docs.withColumn(body, text).select(*kept, F.explode(found).alias(hit)).select(*kept, f"{hit}.topic", f"{hit}.term")
